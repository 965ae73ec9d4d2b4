"""Recogniser output made into scores, on literal lines."""

import pytest
from pyspark.sql import functions as F

from neumata.functions import cleaning


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "token, spelled",
    [
        ("i", ["1'"]), ("I.", ["1'."]), ("8", ["1'"]), ("9.", ["2'."]), (",8", [",1'"]), ("6,", [",6"]), ("6,,.", [",,6."]), ("'1", ["1'"]), ("''3.", ["3''."]), ("'1'", ["1'"]), ("Q5", ["q5"]),
        ("#q6,", ["#q,6"]), ("b7", ["b7"]), ("2-", ["2", "-"]), ("q2--", ["q2", "-", "-"]), ("2.-", ["2.", "-"]), ("2-.", ["2", "-", "."]), ("#q2-", ["#q2-"]), ("i-", ["1'", "-"]), ("-", ["-"]), ("|", ["|"]), ("0", ["0"]),
    ],
)
def test_spelling(spark, token, spelled):
    assert value(spark, cleaning.spelled(F.lit(token))) == spelled
    again = value(spark, F.flatten(F.transform(cleaning.spelled(F.lit(token)), cleaning.spelled)))
    assert again == spelled


@pytest.mark.parametrize(
    "line, cleaned",
    [
        ("| | |", ""), ("- - -", ""), ("la la 1 2- 3 | la", "1 2 - 3 |"), ("no notes, none", ""), ("5 " * 100, " ".join("5" * 64)), ("R{ 1 2 } ...", "R{ 1 2 }"), ("R3{| 1 |}", "R3{ | 1 | }"), ("R{ 1 2", "1 2"),
        ("A{| 1 | 2 }", "A{ | 1 | 2 }"), ("subtitle=Verse x ...", "subtitle=Verse"), ("NextScore", "NextScore"), ("% a remark 1", "% 1"), ("R{ ... }", "R{ }"), ("KeepLength foo 6, i", "KeepLength ,6 1'"),
    ],
)
def test_lines(spark, line, cleaned):
    x = F.lit(line)
    each = F.when(x.rlike(cleaning.STRUCTURE_LINE), cleaning.structure_line(x)).otherwise(cleaning.note_line(x))
    assert value(spark, each) == cleaned


def test_text_is_cleaned_once_and_for_all(spark):
    text = "words only\nsubtitle=A\n1 2- i\n\nsubtitle=B NextScore\nR{ 6, 5\n| |\nNextScore\nsubtitle=C\r\n'1 la la 9\nsubtitle=D\n3"
    expected = ["subtitle=A", "1 2 - 1'", "NextScore", "subtitle=B", ",6 5", "NextScore", "subtitle=C", "1' 2'", "NextScore", "subtitle=D", "3"]
    rows = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "\n".join(expected))], "id int, text string")
    got = {r.id: r.c for r in rows.select("id", cleaning.cleaned(F.col("text")).alias("c")).collect()}
    assert got == {1: expected, 2: [], 3: [], 4: expected}


@pytest.mark.parametrize(
    "tokens, notes",
    [("1 ~ 1 2", "1 2"), ("1 ~ 2", "1 2"), ("3[ 1 2 3 ]", "1 2 3"), ("q1 ~ | 1. 1", "q1 1"), ("( 1 ) | 2", "1 2"), ("1' ~ 1", "1' 1"), ("1 ~ 1 ~ 1", "1"), ("~ 1", "1"), ("", "")],
)
def test_sounding(spark, tokens, notes):
    assert " ".join(value(spark, cleaning.sounding(F.array(*map(F.lit, tokens.split())).cast("array<string>")))) == notes
