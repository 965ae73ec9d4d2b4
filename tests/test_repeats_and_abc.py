"""Repeats, endings and parts in playing order; ABC tunes with the pitches that key and bar give them."""

import pytest
from pyspark.sql import functions as F

from neumata.operators import repeats
from neumata.sources import abc


def order(text, parts=""):
    signs = text.split()
    places, problems = repeats.played(signs, parts)
    return " ".join(signs[k] for k in places), problems


@pytest.mark.parametrize(
    "written, heard",
    [
        ("a | b", "a | b"), ("|: a b :| c", "a b a b c"), ("a b :| c", "a b a b c"), ("a :| b :| c", "a a b b c"), ("|: a :: b :| c", "a a b b c"),
        ("|: a [1 b :| [2 c || d", "a b a c || d"), ("|: a [1 b :| [2 c :| [3 d |] e", "a b a c a d |] e"), ("|: a [1 b | [2 c | :| d", "a b | a c | d"), ("a [1 b :| [2 c | d", "a b a c | d"),
        ("|: a |: b :| c :| d", "a b b c a b b c d"), ("|: |: a :| :|", "a a a a"), ("|: x |: a [1 b :| [2 c || y :| z", "x a b a c || y x a b a c || y z"), ("|: a [1 b :| c", "a b a c"), ("|: :| a", "a"),
        ("a |: b [1 c :| [2 d |: e :| f", "a b c b d e e f"), ("", ""),
    ],
)
def test_play_order(written, heard):
    assert order(written) == (heard, [])


def test_odd_scores():
    assert order("|: a b") == ("a b", ["a repeat is not closed"])
    assert order("a [1 b [2 c") == ("a b c", ["an ending of no repeat"] * 2)
    assert order("|: a |: b") == ("a b", ["a repeat is not closed"] * 2)


def test_parts():
    score = "i P:A a :| P:B b P:C c"
    assert order(score) == ("i a a b c", [])
    assert order(score, "BA") == ("i b a a c", [])
    assert order(score, "ABA") == ("i a b a c", [])  # a part that comes twice is played as written
    assert order(score, "AX") == ("i a a b c", ["no part X"])
    assert order(score, "(AB)2")[1] == ["an order of parts that is not plain"]
    assert order("P:A a P:A b", "A")[1] == ["part A stands twice"]


def test_refused(monkeypatch):
    with pytest.raises(repeats.Refused, match="levels"):
        repeats.played(["|:"] * 10_000 + ["a"] + [":|"] * 10_000)
    with pytest.raises(repeats.Refused, match="signs"):
        repeats.played(["|:"] * 40 + ["a"] + [":|"] * 40)
    monkeypatch.setattr(repeats, "DEEPEST", 12)
    assert len(repeats.played(["|:"] * 11 + ["a"] + [":|"] * 11)[0]) == 2**11


def test_play_order_in_sql(spark):
    repeats.register(spark)
    rows = [(1, "|: a [1 b :| [2 c ||".split(), None), (2, None, None), (3, ["|:"] * 100, ""), (4, "P:A a P:B b".split(), "BA")]
    spark.createDataFrame(rows, "id int, signs array<string>, parts string").createOrReplaceTempView("written_scores")
    got = spark.sql("SELECT id, nth, signs[at] AS sign, problem FROM written_scores s, LATERAL play_order(s.signs, s.parts) ORDER BY id, nth").collect()
    assert [(r.id, r.sign) for r in got if r.nth is not None] == [(1, "a"), (1, "b"), (1, "a"), (1, "c"), (1, "||"), (4, "b"), (4, "a")]
    assert [(r.id, r.problem) for r in got if r.nth is None] == [(3, "repeats go deeper than 64 levels")]


@pytest.mark.parametrize(
    "written, expanded",
    [("R{1 2}", "1 2\n1 2"), ("R3{ 1 }", "1\n1\n1"), ("x R{1 2} A{3|4} y", "x 1 2 3\n1 2 4 y"), ("R3{1}A{2|3}", "R3{1}A{2|3}"), ("R2{1}A{2|3}", "1 2\n1 3"), ("R{1\n2}\nA{3}", "R{1\n2}\nA{3}"), ("1 2", "1 2"), (None, None), ("R0{1}", "")],
)
def test_macro(spark, written, expanded):
    assert spark.createDataFrame([(written,)], "s string").select(repeats.macro_expanded("s").alias("e")).first().e == expanded


def notes(body, key="C", head="L:1/4\n"):
    return [(r[6], r[7], r[8], r[5]) for r in abc.events(f"X:1\n{head}K:{key}\n{body}\n") if r[1] == "note"]


def pitches(body, key="C"):
    return [n[:3] for n in notes(body, key)]


def flags(body, key="C"):
    return [r[2] for r in abc.events(f"X:1\nL:1/4\nK:{key}\n{body}\n") if r[1] == "flag"]


@pytest.mark.parametrize("key, fifths", [("C", 0), ("G", 1), ("Bb", -2), ("F#m", 3), ("D dorian", 0), ("Emin", 1), ("A mix", 2), ("Cb", -7), ("none", 0), ("", 0), ("HP", 0), ("Hp", 2), ("F Lydian", 0), ("H", None), ("C foo", None)])
def test_keys(key, fifths):
    assert abc.key_fifths(key) == fifths


def test_key_signature_decides_pitches():
    assert pitches("G A B c d e f g", "G") == [(k % 7 + 1, 0, k // 7) for k in range(8)]  # a scale in its own key has no accidentals
    assert pitches("F", "G") == [(7, 0, -1)] and pitches("=F", "G") == [(7, -1, -1)] and pitches("^F", "G") == [(7, 0, -1)]
    assert pitches("A, B, C D E ^F ^G A", "Am")[-3:] == [(4, 1, 0), (5, 1, 0), (6, 0, 0)]
    assert pitches("B E", "Bb") == [(1, 0, 0), (4, 0, -1)] and pitches("=B", "Bb") == [(1, 1, 0)]


def test_accidentals_hold_for_their_line_in_the_bar():
    assert [p[1] for p in pitches("^C C c | C =C C")] == [1, 1, 0, 0, 0, 0]
    assert [p[1] for p in pitches("^F | F =F F | F", "D")] == [0, 0, -1, -1, 0]
    assert [p[1] for p in pitches("__B B")] == [-2, -2] and "double accidental: __B" in flags("__B")


def test_lengths():
    assert [n[3] for n in notes("C C2 C/ C// C3/2 C/4")] == [1, 2, 0.5, 0.25, 1.5, 0.25]
    assert [n[3] for n in notes("(3CDE F")] == pytest.approx([2 / 3] * 3 + [1])
    assert [n[3] for n in notes("(3:2:2CD E")] == pytest.approx([2 / 3] * 2 + [1])
    assert [n[3] for n in notes("C>D E<F G>>A")] == [1.5, 0.5, 0.5, 1.5, 1.75, 0.25]
    assert [r[4] for r in abc.events("X:1\nL:1/4\nK:C\nC>D z2 E\n") if r[1] in ("note", "rest")] == [0, 1.5, 2, 4]
    assert [n[3] for n in notes("C", head="M:2/4\n")] == [0.25] and [n[3] for n in notes("C", head="M:3/4\n")] == [0.5]
    assert [n[3] for n in notes("C [L:1/8] C\nL:1/16\nC")] == [1, 0.5, 0.25]


def test_chords_and_ties():
    rows = [r for r in abc.events("X:1\nL:1/4\nK:C\n[CEG]2 [c] C-C\n") if r[1] in ("note", "tie")]
    assert [(r[1], r[3], r[4], r[5]) for r in rows] == [("note", 0, 0, 2), ("note", 1, 0, 2), ("note", 2, 0, 2), ("note", None, 2, 1), ("note", None, 3, 1), ("tie", None, 4, None), ("note", None, 4, 1)]
    assert flags("[CE2]") == ["chord of several lengths"] and flags("[CE") == ["chord not closed"] and flags("-C") == ["stray tie"]


def test_nothing_is_dropped_without_a_flag():
    body = '"Am"C {cd}D !segno!E !trill!F (GA) .B ~c T d ?'
    assert flags(body) == ['chord symbol: "Am"', "grace notes: {cd}", "jump: !segno!", "decoration: !trill!", "slur: (", "slur: )", "staccato: .", "roll: ~", "decoration: T", "not read: ?"]
    assert flags("C [K:G] D [M:3/4] E\nN:note\nK:H\n") == ["key change: G", "metre change: 3/4", "field N: note", "key not read: H"]
    assert len(pitches(body)) == 9


def test_events_play_in_order(spark):
    abc.register(spark)
    repeats.register(spark)
    spark.createDataFrame([(7, "X:1\nL:1/4\nK:G\n|: G A [1 B :| [2 c |] d\n")], "id int, tune string").createOrReplaceTempView("tunes")
    spark.sql("""SELECT id, array_agg(sign) AS signs, array_agg(degree) AS degrees FROM (SELECT id, e.* , CASE kind WHEN 'ending' THEN '[' || e.sign ELSE e.sign END AS sign2
        FROM tunes, LATERAL abc_events(tune) e WHERE kind IN ('note', 'bar', 'ending') ORDER BY id, position) GROUP BY id""")
    rows = spark.sql("SELECT id, position, kind, degree, CASE kind WHEN 'ending' THEN concat('[', sign) ELSE sign END AS sign FROM tunes, LATERAL abc_events(tune)").where("kind IN ('note', 'bar', 'ending')")
    listed = rows.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("position", "sign", "degree"))).alias("e"))
    listed.select("id", F.transform("e", lambda x: x["sign"]).alias("signs"), "e").createOrReplaceTempView("listed")
    got = spark.sql("SELECT e[at].degree AS degree FROM listed, LATERAL play_order(signs) WHERE nth IS NOT NULL ORDER BY nth").collect()
    assert [r.degree for r in got if r.degree] == [1, 2, 3, 1, 2, 4, 5]
