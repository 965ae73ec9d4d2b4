"""Licence scans by sentence rules, in built-in column functions only.

A text loses its comment signs, is cut at sentence ends and blank lines, and its wrapped
lines are joined; a line that is a known sentence by itself stays apart. Sentences are
normalised: lower case, letters and digits with single blanks between, without list
marks and names of holders, and with one wording for "released under", "licensed under
the terms of the" and the like. Known sentences become identifiers; the document's sequence of identifiers is
then matched against ordered licence rules, the longest first, each match using its
identifiers up. What is left is matched sentence by sentence. Sentences that speak of
licences but are not known are counted, for review.

The known sentences are not written down but made from the licence texts by the same
steps, each of which is one regular expression that Spark, DuckDB and Python read alike.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from neumata.llm.licence_texts import IDENTIFIERS, NAMES, RESERVED, TEXTS
from neumata.llm.shared import let

#: What a sentence that is not known must hold to be counted.
UNKNOWN = ("license", "licence", "copyright")
#: Words of normalised sentences that need not stand in the text: NORMAL puts them in the place of names.
PUT_IN = {"the", "copyright", "holder", "holders"}
#: (pattern, replacement) of each step, in order: comment signs, what starts anew after a colon, sentence ends.
STEPS = (
    (r"(^|\n)[ \t]*(?:/\*+|\*+/|\*+|//+|#+|--+|;+|%+|<!--|-->|dnl )[ \t]?", "$1"),
    (r"[ \t]*(?:\*/|-->)[ \t\r]*(\n|$)", "$1"),
    (r":[ \t\r\n]+((?:\(?[0-9a-z]{1,2}[.)]|[*-]|The|This|Neither)[ \t])", ":\n\n$1"),
    (r"([A-Za-z0-9)>\"']{2}[.!?][\"')]*)[ \t\r\n]+([^a-z \t\r\n])", "$1\n\n$2"),
)
#: A break between sentences, once lines are joined.
BREAK = r"\n[ \t\r]*\n[ \t\r\n]*"
#: (pattern, replacement) of each step that normalises a sentence in lower case.
NORMAL = (
    (r"^[ \t\r\n]*(?:\(?[0-9a-z]{1,2}[.)]|[*-])[ \t]+", ""),
    (r"[^a-z0-9]+", " "),
    (r"^ | $", ""),
    (r"^(?:(?:this|the) [a-z]+ (?:is|are) )?(?:licensed|released|distributed|made available|available|provided) under (?:the terms of )?(?:the )?", "under "),
    (r"^spdx license identifier ", "spdx "),
    (r"^neither the name of .* nor the names of its contributors ", "neither the name of the copyright holder nor the names of its contributors "),
    (r"^this software is provided by .* as is and any ", "this software is provided by the copyright holders as is and any "),
    (r"^in no event shall .* be liable for any direct ", "in no event shall the copyright holder be liable for any direct "),
)


def _python(pattern: str, replacement: str, text: str) -> str:
    return re.sub(pattern, re.sub(r"\$(\d)", r"\\\1", replacement), text)


def normal(sentence: str) -> str:
    """``normalised`` in Python, for the known sentences."""
    sentence = sentence.lower()
    for step in NORMAL:
        sentence = _python(*step, sentence)
    return sentence


def cut(text: str) -> list[str]:
    """The normalised sentences of a licence text."""
    for step in STEPS:
        text = _python(*step, text)
    return [s for s in map(normal, re.split(BREAK, text)) if s]


@cache
def known() -> dict[str, str]:
    """Normalised sentence -> identifier."""
    out: dict[str, str] = {}
    for name, (text, _) in TEXTS.items():
        for k, sentence in enumerate(cut(text)):
            out.setdefault(sentence, f"{name}.{k}")
    for spoken, name in NAMES.items():
        out.setdefault(normal(f"licensed under the {spoken}"), f"{name}.named")
    for name in dict.fromkeys([*TEXTS, *NAMES.values(), *IDENTIFIERS]):
        out.setdefault(normal(f"SPDX-License-Identifier: {name}"), f"{name}.spdx")
    for sentence in RESERVED:
        out.setdefault(normal(sentence), "proprietary.reserved")
    return out


@cache
def sequence_rules() -> list[tuple[str, str]]:
    """(licence, identifiers as one string) of whole texts of two sentences and more, the longest first, then as listed."""
    flat = [(name, [known()[s] for s in cut(text)]) for name, (text, _) in TEXTS.items()]
    return [(name, "".join(f"<{i}>" for i in ids)) for name, ids in sorted(flat, key=lambda r: -len(r[1])) if len(ids) > 1]


@cache
def single_rules() -> dict[str, str]:
    """identifier -> licence that it states alone; a sentence of several texts goes to the first that lists it."""
    out = {i: i.rsplit(".", 1)[0] for i in known().values() if i.endswith((".named", ".spdx", ".reserved"))}
    for name, (text, alone) in TEXTS.items():
        ids = [known()[s] for s in cut(text)]
        for k in alone:
            out.setdefault(ids[k], name)
    return out


@cache
def spoken() -> tuple[str, ...]:
    """Words of which every known sentence, however it is wrapped or led in, and every sentence that counts as unknown holds one.

    A word of a normalised sentence stands in the text as it is, in some case, unless NORMAL has put it in. A text
    without any of these words has nothing to find, so it is not cut. Long words are preferred, as fewer texts hold them.
    """
    out = list(UNKNOWN)
    rest = [set(s.split()) - PUT_IN for s in known() if not any(w in s.split() for w in UNKNOWN[:2])]
    for least in (8, 4, 1):
        while counts := Counter(w for words in rest for w in words if len(w) >= least):
            out.append(max(counts, key=lambda w: (counts[w], len(w), w)))  # noqa: B023
            rest = [words for words in rest if out[-1] not in words]
    return tuple(out)


def speaks(text: Column) -> Column:
    """Whether a text holds any of ``spoken``."""
    return let(F.lower(text), lambda x: reduce(Column.__or__, (x.contains(w) for w in spoken())))


def _steps(text: Column, steps: tuple[tuple[str, str], ...]) -> Column:
    for pattern, replacement in steps:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def normalised(sentence: Column) -> Column:
    return _steps(F.lower(sentence), NORMAL)


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in pairs.items() for x in pair))


def sentences(text: Column) -> Column:
    """Normalised sentences, in order; empty ones are left out."""
    lines = F.split(_steps(text, STEPS), "\n", -1)
    alone = lambda line: F.map_contains_key(_map(known()), normalised(line))
    apart = F.array_join(F.transform(lines, lambda x: F.when(alone(x), F.concat(F.lit("\n"), x, F.lit("\n"))).otherwise(x)), "\n")
    return F.array_remove(F.transform(F.split(apart, BREAK, -1), normalised), "")


def found(text: Column) -> Column:
    """struct<sentence_ids: string, n_unknown: long, licences: array<string>> of one text."""
    ids_of, single = _map(known()), _map(single_rules())
    rules = F.array(*(F.struct(F.lit(name).alias("name"), F.lit(ids).alias("ids")) for name, ids in sequence_rules()))

    def named(ids: Column) -> Column:
        def step(s: Column, rule: Column) -> Column:
            hit = s["rest"].contains(rule["ids"])
            return F.struct(
                F.when(hit, F.replace(s["rest"], rule["ids"], F.lit("|"))).otherwise(s["rest"]).alias("rest"),
                F.when(hit, F.array_append(s["names"], rule["name"])).otherwise(s["names"]).alias("names"),
            )

        def last(s: Column) -> Column:
            left = F.regexp_extract_all(s["rest"], F.lit("<([^>]*)>"), F.lit(1))
            more = F.array_compact(F.transform(left, lambda i: F.try_element_at(single, i)))
            return F.array_sort(F.array_distinct(F.concat(s["names"], more)))

        return F.aggregate(rules, F.struct(ids.alias("rest"), F.array().cast("array<string>").alias("names")), step, last)

    def matched(lines: Column) -> Column:
        ids = F.array_join(F.transform(F.array_compact(F.transform(lines, lambda s: F.try_element_at(ids_of, s))), lambda i: F.concat(F.lit("<"), i, F.lit(">"))), "")
        unknown = F.size(F.filter(lines, lambda s: s.rlike("|".join(UNKNOWN)) & F.try_element_at(ids_of, s).isNull()))
        return let(ids, lambda x: F.struct(x.alias("sentence_ids"), unknown.cast("long").alias("n_unknown"), named(x).alias("licences")))

    nothing = F.struct(F.lit("").alias("sentence_ids"), F.lit(0).cast("long").alias("n_unknown"), F.array().cast("array<string>").alias("licences"))
    return F.when(speaks(text), let(sentences(text), matched)).otherwise(nothing)


def licensed(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, sentence_ids (known sentences in order), n_unknown, licences (sorted, distinct).

    Null and empty texts have none; texts of any length are read whole; repeated rows
    repeat; an empty table gives an empty result; columns beyond doc_id and text are
    ignored.
    """
    return docs.select("doc_id", found(F.coalesce(F.col("text"), F.lit(""))).alias("found")).select("doc_id", "found.*")


def sql() -> str:
    """DuckDB SQL for ``licensed`` over documents, licences comma-joined."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    table = lambda pairs: "MAP {" + ", ".join(f"{quoted(k)}: {quoted(v)}" for k, v in pairs.items()) + "}"

    def steps(x: str, some: tuple[tuple[str, str], ...]) -> str:
        for pattern, replacement in some:
            escaped = quoted(re.sub(r"\$(\d)", r"\\\1", replacement)).replace("\n", "' || chr(10) || '")
            x = f"regexp_replace({x}, {quoted(pattern)}, {escaped}, 'g')"
        return x

    layers = "".join(
        f""", r{k + 1} AS (SELECT doc_id, n_unknown, ids, replace(rest, '{ids}', '|') AS rest,
            CASE WHEN contains(rest, '{ids}') THEN list_append(names, '{name}') ELSE names END AS names FROM r{k})"""
        for k, (name, ids) in enumerate(sequence_rules())
    )
    return rf"""
WITH cut AS (
    SELECT doc_id, string_split({steps("coalesce(text, '')", STEPS)}, chr(10)) AS lines FROM documents
), apart AS (
    SELECT doc_id, array_to_string(list_transform(lines, lambda x: CASE WHEN len(map_extract({table(known())}, {steps("lower(x)", NORMAL)})) > 0
        THEN chr(10) || x || chr(10) ELSE x END), chr(10)) AS text FROM cut
), parted AS (
    SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, {quoted(BREAK)}), lambda x: {steps("lower(x)", NORMAL)}), lambda s: s <> '') AS lines FROM apart
), named AS (
    SELECT doc_id, lines, list_transform(lines, lambda s: map_extract({table(known())}, s)[1]) AS found FROM parted
), r0 AS (
    SELECT doc_id, array_to_string(list_transform(list_filter(found, lambda i: i IS NOT NULL), lambda i: '<' || i || '>'), '') AS ids, ids AS rest, CAST([] AS VARCHAR[]) AS names,
           len(list_filter(list_zip(lines, found), lambda z: regexp_matches(z[1], '{"|".join(UNKNOWN)}') AND z[2] IS NULL)) AS n_unknown
    FROM named
){layers}
SELECT doc_id, ids AS sentence_ids, n_unknown, array_to_string(list_sort(list_distinct(list_concat(names, list_filter(list_transform(
    regexp_extract_all(rest, '<([^>]*)>', 1), lambda i: map_extract({table(single_rules())}, i)[1]), lambda n: n IS NOT NULL)))), ',') AS licences
FROM r{len(sequence_rules())}
"""
