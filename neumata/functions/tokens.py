"""Token algebra of numbered notation as column expressions.

A token is [duration][octave][accidental]degree[octave][accidental][duration][dots][']'],
or a chord of two and more degrees. Everything here stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from neumata.functions.common import let

# The token patterns, beats per duration letter, section weights and rest signs.
SINGLE = r"^([cqsdh]*)([,']*)([#b♯♭]?)([1-7x0])([,']*)([#b♯♭]?)([cqsdh]*)([.]*)(\]?)$"
CHORD = r"^([cqsdh]*)((?:[,']*[#b♯♭]?[1-7x0]){2,})([,']*)([#b♯♭]?)([cqsdh]*)([.]*)(\]?)$"
CHORD_NOTE = r"([,']*)([#b♯♭]?)([1-7x0])"
BEATS = {"h": 0.0625, "c": 1.0, "": 1.0, "q": 0.5, "s": 0.25, "d": 0.125}
UNKNOWN_BEAT, DOT, DEFAULT_BAR = 0.0625, 1.5, 4.0
SECTION_WEIGHTS = {
    "chorus": 1.6, "refrain": 1.6, "verse": 1.25, "pre-chorus": 1.10, "bridge": 1.10, "interlude": 1.10,
    "score": 1.00, "intro": 0.80, "outro": 0.80, "layer": 0.80, "crazy-piano": 0.80,
}
SILENT = r"^(?:0|x|-|\||~|[cqsdh]-+)$"

NOTES = "array<struct<digit:int,acc:int,oct:int>>"


def tokens_of(score: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(score, F.lit("")), r"\s+"), "")


def _note(digit: Column, accidentals: Column, octaves: Column) -> Column:
    sharp, flat = accidentals.rlike("[#♯]"), accidentals.rlike("[b♭]")
    return F.struct(
        F.when(digit.rlike("[1-7]"), digit.try_cast("int")).alias("digit"),
        F.when(sharp, 1).when(flat, -1).otherwise(0).alias("acc"),
        (F.regexp_count(octaves, F.lit(",")) - F.regexp_count(octaves, F.lit("'"))).alias("oct"),
    )


def parse_notes(token: Column) -> Column:
    """The notes of a token, in written order; rests have no degree; what is no token has no notes.

    Signs after a chord bind to its last note.
    """
    group = lambda k: F.regexp_extract(token, SINGLE, k)
    single = F.array(_note(group(4), F.concat(group(3), group(6)), F.concat(group(2), group(5))))
    body = F.regexp_extract(token, CHORD, 2)
    part = lambda k: F.regexp_extract_all(body, F.lit(CHORD_NOTE), F.lit(k))
    last = lambda i, k: F.when(i == F.size(part(3)) - 1, F.regexp_extract(token, CHORD, k)).otherwise("")
    chord = F.transform(
        part(3),
        lambda d, i: _note(d, F.concat(F.get(part(2), i), last(i, 4)), F.concat(F.get(part(1), i), last(i, 3))),
    )
    return F.when(token.rlike(SINGLE), single).when(token.rlike(CHORD), chord).otherwise(F.array().cast(NOTES))


def is_note(token: Column) -> Column:
    return token.rlike(SINGLE) | token.rlike(CHORD)


def digits_of(score: Column) -> Column:
    """The degrees of a score as one string; ties are not merged."""
    notes = F.flatten(F.transform(tokens_of(score), parse_notes))
    return F.array_join(F.transform(F.filter(notes, lambda n: n["digit"].isNotNull()), lambda n: n["digit"].cast("string")), "")


def merged_notes(score: Column) -> Column:
    """The pitched notes of a score with tied repeats merged.

    ``X ~ X`` is one note if degree and accidental agree, whatever the octave. A dash
    and a timed dash keep a tie open; rests and other marks end it; a tie sign counts
    only after a note. Of a chord only the first note can be merged, into the last
    pitched note before.
    """
    none = F.lit(None).cast("struct<digit:int,acc:int,oct:int>")

    def step(s: Column, token: Column) -> Column:
        pitched = F.filter(parse_notes(token), lambda n: n["digit"].isNotNull())

        def grown(p: Column) -> Column:
            first = F.get(p, F.lit(0))
            same = F.coalesce(s["tied"] & (first["digit"] == s["last"]["digit"]) & (first["acc"] == s["last"]["acc"]), F.lit(False))
            hold, tie, note = token.rlike("^[cqsdh]*-$"), token == "~", F.size(p) > 0
            more = F.when(same, F.slice(p, 2, F.greatest(F.size(p), F.lit(1)))).otherwise(p)
            return F.struct(
                F.concat(s["out"], more).alias("out"),
                F.when(note & ~same, F.element_at(p, -1)).when(note & (F.size(p) > 1), F.element_at(p, -1)).otherwise(s["last"]).alias("last"),
                F.when(hold, s["tied"]).when(tie, s["sounded"]).otherwise(F.lit(False)).alias("tied"),
                F.when(hold | tie, s["sounded"]).otherwise(note).alias("sounded"),
            )

        return let(pitched, grown)

    start = F.struct(F.array().cast(NOTES).alias("out"), none.alias("last"), F.lit(False).alias("tied"), F.lit(False).alias("sounded"))
    return F.aggregate(tokens_of(score), start, step, lambda s: s["out"])


def duration_letter(token: Column) -> Column:
    """The duration letters before the note, or else those after it."""
    before = F.regexp_extract(token, "^([cqsdh]+)", 1)
    return F.when(before != "", before).otherwise(F.regexp_extract(token, r"([cqsdh]+)[.]*[\[\]]?$", 1))


def beat(token: Column) -> Column:
    """Beats of a token: by its letter, unknown combinations the shortest; a final dot adds a half, once."""
    table = F.create_map(*(F.lit(x) for item in BEATS.items() for x in item))
    length = F.coalesce(F.try_element_at(table, duration_letter(token)), F.lit(UNKNOWN_BEAT))
    return F.when(token.endswith("."), length * DOT).otherwise(length)


def beats_per_bar(score: Column) -> Column:
    """From a line of its own like 3/4; four where there is none."""
    n, d = (F.regexp_extract(score, r"(?m)^\s*(\d+)\s*/\s*(\d+)\s*$", k).try_cast("double") for k in (1, 2))
    return F.coalesce(F.when(d > 0, n * 4.0 / d), F.lit(DEFAULT_BAR))


def tuplet_ratio(token: Column) -> Column:
    """struct(num, fit_in) of a mark like ``3[``; null for anything else."""
    fit = F.regexp_extract(token, r"^([1-9][0-9]*)\[$", 1).try_cast("int")
    power = F.aggregate(F.sequence(F.lit(1), F.lit(30)), F.lit(2), lambda p, _: F.when(p < fit, p * 2).otherwise(p))
    num = F.when(power == fit, F.floor(fit * 3 / 2)).otherwise(F.floor(power / 2)).cast("int")
    return F.when(fit.isNotNull(), F.struct(num.alias("num"), fit.alias("fit_in")))


def section_weight(name: Column) -> Column:
    """The largest weight among comma-joined section names; unknown and empty ones weigh 1."""
    table = F.create_map(*(F.lit(x) for item in SECTION_WEIGHTS.items() for x in item))
    names = F.filter(F.transform(F.split(F.coalesce(name, F.lit("")), ","), lambda x: F.lower(F.trim(x))), lambda x: x != "")
    return F.coalesce(F.array_max(F.transform(names, lambda x: F.coalesce(F.try_element_at(table, x), F.lit(1.0)))), F.lit(1.0))
