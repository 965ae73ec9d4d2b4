"""Recogniser output made into scores: tokens in one spelling, lines of notes without words, structure that closes.

Rules are column expressions, applied in order in one pass over the lines of a text; what
comes out goes through unchanged when it is cleaned again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from neumata.functions.common import let

# What a note or a bar looks like anywhere in a line, what begins a line of structure, and its tokens.
NOTE = r"[#b',]*[qsdhQ]?[0-9iI][.,'\-]*"
NOTE_OR_BAR = rf"{NOTE}|[\-|]"
STRUCTURE_LINE = r"^\s*(?:subtitle=|NextScore|KeepLength|R\d*\s*\{|A\s*\{|%|#|\\bar)"
STRUCTURE = r"^(?:subtitle=.*|NextScore|KeepLength|R\d*\{|A\{|\}|\||\\bar.*|%.*)$"
HELD_ON = r"^([qsdh]?[#b',]*[0-7iI][.,']*)(-+)(.*)$"
#: Tokens of a line; what a recogniser adds beyond is a loop of its own.
LONGEST = 64


def _sub(x: Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(x, pattern, replacement)


def spelled(token: Column) -> Column:
    """A token in the spelling of scores, as an array: i is a high 1, 8 and 9 are high 1 and 2, high marks follow the note, low ones
    lead it, the duration is a small letter, and a note that is held on is one token and each dash one of its own."""
    accidental = F.regexp_extract(token, "^([#b]?)", 1)
    duration = F.regexp_extract(token, "^[#b]?([qsdhQ]?)", 1)
    body = _sub(_sub(token, "^[#b]?[qsdhQ]?", ""), "^[iI]", "1'")
    body = _sub(_sub(body, "^([',]*)8(.*)$", "$11'$2"), "^([',]*)9(.*)$", "$12'$2")
    body = _sub(body, r"^([1-7])(,+)([.\-]*)'*$", "$2$1$3")
    body = _sub(body, r"^('+)([1-7])([.\-]*)'*$", "$2$1$3")

    def parted(x: Column) -> Column:
        part = lambda k: F.regexp_extract(x, HELD_ON, k)
        dashes = F.array_repeat(F.lit("-"), F.length(part(2)))
        return F.when(x.rlike(HELD_ON), F.array_remove(F.concat(F.array(part(1)), dashes, F.array(part(3))), "")).otherwise(F.array(x))

    return let(F.concat(accidental, F.lower(duration), body), parted)


def _no_notes(tokens: Column) -> Column:
    return F.size(F.filter(tokens, lambda t: ~t.isin("|", "-", "|-", ""))) == 0


def note_line(line: Column, longest: int = LONGEST) -> Column:
    """The notes and bars in a line, whatever stands between them; empty without a note."""
    found = F.regexp_extract_all(line, F.lit(NOTE_OR_BAR), F.lit(0))
    return let(found, lambda x: F.when(_no_notes(x), "").otherwise(F.array_join(F.flatten(F.transform(F.slice(x, 1, longest), spelled)), " ")))


def structure_line(line: Column) -> Column:
    """The structure and the notes of a line that begins with structure; braces that do not close are all left out. Empty without either."""

    def token(t: Column) -> Column:
        return (
            F.when(t.isin("|}", "}|"), F.array(F.lit("|"), F.lit("}"))).when(t.rlike(r"^(?:R\d*|A)\{\|"), F.array(F.regexp_extract(t, r"^([RA]\d*\{)", 1), F.lit("|")))
            .when(t.rlike(STRUCTURE), F.array(t)).when(t.rlike(f"^(?:{NOTE})$"), spelled(t)).otherwise(F.array().cast("array<string>"))
        )

    def closed(x: Column) -> Column:
        opens, closes = F.size(F.filter(x, lambda t: t.contains("{"))), F.size(F.filter(x, lambda t: t == "}"))
        return F.when(opens > closes, F.filter(x, lambda t: ~t.contains("{") & (t != "}"))).otherwise(x)

    tokens = F.flatten(F.transform(F.array_remove(F.split(line, r"\s+"), ""), token))
    return let(let(tokens, closed), lambda x: F.when(_no_notes(x), "").otherwise(F.array_join(x, " ")))


def with_sections(lines: Column) -> Column:
    """Lines with NextScore before every subtitle but the first, on a line of its own, where it is missing."""
    named = lambda x: F.trim(x).startswith("subtitle=")

    def line(x: Column, i: Column) -> Column:
        later = named(x) & F.exists(F.slice(lines, 1, i), named)
        there = F.trim(F.coalesce(F.get(lines, i - 1), F.lit(""))) == "NextScore"
        bare = F.when(named(x) & x.contains("NextScore"), F.trim(F.replace(F.trim(x), F.lit("NextScore"), F.lit("")))).otherwise(x)
        return F.when(later & ~there, F.array(F.lit("NextScore"), bare)).otherwise(F.array(bare))

    return F.flatten(F.transform(lines, line))


def cleaned(text: Column, longest: int = LONGEST) -> Column:
    """The lines of a recogniser's text that say something, clean, with their sections parted; null and empty texts have none."""
    lines = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\r?\n", -1), lambda x: F.trim(x)), lambda x: x != "")
    each = F.transform(lines, lambda x: F.when(x.rlike(STRUCTURE_LINE), structure_line(x)).otherwise(note_line(x, longest)))
    return let(F.filter(each, lambda x: x != ""), with_sections)


def sounding(tokens: Column) -> Column:
    """The notes that sound: marks, brackets and bars are left out, and a note that is tied to one of the same pitch is one with it.

    A note is a token with a degree that is no tuplet mark; its pitch is its degree with accidental and octave marks. What the notes
    were is kept: the first of tied ones stands for them.
    """
    marks = r"^(?:\d*\[|\]|[()|]+|\\bar.*|[cqsdh]*~[cqsdh]*|NextScore|KeepLength)$"
    pitch = lambda t: F.regexp_replace(t, r"[qsdhc.\-]", "")
    step = lambda s, t: F.struct(
        F.when(t.contains("~"), s["notes"]).when(t.rlike(marks), s["notes"])
        .when(s["tie"] & (pitch(t) == pitch(F.coalesce(F.element_at(F.concat(F.array(F.lit("")), s["notes"]), -1), F.lit("")))), s["notes"])
        .otherwise(F.array_append(s["notes"], t)).alias("notes"),
        F.when(t.contains("~"), F.lit(True)).when(t.rlike(marks), s["tie"]).otherwise(F.lit(False)).alias("tie"),
    )
    return F.aggregate(tokens, F.struct(F.array().cast("array<string>").alias("notes"), F.lit(False).alias("tie")), step, lambda s: s["notes"])
