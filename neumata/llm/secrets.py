"""Secret scans in built-in column functions only.

Three base patterns find assignments, access keys and long hex strings. Besides, every
maximal run of hex characters and of base64 characters is searched by a sliding window:
the Shannon entropy of WINDOW characters is kept up to date by the counts of the one
character that enters and the one that leaves. A run is parted at placeholders and
separate plain words, and each part is searched by itself; a run with a window over its
character class's threshold is a span of its own, unless the run as a whole is allowed.
"""

from __future__ import annotations

from collections.abc import Callable
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from neumata.llm.shared import let

WINDOW = 20
#: Windows of a run that are searched in one go, and spans of a text that are placed in one go.
SEGMENT, CHUNK = 1024, 64
#: kind -> (pattern, group that holds the secret, its least length in that group). Fixed by contract.
BASE = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
#: What a text must hold for a kind to be looked for at all; each is implied by an accepted match.
QUICK = {
    "assign": r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]",
    "access": r"AKIA[A-Z0-9]{16}",
    "hex": r"[0-9a-f]{24}",
}
#: Character classes of candidates: kind -> (maximal run, least entropy in bits a character). '=' is padding, at the end alone.
CLASSES = {
    "entropy_hex": (rf"[0-9A-Fa-f]{{{WINDOW},}}", 3.0),
    "entropy_base64": (rf"[0-9A-Za-z+/_-]{{{WINDOW},}}={{0,2}}", 3.7),
}
#: A word in lower or title case, shorter than a window, and the digits that may end it.
PLAIN = rf"[A-Z]?[a-z]{{1,{WINDOW - 2}}}"
#: Whole runs that are no secrets: hyphenated uuids, joined plain words, numbers.
ALLOWED = (
    r"^(?i:[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})$"
    rf"|^{PLAIN}(?:[-_/]{PLAIN})*[0-9]{{0,4}}$|^[0-9+/_=-]+$"
)
#: What parts a run, and says nothing for or against what stands beside it: placeholders, counting and keyboard runs, separate plain words.
BESIDE = (
    "(?i:example|sample|placeholder|changeme|dummy|redacted|0123456789|1234567890|abcdefgh|qwerty)"
    rf"|(?<![0-9A-Za-z])[A-Z]?[a-z]{{3,{WINDOW - 2}}}[0-9]{{0,4}}(?![0-9A-Za-z])"
)
KINDS = (*BASE, *CLASSES)
SPAN = "struct<start:int,rank:int,end:int,secret_start:int>"


def entropy_peak(text: Column) -> Column:
    """The highest entropy, in bits, of any WINDOW consecutive characters; text has at least WINDOW.

    total is the sum of c * log2(c) over the counts c of the window; its entropy is
    log2(WINDOW) - total / WINDOW. A step changes the counts of two characters at most,
    and only these are taken. Long texts are searched in segments that share a window.
    """
    table = F.array(*(F.lit(c * log2(c) if c else 0.0) for c in range(WINDOW + 2)))
    weight = lambda c: F.get(table, c)
    count = lambda window, c: F.length(window) - F.length(F.replace(window, c, F.lit("")))

    def scan(x: Column) -> Column:
        def step(s: Column, i: Column) -> Column:
            now = F.struct(
                F.substring(x, F.greatest(i - WINDOW, F.lit(0)) + 1, F.least(i, F.lit(WINDOW))).alias("window"),
                F.substring(x, i + 1, F.lit(1)).alias("come"),
                F.when(i >= WINDOW, F.substring(x, i - WINDOW + 1, F.lit(1))).alias("go"),
            )

            def moved(n: Column) -> Column:
                come = let(count(n["window"], n["come"]), lambda up: weight(up + 1) - weight(up))
                go = F.when(n["go"].isNotNull(), let(count(n["window"], n["go"]), lambda down: weight(down - 1) - weight(down))).otherwise(0.0)
                return F.when(n["come"] == n["go"], s["total"]).otherwise(s["total"] + come + go)

            ready = lambda t: F.when(i >= WINDOW - 1, F.least(s["least"], t)).otherwise(s["least"])
            return let(let(now, moved), lambda t: F.struct(t.alias("total"), ready(t).alias("least")))

        start = F.struct(F.lit(0.0).alias("total"), F.lit(1e9).alias("least"))
        return F.aggregate(F.sequence(F.lit(0), F.length(x) - 1), start, step, lambda s: F.lit(log2(WINDOW)) - s["least"] / WINDOW)

    at = F.sequence(F.lit(0), F.floor((F.length(text) - WINDOW) / SEGMENT).cast("int"))
    segments = F.transform(at, lambda k: let(F.substring(text, k * SEGMENT + 1, F.lit(SEGMENT + WINDOW - 1)), scan))
    return F.round(F.array_max(segments), 9)


def _prefix(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """``join`` (a sum or a maximum of numbers from 0 on) of all values up to each, in chunks: an array is
    copied whole when a value is appended to it, so no long one is built that way."""
    appended = lambda s, v: let(join(s["all"], v), lambda t: F.struct(t.alias("all"), F.array_append(s["out"], t).alias("out")))
    zero = F.struct(F.lit(0).alias("all"), F.array().cast("array<int>").alias("out"))
    at = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / CHUNK).cast("int"))
    chunks = F.transform(at, lambda c: F.aggregate(F.slice(values, c * CHUNK + 1, F.lit(CHUNK)), zero, appended))
    before = lambda x: F.concat(F.array(F.lit(0)), F.aggregate(F.transform(x, lambda c: c["all"]), zero, appended, lambda s: s["out"]))
    whole = lambda x: let(before(x), lambda b: F.flatten(F.transform(x, lambda c, k: F.transform(c["out"], lambda v: join(F.get(b, k), v)))))
    return F.when(F.size(values) > 0, let(chunks, whole)).otherwise(F.array().cast("array<int>"))


def _matches(text: Column, pattern: str, group: int) -> Column:
    """Every match as (start, end, secret): leftmost, not overlapping; positions in code points."""
    found = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("secret"),
        F.split(text, pattern, -1).alias("between"),
    )

    def placed(x: Column) -> Column:
        steps = F.transform(x["whole"], lambda w, i: F.length(w) + F.length(F.get(x["between"], i)))
        match = lambda end, i: F.struct((end - F.length(F.get(x["whole"], i))).alias("start"), end.alias("end"), F.get(x["secret"], i).alias("secret"))
        return F.transform(_prefix(steps, lambda a, b: a + b), match)

    return let(found, placed)


def _span(m: Column, rank: Column) -> Column:
    return F.struct(
        m["start"].alias("start"), rank.alias("rank"), m["end"].alias("end"), (m["end"] - F.length(m["secret"])).alias("secret_start")
    )


def find_spans(text: Column) -> Column:
    """All spans of a text as an array of (start, rank, end, secret_start), sorted; rank is the index in KINDS.

    secret_start is where the secret itself begins, after the name of an assignment.
    """
    none = F.array().cast(f"array<{SPAN}>")
    found = []
    for rank, (kind, (pattern, group, least)) in enumerate(BASE.items()):
        kept = F.filter(_matches(text, pattern, group), lambda m: F.length(m["secret"]) >= least)  # noqa: B023
        spans = F.transform(kept, lambda m: _span(m, F.lit(rank)))  # noqa: B023
        found.append(F.when(text.rlike(QUICK[kind]), spans).otherwise(none))

    for rank, (kind, (pattern, least)) in enumerate(CLASSES.items(), len(BASE)):
        hex_pattern = CLASSES["entropy_hex"][0]
        beside = BESIDE if kind == "entropy_hex" else f"{hex_pattern}|{BESIDE}"  # hex runs are judged as such
        judged = lambda m: F.exists(
            F.split(m["secret"], beside, -1),  # noqa: B023
            lambda part: F.when(F.length(part) >= WINDOW, entropy_peak(part) >= least).otherwise(False),  # noqa: B023
        )
        runs = F.filter(_matches(text, pattern, 0), lambda m: ~m["secret"].rlike(ALLOWED))
        spans = F.transform(F.filter(runs, judged), lambda m: _span(m, F.lit(rank)))  # noqa: B023
        found.append(F.when(text.rlike(pattern), spans).otherwise(none))
    return F.array_sort(F.concat(*found))


def scanned(docs: DataFrame, column: str = "secret_spans") -> DataFrame:
    """``docs`` with the spans as a new column; a null text counts as empty and has none."""
    if column in docs.columns:
        raise ValueError(f"column {column} is taken")
    return docs.withColumn(column, find_spans(F.coalesce(F.col("text"), F.lit(""))))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def counts(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256 and spans.

    Null and empty texts have none; texts of any length are read whole. An empty table
    gives an empty result; repeated rows repeat; other columns are ignored.
    """
    rows = scanned(docs.select("doc_id", "text")).select("doc_id", "secret_spans")
    spans = F.col("secret_spans")
    n = lambda rank: F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("long")
    return rows.select(
        "doc_id",
        *(n(rank).alias(f"n_{kind}") for rank, kind in enumerate(BASE)),
        F.sha2(listed(F.filter(spans, lambda s: s["rank"] < len(BASE))), 256).alias("base_sha256"),
        listed(spans).alias("spans"),
    )


def redacted(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every secret in the text replaced by ``mark``; names of assignments stay.

    Overlapping secrets become one mark. A column n_chars follows the new text. Texts
    without secrets, null ones too, stay as they are; texts of any length are read whole;
    repeated rows repeat; an empty table gives an empty result; columns of any names stay.
    """

    def cover(spans: Column) -> Column:
        by_secret = F.array_sort(F.transform(spans, lambda s: F.struct(s["secret_start"].alias("start"), s["end"].alias("end"))))
        ends = lambda x: F.concat(F.array(F.lit(0)), _prefix(F.transform(x, lambda s: s["end"]), lambda a, b: F.greatest(a, b)))

        def cut(x: Column, covered: Column) -> Column:
            """covered: up to where the text is dealt with before each span, and at the end. A chunk's part of the text is cut out once."""

            def chunk(c: Column) -> Column:
                first, stop = c * CHUNK, F.least((c + 1) * CHUNK, F.size(x))
                low = F.get(covered, first)
                part = F.substring(text, low + 1, F.get(covered, stop) - low)

                def piece(p: Column, i: Column) -> Column:
                    start, done = F.get(x, i)["start"], F.get(covered, i)
                    gap = F.substring(p, done - low + 1, F.greatest(start - done, F.lit(0)))
                    return F.concat(gap, F.when(start >= done, F.lit(mark)).otherwise(""))

                return let(part, lambda p: F.array_join(F.transform(F.sequence(first, stop - 1), lambda i: piece(p, i)), ""))

            pieces = F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / CHUNK).cast("int")), chunk)
            rest = F.substring(text, F.element_at(covered, -1) + 1, F.length(text))
            return F.concat(F.array_join(pieces, ""), rest)

        return let(by_secret, lambda x: let(ends(x), lambda covered: cut(x, covered)))

    text, column = F.col("text"), "secret_spans"
    while column in docs.columns:
        column += "_"
    spans = F.col(column)
    out = scanned(docs, column).withColumn("text", F.when(F.size(spans) > 0, cover(spans)).otherwise(text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
