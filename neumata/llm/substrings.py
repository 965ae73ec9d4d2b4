"""Exact substring de-duplication: every word window that also starts earlier is removed.

All windows of WINDOW words have a Rabin-Karp hash, but few repeat, so they are not
all shuffled. Each window has an anchor, the GRAM-word run in it whose hash is least;
equal windows have equal anchors. Consecutive windows with one anchor make a span.
The anchors of all spans (about one word in seven) are counted first. Of those that
occur twice or more, spans of equal words are settled whole: all but the first are
removed. Only where one anchor has different spans are windows counted themselves,
and only those of each span's first place, under two independent 64-bit hashes. That
loses no repeat: a window's first place lies in its span's first place. What is to
be removed goes back to its document and merges into maximal intervals.

Anchors of at most CROWD places are compared within their own group, which bounds
it. The places of larger ones are dealt over salts before they are shuffled at all, and
the few firsts of each salt are then aggregated, so a passage of any number of
documents is gathered nowhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from neumata.llm.shared import BLANKS, Scratch, is_small, word_count

WINDOW, GRAM = 20, 8
#: Odd multipliers of the polynomial hashes.
BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
NO_ID = -(1 << 63)
#: Places of one anchor that are compared in one group.
CROWD = 4096
#: Crowded anchors up to which their table is broadcast; a larger one is joined, with its hot keys split by adaptive execution.
SMALL_CROWDS = 200_000


def split(text: bytes) -> list[bytes]:
    return text.split()  # of bytes: at the six ASCII blanks alone


@cache
def _powers(base: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and its inverse for i < length, modulo 2 ** 64."""

    def up(b: int) -> np.ndarray:
        out = np.full(length, b, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return up(base), up(pow(base, -1, 1 << 64))


def _prefix(hashes: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    power, inverse = _powers(base, 1 << max(10, len(hashes).bit_length()))
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * power[: len(hashes)], dtype=np.uint64)]), inverse


def runs(hashes: np.ndarray, starts: np.ndarray, stops: np.ndarray, base: int) -> np.ndarray:
    """The hashes of word runs: differences of prefix sums of h[i] * base ** i, scaled back to the run's start and
    mixed, all modulo 2 ** 64. Runs of equal words have equal hashes wherever they stand."""
    sums, inverse = _prefix(hashes, base)
    x = (sums[stops] - sums[starts]) * inverse[starts]
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def rolling(hashes: np.ndarray, width: int, base: int) -> np.ndarray:
    """The hash of every run of ``width`` words."""
    starts = np.arange(max(0, len(hashes) - width + 1))
    return runs(hashes, starts, starts + width, base)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def anchors(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each GRAM-word run, position of the anchor of each window); ties go to the leftmost run."""
    grams = rolling(hashes, GRAM, BASES[0])
    if len(hashes) < window:
        return grams, np.empty(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(grams, window - GRAM + 1)
    return grams, views.argmin(1) + np.arange(len(views))


def anchor_spans(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor's hash, first window, number of windows) of every span: windows in a row with one anchor."""
    grams, place = anchors(hashes, window)
    starts = np.flatnonzero(np.diff(place, prepend=-1))
    return grams[place[starts]], starts, np.diff(starts, append=len(place))


def covered(starts: np.ndarray, stops: np.ndarray, n: int) -> np.ndarray:
    """Which of n words lie in one of the intervals."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, stops, -1)
    return np.cumsum(change)[:n] > 0


UNIT = ["unit_id", "text_hash"]
PLACE = [*UNIT, "start"]


def _salts() -> Column:
    """Over how many salts the places of an anchor with n of them are dealt."""
    return F.ceil(F.col("n") / CROWD).cast("int")


def _salt(salts: Column) -> Column:
    return F.when(salts > 1, F.pmod(F.xxhash64(*PLACE), salts)).otherwise(0).cast("int")


def _repeated_spans(scratch: Scratch, texts: DataFrame, window: int) -> DataFrame:
    """(gram, salt, unit_id, text_hash, start, length, span, n) of every span whose anchor occurs n > 1 times.

    Rows come dealt by (gram, salt), so that no anchor, however frequent, fills a task.
    """

    def rows(grams_only: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at, columns = [], []
                for row, text in enumerate(batch["text"]):
                    hashes = word_hashes(split(text.as_py() or b""))
                    gram, starts, length = anchor_spans(hashes, window)
                    at.append(np.full(len(gram), row))
                    if grams_only:
                        columns.append((gram,))
                    else:
                        columns.append((gram, runs(hashes, starts, starts + length + window - 1, BASES[1]), starts, length))
                if at:
                    kinds = (np.int64, np.int64, np.int32, np.int32)
                    parts = [np.concatenate(c) for c in zip(*columns, strict=True)]
                    arrays = [pa.array(c.view(t) if t is np.int64 and c.dtype == np.uint64 else c.astype(t)) for c, t in zip(parts, kinds)]
                    names = ["gram", "span", "start", "length"][: len(arrays)]
                    if not grams_only:
                        taken = pa.array(np.concatenate(at))
                        arrays += [batch[c].take(taken) for c in UNIT]
                        names += UNIT
                    yield pa.RecordBatch.from_arrays(arrays, names)

        return run

    grams = texts.select("text").mapInArrow(rows(True), "gram long")
    twice = scratch.keep(grams.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1"), "grams")
    crowds = twice.where(F.col("n") > CROWD).select("gram", _salts().alias("salts"))
    crowds = F.broadcast(crowds) if is_small(crowds, SMALL_CROWDS) else crowds
    found = texts.mapInArrow(rows(False), "gram long, span long, start int, length int, unit_id long, text_hash long")
    dealt = found.join(crowds, "gram", "left").withColumn("salt", _salt(F.coalesce("salts", F.lit(1)))).drop("salts")
    return dealt.join(twice.withColumn("salt", F.explode(F.sequence(F.lit(0), _salts() - 1))), ["gram", "salt"])


def _settled(scratch: Scratch, spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of repeated spans: the later ones, and the firsts of those whose anchor has other spans too, with n."""
    crowd = F.col("n") > CROWD
    group = Window.partitionBy("gram", "salt")
    order = Window.partitionBy("gram", "salt", "span", "length").orderBy(*PLACE)
    flagged = spans.withColumn("apart", crowd | (F.min("span").over(group) != F.max("span").over(group))).withColumn("first", F.row_number().over(order) == 1)
    open_ = F.col("first") & crowd
    kept = scratch.keep(
        flagged.where(~F.col("first") | F.col("apart")).select(
            *PLACE, "length", "n", "first", *(F.when(open_, F.col(c)).alias(c) for c in ("gram", "span"))
        ),
        "spans",
    )
    salted = kept.where(open_)  # the firsts of each salt
    key = ["gram", "span", "length"]
    first = salted.groupBy(*key).agg(F.min(F.struct(*PLACE)).alias("earliest"))
    settled = salted.join(first, key).withColumn("first", F.struct(*PLACE) == F.col("earliest")).select(*PLACE, "length", "n", "first")
    every = kept.where(~open_).select(*PLACE, "length", "n", "first").unionByName(settled)
    return every.where("not first"), every.where("first")


def _later_windows(texts: DataFrame, spans: DataFrame, window: int) -> DataFrame:
    """Places of the windows in ``spans`` that also start earlier in one of them.

    Equal windows have equal anchors, so they are as few as these, or dealt over as many salts.
    """
    marks = spans.groupBy(*UNIT).agg(F.collect_list(F.struct("start", "length", _salts().alias("salts"))).alias("marks"))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                hashes = word_hashes(split(batch["text"][row].as_py()))
                marks = batch["marks"][row].values
                first, length, salts = (marks.field(c).to_numpy().astype(np.int64) for c in ("start", "length", "salts"))
                starts = np.repeat(first - np.cumsum(length) + length, length) + np.arange(length.sum())
                same = pa.array(np.full(len(starts), row))
                arrays = [pa.array(runs(hashes, starts, starts + window, b).view(np.int64)) for b in BASES]
                arrays += [batch["unit_id"].take(same), batch["text_hash"].take(same), pa.array(starts.astype(np.int32)), pa.array(np.repeat(salts, length).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(arrays, ["h1", "h2", *PLACE, "salts"])

    seen = texts.join(marks, UNIT).mapInArrow(windows, "h1 long, h2 long, unit_id long, text_hash long, start int, salts int")
    seen = seen.withColumn("salt", _salt(F.col("salts")))
    place = F.struct(*PLACE)
    first = F.min(place).over(Window.partitionBy("h1", "h2", "salt")) == place
    open_ = first & (F.col("salts") > 1)
    # not written, and ranked by a minimum and not by a row number, which Spark would limit in one branch only: so the
    # dealt texts and windows are reused within one job, also by the cut of the texts
    kept = seen.withColumns({"first": first, "open": open_}).where("NOT first OR open").select(*PLACE, "open", "h1", "h2")
    salted = kept.where("open")
    earliest = salted.groupBy("h1", "h2").agg(F.min(place).alias("earliest"))
    return kept.where("NOT open").select(*PLACE).unionByName(salted.join(earliest, ["h1", "h2"]).where(place > F.col("earliest")).select(*PLACE))


def removals(spark: SparkSession, docs: DataFrame, window: int = WINDOW, repeat: bool | None = None) -> DataFrame:
    """Rows of ``docs`` that lose words: unit_id, text_hash, n_words, n_removed, spans, kept_text.

    spans are the removed word intervals, maximal and in order, ends exclusive;
    kept_text is the words left, joined by one blank. Windows are judged on the
    input. unit_id is the doc_id, and NO_ID for null ids, which so come first. Rows
    that repeat a doc_id and its text are one document; rows that repeat a doc_id
    with other texts are documents of their own, ordered by a hash of the text.
    Null, empty and shorter texts lose nothing; an empty table gives an empty result.
    repeat says whether ids do; it is looked up if not given.
    """
    scratch = Scratch(spark, "substrings")
    repeat = ids_repeat(docs) if repeat is None else repeat
    texts = keyed(docs, repeat).select(*UNIT, F.col("text").cast("binary").alias("text"))
    if repeat:
        texts = texts.dropDuplicates(UNIT)
    later, firsts = _settled(scratch, _repeated_spans(scratch, texts, window))
    gone = later.select(*UNIT, F.struct("start", (F.col("start") + F.col("length") + window - 1).alias("stop")).alias("gone"))
    some = _later_windows(texts, firsts, window)
    gone = gone.unionByName(some.select(*UNIT, F.struct("start", (F.col("start") + window).alias("stop")).alias("gone")))
    lost = gone.groupBy(*UNIT).agg(F.collect_list("gone").alias("gone"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in range(batch.num_rows):
                words = split(batch["text"][row].as_py())
                spans = batch["gone"][row].values
                gone = covered(spans.field("start").to_numpy(), spans.field("stop").to_numpy(), len(words))
                edges = np.flatnonzero(np.diff(gone, prepend=False, append=False))
                kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
                ends = [{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)]
                out.append((len(words), int(gone.sum()), ends, kept.decode()))
            arrays = [batch["unit_id"], batch["text_hash"], *map(pa.array, zip(*out, strict=True))] if out else []
            if out:
                yield pa.RecordBatch.from_arrays(arrays, [*UNIT, "n_words", "n_removed", "spans", "kept_text"])

    return texts.join(lost, UNIT).mapInArrow(
        cut,
        "unit_id long, text_hash long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept_text string",
    )


def ids_repeat(docs: DataFrame) -> bool:
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("unit_id"))
    return bool(ids.groupBy("unit_id").count().where("count > 1").limit(1).count())


def keyed(docs: DataFrame, repeat: bool) -> DataFrame:
    """``docs`` with unit_id and text_hash; the hash is only taken where ids repeat."""
    return docs.withColumns(
        {
            "unit_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)),
            "text_hash": F.xxhash64("text") if repeat else F.lit(0).cast("long"),
        }
    )


def deduplicated(spark: SparkSession, docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed and kept_sha256 of the words left, joined by one blank.

    Null texts have no words. Repeated rows repeat, see ``removals``; texts of any length
    are read whole; columns beyond doc_id and text are ignored.
    """
    repeat = ids_repeat(docs)
    whole = F.trim(F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), BLANKS, " "))
    rows = keyed(docs, repeat).select("doc_id", "unit_id", "text_hash", F.sha2(whole, 256).alias("whole_sha256"), word_count(F.col("text")).alias("n_words"))
    lost = removals(spark, docs, window, repeat).select("unit_id", "text_hash", "n_removed", F.sha2("kept_text", 256).alias("sha256"))
    return rows.join(lost, ["unit_id", "text_hash"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("sha256", "whole_sha256").alias("kept_sha256"),
    )
