"""Filter interaction audit: what each filter removes, at any place of any order.

A document is judged by all filters once; which it fails is a number below 32. A table,
made once, has for each such number and each order of the filters the step that removes
the document, or that none does. Every task looks its documents up in it (mapInArrow)
and counts part, order, step and label with np.bincount; the counts of all tasks are
added up. All other figures follow from these sums:

* what fails a filter is removed by it in an order that begins with it;
* what fails it alone is removed by it in an order that ends with it;
* what is left after a step is what the step and those before have not removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = len(FILTERS)
#: Failed filters as bits -> per order the step (from 0) that removes; STEPS where none does.
FIRST_FAILURE = np.array(
    [[next((k for k, f in enumerate(order) if failed >> FILTERS.index(f) & 1), STEPS) for order in ORDERS] for failed in range(1 << STEPS)], np.int64
)
REPEATED = 1 << FILTERS.index("E")
#: Labels that are counted apart.
LABELS = ("good", "toxic")
#: Parts whose counts a task holds before it hands them on.
HELD = 500
#: Fixed by contract: characters of filter D.
SYMBOLS = b"#$%&*|"


def _counts(bytes_: np.ndarray, hit: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hits among the bytes of each text."""
    upto = np.concatenate([[0], np.cumsum(hit[bytes_], dtype=np.int64)])
    return upto[offsets[1:]] - upto[offsets[:-1]]


def _table(of) -> np.ndarray:
    return np.array([of(b) for b in range(256)], bool)


UPPER, SYMBOL, STARTS = _table(lambda b: 65 <= b <= 90), _table(lambda b: b in SYMBOLS), _table(lambda b: b & 0xC0 != 0x80)


def failures(texts: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """The bits of A to D that each whole text fails, and a digest of it. A null text is an empty one.

    bytes.split parts exactly at the six ASCII blanks.
    """
    data = pc.fill_null(texts.cast(pa.large_binary()), b"")
    ends = np.frombuffer(data.buffers()[1], np.int64, len(data) + 1, data.offset * 8)
    whole = np.frombuffer(data.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    offsets = ends - ends[0]
    upper, points, symbols = (_counts(whole, hit, offsets) for hit in (UPPER, STARTS, SYMBOL))
    n, different, digests = np.empty(len(data), np.int64), np.empty(len(data), np.int64), []
    for k, text in enumerate(data):
        raw = text.as_py()
        words = raw.split()
        n[k], different[k] = len(words), len(set(words))
        digests.append(hashlib.sha256(raw).digest())
    bad = (n < 100, 100 * different < 80 * n, 100 * upper > 10 * points, symbols > 0)
    return sum(b.astype(np.int64) << k for k, b in enumerate(bad)), digests


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, part, failed, digest) of each document, whole texts read once; failed has the bits of A to D."""
    rows = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            failed, digests = failures(batch["text"])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["part"], pa.array(failed), pa.array(digests, pa.binary())], names=["doc_id", "part", "failed", "digest"])

    return rows.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, part string, failed long, digest binary")


def weighed(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, good, toxic, n): documents counted by part, failed filters A to E and labels; several rows may agree.

    Rows of one text and label that also share their doc_id are counted first, then rows
    of one text and label, so a text however often it is there comes down to a row for
    each part and label. Of these the smallest doc_id of the text is looked for; the rows
    that bear it, and rows without an id, are no repetitions.
    """
    labelled = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(*(F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(name) for name, c in zip(LABELS, ("quality", "toxic"), strict=True)))
    rows = judged(docs).join(labelled, "doc_id", "left").fillna(False, list(LABELS))
    group = ["digest", "part", "failed", *LABELS]
    by_id = rows.groupBy("doc_id", *group).agg(F.count("*").alias("n"))
    named = F.col("doc_id").isNotNull()
    by_text = by_id.groupBy(*group).agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(~named, F.col("n"))), F.lit(0)).alias("nameless"), F.min("doc_id").alias("first"), F.min_by("n", "doc_id").alias("n_first")
    )
    alone = F.col("nameless") + F.when(F.col("first") == F.min("first").over(Window.partitionBy("digest")), F.col("n_first")).otherwise(0)
    split = by_text.withColumn("alone", alone).select(
        "part", *LABELS, F.inline(F.array(F.struct(F.col("failed"), F.col("alone").alias("n")), F.struct((F.col("failed") + REPEATED).alias("failed"), (F.col("n") - F.col("alone")).alias("n"))))
    )
    return split.where("n > 0")


def removals(rows: DataFrame) -> DataFrame:
    """(part, order, step, removed, good, toxic) summed over ``rows`` of ``weighed``: step is 0 to 4, or 5 for what no filter removes."""
    shape = (len(ORDERS), STEPS + 1)
    schema = pa.schema([("part", pa.string()), *((c, pa.int32()) for c in ("order", "step")), *((c, pa.int64()) for c in ("removed", *LABELS))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def handed() -> Iterator[pa.RecordBatch]:
            order, step = (x.ravel() for x in np.indices(shape))
            for part, sums in held.items():
                flat = sums.reshape(3, -1)
                yield pa.RecordBatch.from_arrays([pa.array([part] * flat.shape[1]), pa.array(order, pa.int32()), pa.array(step, pa.int32()), *map(pa.array, flat)], schema=schema)
            held.clear()

        for batch in batches:
            n = batch["n"].to_numpy(zero_copy_only=False)
            kinds = [np.ones(len(n), bool), *(batch[c].to_numpy(zero_copy_only=False) for c in LABELS)]
            coded = batch["part"].dictionary_encode()
            parts, code = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
            for at in range(0, len(n), 1 << 14):
                some = slice(at, at + (1 << 14))
                step = FIRST_FAILURE[batch["failed"].to_numpy(zero_copy_only=False)[some]]
                cell = ((code[some, None] * len(ORDERS) + np.arange(len(ORDERS))) * (STEPS + 1) + step).ravel()
                for k, kind in enumerate(kinds):
                    weights = np.repeat(np.where(kind[some], n[some], 0), len(ORDERS))
                    sums = np.bincount(cell, weights, len(parts) * len(ORDERS) * (STEPS + 1)).astype(np.int64).reshape(len(parts), *shape)
                    for part, x in zip(parts, sums, strict=True):
                        held.setdefault(part, np.zeros((3, *shape), np.int64))[k] += x
            if len(held) > HELD:
                yield from handed()
        yield from handed()

    partial = rows.mapInArrow(run, "part string, order int, step int, removed long, good long, toxic long")
    return partial.groupBy("part", "order", "step").agg(*(F.sum(c).alias(c) for c in ("removed", *LABELS)))


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, filter_order and step (from 1): kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley.

    A part is a lang value, null and empty ones together. Null texts count as empty; texts
    of any length are read whole; rows that repeat count as often as they are there. E
    asks for an equal text under a smaller doc_id: rows that share the smallest id all
    pass it, and so do rows without an id. Where labels name a document several times,
    one row that says good (or toxic) is enough. An empty table gives no rows. Other
    columns are ignored.
    """
    sums = removals(weighed(docs, labels))
    orders = F.array(*map(F.lit, ORDERS))
    named = sums.withColumn("filter_order", F.get(orders, F.col("order"))).withColumn("filter", F.substring("filter_order", F.col("step") + 1, F.lit(1)))
    of_order = Window.partitionBy("part", "order")
    of_filter = Window.partitionBy("part", "filter")
    is_first = F.when(F.col("step") == 0, F.col("removed"))
    is_last = F.when(F.col("step") == STEPS - 1, F.col("removed"))
    whole = named.withColumn("kept", F.sum("removed").over(of_order) - F.sum("removed").over(of_order.orderBy("step"))).where(F.col("step") < STEPS)
    return whole.withColumns({"fails": F.max(is_first).over(of_filter), "unique_fails": F.max(is_last).over(of_filter), "shapley": F.sum("removed").over(of_filter)}).select(
        "part", "filter_order", (F.col("step") + 1).cast("int").alias("step"), "kept", "removed", (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails",
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), "shapley",
    )


SQL = r"""
WITH words AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), failed AS (
    SELECT doc_id, part, len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b,
           100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
           coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false) AS e
    FROM words
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
    SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM letters p, letters q, letters r, letters s, letters t
    WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
), of_label AS (
    SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS bad FROM labels GROUP BY doc_id
), masks AS (
    SELECT part, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END)
                 || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS fails,
           count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (bad) AS n_bad
    FROM failed LEFT JOIN of_label USING (doc_id) GROUP BY ALL
), cells AS (
    SELECT part, filter_order, k AS step, filter_order[k] AS f, fails, n, n_good, n_bad,
           contains(fails, filter_order[k]) AS now, len(list_filter(range(1, k), lambda i: contains(fails, filter_order[i]))) > 0 AS gone
    FROM masks, orders, (SELECT unnest([1, 2, 3, 4, 5]) AS k)
), steps AS (
    SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (NOT gone AND NOT now), 0) AS kept, coalesce(sum(n) FILTER (NOT gone AND now), 0) AS removed,
           coalesce(sum(n) FILTER (gone AND now), 0) AS redundant, coalesce(sum(n) FILTER (fails = f), 0) AS unique_fails,
           coalesce(sum(n_good) FILTER (NOT gone AND now), 0) AS good_lost, coalesce(sum(n_bad) FILTER (NOT gone AND now), 0) AS toxic_lost
    FROM cells GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM steps
"""
