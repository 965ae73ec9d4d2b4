"""SimHash near-duplicates with generalised pigeonhole candidates.

Fingerprints within TAU bits are found without comparing all: the 64 bits are grouped
into parts so that correlated bits share one, and part i gets a threshold t_i >= -1
with sum(t_i + 1) = TAU + 1, so any two fingerprints within TAU differ by at most t_i
bits in some part i (-1: the part is not probed). A dynamic programme picks the
thresholds of least estimated work. A fingerprint is indexed under its own value of
each part and probes all values within t_i; those that meet are verified on all bits.

Equal fingerprints are one class throughout. A value that more than BUCKET classes
share is not compared pairwise: there each class owns the files of all fingerprints
within tau // 2 bits of its own and visits those within the other half of tau, rounded
up. Two classes are within tau bits exactly if one visits a file that the other owns.
A file is as small as the number of fingerprints in its reach: 65 classes for two bits.
Both ways only spanning edges are handed on.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from neumata.llm.components import components
from neumata.llm.shared import Scratch

BITS, TAU, SHINGLE, SEED = 64, 2, 3, 42
#: Classes under one value of one part that are still compared pairwise.
BUCKET = 256
#: Fingerprints from which bit correlations and candidate counts are estimated, at most.
SAMPLE = 4096


def fingerprint(text: bytes) -> int:
    """Bit k is 1 if it is set in over half of the hashes of the text's shingles; 0 without words."""
    words = text.lower().split()  # bytes: only A-Z are lowered, only the ASCII blanks split
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE)), strict=False))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, seed=SEED) for s in shingles), np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(block.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int((np.uint64(1) << np.arange(BITS, dtype=np.uint64))[2 * ones > len(hashes)].sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, **keys: Column) -> DataFrame:
    """(doc_id, keys, fp) per row, fp as a signed long; null and empty texts have 0. ``keys`` are strings."""
    names = ["doc_id", *keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py() or b"") for t in batch["text"]), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in names), pa.array(fps.view(np.int64))], [*names, "fp"])

    kept = [c.alias(name) for name, c in keys.items()]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *kept, F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, ", ".join(["doc_id long", *(f"{k} string" for k in keys), "fp long"]))


def grouped_bits(sample: np.ndarray, parts: int) -> list[list[int]]:
    """The bits in so many parts of near-equal width, each grown from the bit least like those
    placed by adding the bits most correlated with it."""
    bits = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(float)
    bits -= bits.mean(0)
    norm = np.sqrt((bits**2).sum(0)) + 1e-9
    like = np.abs(bits.T @ bits / np.outer(norm, norm))
    left, out = list(range(BITS)), []
    for k in range(parts):
        width = -(-len(left) // (parts - k))
        placed = [b for part in out for b in part]
        part = [min(left, key=lambda b: (like[b, placed].sum() if placed else 0.0, b))]
        while len(part) < width:
            part.append(max((b for b in left if b not in part), key=lambda b: (like[b, part].sum(), -b)))
        left = [b for b in left if b not in part]
        out.append(sorted(part))
    return out


def thresholds(cost: list[list[float]], tau: int) -> tuple[float, list[int]]:
    """Least total cost[i][t_i + 1] with sum(t_i + 1) = tau + 1, by dynamic programming over the parts."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in cost:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (total, chosen) in best.items():
            for t1, c in enumerate(row):
                if used + t1 <= tau + 1 and (used + t1 not in step or total + c < step[used + t1][0]):
                    step[used + t1] = (total + c, [*chosen, t1 - 1])
        best = step
    return best[tau + 1]


def plan(sample: np.ndarray, n: int, tau: int = TAU) -> list[tuple[list[int], int]]:
    """Parts and thresholds of least estimated work for n classes, of those with one to tau + 1 parts.

    Work is probes made plus partners met. A class's partners are estimated from those
    that it has in the sample, with one pair added in all so that no part is free; a
    class in a crowd costs the files it is in, however large the crowd.
    """
    if len(sample) < 2:
        return [(part, 0) for part in grouped_bits(np.arange(4, dtype=np.uint64), tau + 1)]
    scale, files = n / len(sample), sum(comb(BITS, k) for k in range((tau + 1) // 2 + 1))
    options = []
    for parts in range(1, tau + 2):
        groups, cost = grouped_bits(sample, parts), []
        for part in groups:
            mask = np.uint64(sum(1 << b for b in part))
            met = np.full(tau + 1, scale)
            for at in range(0, len(sample), 256):
                apart = np.bitwise_count((sample[at : at + 256, None] ^ sample[None, :]) & mask)
                for t in range(tau + 1):
                    partners = ((apart <= t).sum(1) - 1) * scale * (1 + t) / 2
                    met[t] += np.minimum(partners, files).sum()
            probes = np.cumsum([comb(len(part), t) for t in range(tau + 1)])
            cost.append([0.0, *(n * probes + scale * met)])
        options.append((*thresholds(cost, tau), groups))
    _, chosen, groups = min(options, key=lambda o: o[0])
    return [(part, t) for part, t in zip(groups, chosen, strict=True) if t >= 0]


def _spanning(fps: np.ndarray, tau: int) -> Iterator[tuple[int, int]]:
    """Edges that connect the fingerprints within tau bits of each other as all their links would."""
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= tau
    label = np.arange(len(fps))
    while True:
        low = np.where(near, label[None, :], len(fps)).min(1)
        if (low == label).all():
            break
        label = low
    for i in np.flatnonzero(label != np.arange(len(fps))):
        yield int(fps[i].view(np.int64)), int(fps[label[i]].view(np.int64))


def _flips(bits: Iterable[int], most: int) -> list[int]:
    """Signed masks of all choices of up to ``most`` of the bits, small choices first."""
    return [int(np.uint64(sum(1 << b for b in chosen)).view(np.int64)) for k in range(most + 1) for chosen in combinations(bits, k)]


def near_edges(spark: SparkSession, classes: DataFrame, tau: int = TAU) -> DataFrame:
    """(a, b): edges that connect the fingerprints of ``classes`` (fp: distinct) as all links within tau bits do."""
    n = classes.count()
    share = min(1.0, SAMPLE / 2 / max(1, n))
    drawn = classes.where(F.pmod(F.xxhash64(F.lit(3), "fp"), F.lit(1 << 30)) < int(share * (1 << 30))).limit(SAMPLE)
    sample = np.array([r["fp"] for r in drawn.collect()], np.int64).view(np.uint64)
    scratch = Scratch(spark, "simhash")
    filed = None
    for number, (part, t) in enumerate(plan(np.unique(sample), n, tau)):
        flips = _flips(part, t)
        value = F.col("fp").bitwiseAND(F.lit(int(np.uint64(sum(1 << b for b in part)).view(np.int64))))
        probes = F.explode(F.transform(F.array(*map(F.lit, flips)), lambda x: value.bitwiseXOR(x))) if t else value  # noqa: B023
        rows = classes.select(F.lit(number).alias("part"), probes.alias("value"), "fp")
        filed = rows if filed is None else filed.unionByName(rows)
    counts = filed.groupBy("part", "value").agg(F.count("*").alias("n")).where("n > 1")
    met = scratch.keep(filed.join(counts, ["part", "value"]), "met")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            edges = [e for fps in pdf["fps"] for e in _spanning(np.asarray(fps, np.int64).view(np.uint64), tau)]
            yield pd.DataFrame(edges, columns=["a", "b"], dtype="int64")

    few = met.where(F.col("n") <= BUCKET).groupBy("part", "value").agg(F.collect_list("fp").alias("fps"))
    crowded = met.where(F.col("n") > BUCKET).select("fp").distinct()
    reach = _flips(range(BITS), (tau + 1) // 2)
    owned = len(_flips(range(BITS), tau // 2))  # the nearer ones come first
    files = crowded.select("fp", F.posexplode(F.transform(F.array(*map(F.lit, reach)), lambda x: F.col("fp").bitwiseXOR(x))).alias("k", "file"))
    shared = files.groupBy("file").agg(F.min(F.when(F.col("k") < owned, F.col("fp"))).alias("b"), F.collect_set("fp").alias("fps"))
    starred = shared.where("b IS NOT NULL AND size(fps) > 1").select("b", F.explode("fps").alias("a")).where("a <> b")
    return few.select("fps").mapInPandas(verify, "a long, b long").unionByName(starred.select("a", "b"))


def with_components(spark: SparkSession, classes: DataFrame) -> DataFrame:
    """``classes`` (fp: distinct, and more columns) with component, the smallest fingerprint reachable over links of at most TAU bits."""
    linked = components(spark, near_edges(spark, classes.select("fp"))).withColumnRenamed("node", "fp")
    return classes.join(linked, "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per row: doc_id, fp (signed long) and component_id, the smallest doc_id reachable over links of at most TAU bits.

    Texts without words all have fingerprint zero and so are one class. Null ids take
    part and never name a component unless it has no other; texts of any length are read
    whole; repeated rows repeat; an empty table gives an empty result; columns beyond
    doc_id and text are ignored, whatever their names.
    """
    scratch = Scratch(spark, "documents")
    prints = scratch.keep(fingerprints(docs), "prints")
    classes = scratch.keep(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    joined = with_components(spark, classes)
    names = joined.groupBy("component").agg(F.min("first").alias("component_id"))
    named = joined.join(names, "component").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def row_key(docs: DataFrame) -> Column:
    """A digest of the text's bytes and one of the other values: equal for equal rows alone."""
    rest = F.to_json(F.struct(F.lit(0).alias("_"), *(c for c in docs.columns if c != "text")), {"ignoreNullFields": "false"})
    return F.concat_ws(":", F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.lit("null")), F.sha2(rest, 256))


def keep_one(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row of ``docs`` of each component: the first by doc_id (null last), text digest and digest of the other values.

    Components are told apart by fingerprint, so rows without an id, or with an id that
    other texts have too, stand for their own component alone. Null and blank texts all
    have fingerprint zero, so one row of them stays; texts of any length are read whole.
    Columns of any names stay as they are; an empty table gives an empty result.
    """
    scratch = Scratch(spark, "kept")
    prints = scratch.keep(fingerprints(docs, row_key=row_key(docs)), "prints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row_key")).alias("first")
    classes = scratch.keep(prints.groupBy("fp").agg(first), "classes")
    chosen = with_components(spark, classes).groupBy("component").agg(F.min("first").alias("first")).select(F.col("first.row_key").alias("row_key"))
    keyed = docs.select(row_key(docs).alias("row_key"), F.struct(*docs.columns).alias("row"))
    # equal rows go first, within each task, and texts are dealt by row_key once for both steps
    return keyed.dropDuplicates(["row_key"]).join(chosen.hint("shuffle_hash"), "row_key", "left_semi").select("row.*")
