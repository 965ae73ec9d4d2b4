"""Ranked lexical search by a threshold-seeded join.

Texts are read once: of every document its number of terms and those of its terms that
any item asks for, with their counts, are written to the shared folder. From there on
everything works on that small forward index.

1. A pass adds up how many documents hold each term and takes its k highest impacts.
   With that many documents known to reach it, an item's k-th best score is at least the
   k-th impact of any of its terms, times the term's count in the item: its threshold.
2. An item's terms are put in falling order of their highest impact. A document that holds
   only terms of a suffix scores at most the sum of these; where that is below the
   threshold, the suffix seeds no candidates.
3. A last pass joins the other terms, with the index. Every
   document that meets one is a candidate and is scored exactly over all of the item's
   terms; each task hands on its best k of each item, of which the best k are taken.

Items come in blocks of bounded size, each with an index of its own terms, so any number
of items can be asked.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from neumata.llm.shared import Scratch

#: Fixed by contract.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
B_PART, WHOLE = 75, 100
#: Terms of the items that are ranked in one pass, and salted parts of a term's highest impacts.
ITEM_BLOCK, SALTS = 200_000, 256
#: Numbers that a batch's table of impacts, and its list of scored terms, hold.
CELLS = 1 << 21
#: What no term holds is a blank, capital letters are small ones.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(raw: bytes) -> list[bytes]:
    """The terms of a text as UTF-8, in order."""
    return raw.translate(_FOLD).split()


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, n): how often each item holds each of its terms."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), upper, upper.lower()), F.lit(TERM), F.lit(0))
    return items.select("item_id", F.explode(words).alias("term")).groupBy("item_id", "term").agg(F.count("*").alias("n"))


def _blocks(rows: DataFrame, key: str, n: int, size: int) -> Iterator[DataFrame]:
    """``rows`` by a hash of ``key``, in as many blocks as ``n`` rows of ``size`` each need."""
    blocks = max(1, -(-n // size))
    for k in range(blocks):
        yield rows.where(F.pmod(F.xxhash64(F.lit(3), key), F.lit(blocks)) == k)


def indexed(docs: DataFrame, number: Broadcast) -> DataFrame:
    """(doc_id, n_terms, terms, counts): of each document the number of its terms, and how often it holds those that ``number`` numbers."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_terms", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = number.value.get
        for batch in batches:
            n, numbers, counts, ends = [], [], [], [0]
            for text in batch["text"]:
                words = terms_of(text.as_py() or b"")
                n.append(len(words))
                found: dict[int, int] = defaultdict(int)
                for k in map(of, words, repeat(-1)):
                    found[k] += 1
                found.pop(-1, None)
                numbers += found.keys()
                counts += found.values()
                ends.append(len(numbers))
            ends = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (numbers, counts)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n, pa.int64()), *lists], schema=schema)

    return rows.mapInArrow(run, "doc_id long, n_terms long, terms array<int>, counts array<int>")


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, count) of every term of every document of a batch."""
    terms, counts = (batch[c].flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("terms", "counts"))
    row = np.repeat(np.arange(batch.num_rows), batch["terms"].value_lengths().to_numpy(zero_copy_only=False))
    return row, terms, counts


def _saturation(counts: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * counts // (1000 * counts + 8 * m)


def _lengths(n_terms: Column, n: int, total: int) -> Column:
    """m of a document."""
    return F.lit(WHOLE - B_PART) + F.expr(f"({B_PART} * n_terms * {n}L) div {max(total, 1)}L")


def term_statistics(index: DataFrame, k: int) -> DataFrame:
    """(term, df, highest, kth) of every term of ``index`` (terms, counts, m): documents that hold it, its highest saturation and
    its k-th highest, 0 if fewer hold it. Tasks count, and keep the k highest of each term; these meet in salted parts first."""
    schema = pa.schema([("term", pa.int32()), ("salt", pa.int32()), ("df", pa.int64()), ("values", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        term, value = np.empty(0, np.int64), np.empty(0, np.int64)
        df: Counter[int] = Counter()
        for batch in batches:
            row, terms, counts = _flat(batch)
            df.update(dict(zip(*(x.tolist() for x in np.unique(terms, return_counts=True)), strict=True)))
            term = np.concatenate([term, terms])
            value = np.concatenate([value, _saturation(counts, batch["m"].to_numpy(zero_copy_only=False)[row])])
            order = np.lexsort((-value, term))
            term, value = term[order], value[order]
            near = np.arange(len(term)) - np.searchsorted(term, term) < k
            term, value = term[near], value[near]
        names, starts = np.unique(term, return_index=True)
        ends = pa.array(np.append(starts, len(term)), pa.int32())
        salt = np.full(len(names), TaskContext.get().partitionId() % SALTS)
        columns = pa.array(names, pa.int32()), pa.array(salt, pa.int32()), pa.array([df[t] for t in names.tolist()], pa.int64()), pa.ListArray.from_arrays(ends, pa.array(value))
        yield pa.RecordBatch.from_arrays([*columns], schema=schema)

    rows = index.select("terms", "counts", "m").mapInArrow(run, "term int, salt int, df long, values array<long>")
    added = lambda g: g.agg(F.sum("df").alias("df"), F.slice(F.sort_array(F.flatten(F.collect_list("values")), asc=False), 1, k).alias("values"))
    whole = added(added(rows.groupBy("term", "salt")).groupBy("term"))
    return whole.select("term", "df", F.get("values", F.lit(0)).alias("highest"), F.coalesce(F.get("values", F.lit(k - 1)), F.lit(0)).alias("kth"))


def seeded(asked: DataFrame) -> DataFrame:
    """``asked`` (item_id, term, n, w, highest, kth) with threshold, what the item's k-th best score is at least, and essential:
    whether the term seeds candidates. From the first that does not on, all terms of the item together stay below its threshold."""
    of_item = Window.partitionBy("item_id")
    most, sure = F.col("n") * F.col("w") * F.col("highest"), F.col("n") * F.col("w") * F.col("kth")
    suffix = of_item.orderBy("most", F.desc("term")).rowsBetween(Window.unboundedPreceding, 0)
    rows = asked.withColumn("most", most).withColumn("threshold", F.max(sure).over(of_item)).withColumn("rest", F.sum("most").over(suffix))
    return rows.withColumn("essential", (F.col("most") > 0) & (F.col("rest") >= F.col("threshold"))).drop("most", "rest")


class Items:
    """A block of items as arrays: the terms of each one after another, and for each term the items it seeds."""

    def __init__(self, rows: list):
        self.names = list(dict.fromkeys(r["item_id"] for r in rows))
        number = {name: k for k, name in enumerate(self.names)}
        rows = sorted(rows, key=lambda r: (number[r["item_id"]], r["term"]))
        self.terms, column = np.unique([r["term"] for r in rows], return_inverse=True)
        item = np.array([number[r["item_id"]] for r in rows], np.int64)
        self.column, self.weight = column.astype(np.int64), np.array([r["n"] * r["w"] for r in rows], np.int64)
        self.starts = np.searchsorted(item, np.arange(len(self.names) + 1))
        self.threshold = np.zeros(len(self.names), np.int64)
        self.threshold[item] = [r["threshold"] for r in rows]
        seeds = np.array([r["essential"] for r in rows], bool)
        order = np.argsort(self.column[seeds], kind="stable")
        self.seeded = item[seeds][order]
        self.seed_starts = np.searchsorted(self.column[seeds][order], np.arange(len(self.terms) + 1))

    def scored(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, item, score) of every candidate of a batch that reaches its item's threshold."""
        row, terms, counts = _flat(batch)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        asked = self.terms[at] == terms
        row, at, counts = row[asked], at[asked], counts[asked]
        value = _saturation(counts, batch["m"].to_numpy(zero_copy_only=False)[row])
        step, out = max(1, CELLS // max(len(self.terms), len(self.names))), []
        for low in range(0, batch.num_rows, step):
            some = slice(*np.searchsorted(row, [low, low + step]))
            out.append(self._scored(row[some] - low, at[some], value[some], min(step, batch.num_rows - low), low))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.empty(0, np.int64),) * 3

    def _scored(self, row: np.ndarray, at: np.ndarray, value: np.ndarray, n: int, low: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        impact = np.zeros((n, len(self.terms)), np.int64)
        impact[row, at] = value
        met = np.zeros((n, len(self.names)), bool)
        size = self.seed_starts[at + 1] - self.seed_starts[at]
        upto = np.cumsum(size)
        met[np.repeat(row, size), self.seeded[np.repeat(self.seed_starts[at] - upto + size, size) + np.arange(size.sum())]] = True
        rows, items = np.nonzero(met)
        sizes = self.starts[items + 1] - self.starts[items]
        ends, out = np.cumsum(sizes), np.empty(len(rows), np.int64)
        first = 0
        while first < len(rows):  # some candidates at a time
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + CELLS, side="right")))
            length = sizes[first:last]
            start = np.cumsum(length) - length
            term = np.repeat(self.starts[items[first:last]] - start, length) + np.arange(length.sum())
            out[first:last] = np.add.reduceat(impact[np.repeat(rows[first:last], length), self.column[term]] * self.weight[term], start)
            first = last
        good = (out > 0) & (out >= self.threshold[items])
        return rows[good] + low, items[good], out[good]

    def best(self, doc_id: np.ndarray, item: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k best of each item: the highest scores, of equal ones the smallest ids."""
        order = np.lexsort((doc_id, -score, item))
        item = item[order]
        starts = np.searchsorted(item, np.arange(len(self.names) + 1))
        near = np.arange(len(item)) - starts[item] < k
        return doc_id[order][near], item[near], score[order][near]


#: Stands for a null doc_id while ids are compared: behind all others.
NAMELESS = np.iinfo(np.int64).max


def _matches(index: DataFrame, items: Items, k: int) -> DataFrame:
    """(item, doc_id, score): each task's k best documents of each item of a block; item is its number there."""
    schema = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.empty(0, np.int64),) * 3
        for batch in batches:
            row, item, score = items.scored(batch)
            ids = batch["doc_id"].fill_null(NAMELESS).to_numpy(zero_copy_only=False)[row]
            held = items.best(*(np.concatenate(x) for x in zip(held, (ids, item, score), strict=True)), k)
        ids = pa.array(held[0], mask=held[0] == NAMELESS)
        yield pa.RecordBatch.from_arrays([pa.array(held[1], pa.int32()), ids, pa.array(held[2])], schema=schema)

    return index.select("doc_id", "terms", "counts", "m").mapInArrow(run, "item int, doc_id long, score long")


def ranked(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """Per item its k best documents: item_id, rank (from 1), doc_id, score; fewer where fewer score above 0.

    Every row of ``docs`` is a document, repeated rows too; equal scores go by doc_id (a
    long), null ids last. Rows of ``items`` that share an item_id, null too, are one item with the
    terms of all; an item without terms, or with terms that no document holds, has no
    rows. Null and empty texts hold no terms; texts of any length are read whole. Empty
    tables give an empty result. Other columns are ignored.
    """
    scratch = Scratch(spark, "search")
    kind = items.schema["item_id"].dataType.simpleString()
    asked = scratch.keep(item_terms(items), "asked")
    found = [_ranked_block(scratch, docs, block, kind, k, b) for b, block in enumerate(_blocks(asked, "item_id", asked.count(), ITEM_BLOCK))]
    whole = reduce(DataFrame.unionByName, found)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return whole.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _ranked_block(scratch: Scratch, docs: DataFrame, asked: DataFrame, kind: str, k: int, b: int) -> DataFrame:
    """(item_id, doc_id, score) of a block of items: among others the k best of each."""
    spark = docs.sparkSession
    terms = sorted(r["term"] for r in asked.select("term").distinct().collect())  # about ITEM_BLOCK at most
    number = spark.sparkContext.broadcast({t.encode(): i for i, t in enumerate(terms)})
    index = scratch.keep(indexed(docs, number), f"index{b}")
    number.unpersist()
    n, total = index.agg(F.count_if(F.col("n_terms") > 0), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    index = index.withColumn("m", _lengths(F.col("n_terms"), n, total))
    statistics = scratch.keep(term_statistics(index, k), f"statistics{b}")
    weight = F.floor(1000 * F.log((2.0 * n + 2) / (2 * F.col("df") + 1))).cast("long")
    named = spark.createDataFrame(list(enumerate(terms)), "number int, term string")
    weighed = asked.join(named, "term").drop("term").withColumnRenamed("number", "term").join(statistics.withColumn("w", weight), "term")
    items = Items(seeded(weighed).collect())  # a row for each row of asked
    listed = spark.createDataFrame(list(enumerate(items.names)), f"item int, item_id {kind}")
    return _matches(index, items, k).join(F.broadcast(listed), "item").select("item_id", "doc_id", "score")
