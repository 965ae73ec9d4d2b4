"""Sharding by a Feistel permutation over global row numbers.

Rows are numbered 0 to n - 1 in the order of a hash of their values. A keyed Feistel
network permutes that range: place = permute(number). Shard and slot are then
arithmetic, place mod shards and place div shards, so counts differ by one at most,
slots have no gaps, a new seed is a new shuffle, and ``row_of`` gives back the number
of the row at any shard and slot without a look at the data.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from neumata.llm.shared import Scratch

ROUNDS = 4
#: Hash ranges that rows are numbered in; the table of their counts is all that is summed in one place.
RANGES = 4096
#: Equal rows that are numbered as one item.
CHUNK = 4096


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit finaliser, keyed."""
    x = x.astype(np.uint64) + np.uint64((key * 0x9E3779B97F4A7C15) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sides(n: int) -> tuple[np.uint64, np.uint64]:
    left = isqrt(max(n - 1, 0)) + 1
    return np.uint64(left), np.uint64(-(-n // left) or 1)


def _network(x: np.ndarray, n: int, seed: int, back: bool) -> np.ndarray:
    """A Feistel network on pairs (l, r), l < a and r < b, with a * b barely over n: halves are added to in turn."""
    a, b = _sides(n)
    left, right = x // b, x % b
    for k in reversed(range(ROUNDS)) if back else range(ROUNDS):
        key = seed * ROUNDS + k + 1
        if k % 2:
            turn = _mix(left, key) % b
            right = (right + (b - turn if back else turn)) % b
        else:
            turn = _mix(right, key) % a
            left = (left + (a - turn if back else turn)) % a
    return left * b + right


def permute(x: np.ndarray, n: int, seed: int, back: bool = False) -> np.ndarray:
    """The place of each number below n, or with ``back`` the number at each place. Values that the
    network sends to n or above walk on along their cycle until they are below n again."""
    out = _network(np.asarray(x).astype(np.uint64), n, seed, back)
    while (far := out >= np.uint64(n)).any():
        out[far] = _network(out[far], n, seed, back)
    return out.astype(np.int64)


def row_of(shard: np.ndarray, slot: np.ndarray, n: int, shards: int, seed: int = 1) -> np.ndarray:
    """The global number of the row at a shard and slot."""
    return permute(np.asarray(slot) * shards + np.asarray(shard), n, seed, back=True)


def numbered(spark: SparkSession, rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` with ``number``, 0 to n - 1 in the order of (hash of the columns, columns), and n.

    Equal rows are interchangeable, so they are counted first and numbered as one item,
    or as several of CHUNK rows each, and written out at the end. Numbers count within
    hash ranges and add the total of the ranges before; the hash is of all columns and
    the chunk, so neither one id nor one row that is often there fills a range. Nulls in
    any column sort first.
    """
    names = rows.columns
    items = rows.groupBy(*names).agg(F.count("*").alias("n_equal"))
    items = items.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n_equal - 1) div {CHUNK}"))))
    items = items.withColumn("n_equal", F.least(F.col("n_equal") - F.col("chunk") * CHUNK, F.lit(CHUNK))).withColumn("hash", F.xxhash64(F.lit(7), "chunk", *names))
    kept = Scratch(spark, "number").keep(items, "items")
    ranged = kept.withColumn("range", F.shiftright(F.col("hash"), 52))
    counts = ranged.groupBy("range").agg(F.sum("n_equal").alias("n"))  # RANGES rows at most
    n = counts.agg(F.sum("n")).first()[0] or 0
    before = counts.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))
    order = Window.partitionBy("range").orderBy("hash", "chunk", *names).rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.withColumn("end", F.sum("n_equal").over(order)).join(F.broadcast(before), "range")
    last = F.col("before") + F.col("end") - 1
    return out.select(*names, F.explode(F.sequence(last - F.col("n_equal") + 1, last)).alias("number")), n


def sharded(spark: SparkSession, docs: DataFrame, shards: int = 8, seed: int = 1) -> DataFrame:
    """Per row: doc_id, size, text_crc32, number, shard and slot.

    size is the text's UTF-8 bytes plus 1, and a null text has none. Counts of shards
    differ by one at most. Rows repeat as they do in the input, null and repeated ids
    too; texts of any length count whole; an empty table gives an empty result; columns
    beyond doc_id and text are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows, n = numbered(spark, rows)

    @F.pandas_udf("long")
    def place(number: pd.Series) -> pd.Series:
        return pd.Series(permute(number.to_numpy(), n, seed))

    return rows.withColumn("place", place("number")).select(
        *rows.columns,
        F.pmod("place", F.lit(shards)).cast("int").alias("shard"),
        F.expr(f"place div {shards}").alias("slot"),
    )
