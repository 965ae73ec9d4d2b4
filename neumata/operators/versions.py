"""Versions of a title: how far each agrees with all others, which is best, and which old name each keeps."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from neumata.operators.corpus import nearest_ranks
from neumata.shared import folder

#: Different bags of a title that are compared in one go.
BLOCK = 512
# Weights of consensus, of readable signs and of length, and the share of unreadable ones that leaves nothing.
CONSENSUS, READABLE, LENGTH, MOST_UNREAD = 0.5, 0.3, 0.2, 0.10


@F.pandas_udf(ArrayType(DoubleType()))
def _agreement(mine: pd.Series, theirs: pd.Series, times: pd.Series) -> pd.Series:
    """Of two blocks of bags (counts one after another, DEGREES a bag): the agreement of each of mine with all of theirs, each as often as it is there."""

    def added(a, b, n) -> list[float]:
        a, b, n = (np.asarray(x, np.int64) for x in (a, b, n))
        a, b = a.reshape(-1, 7), b.reshape(-1, 7)
        size_a, size_b = a.sum(1), b.sum(1)
        apart = sum(np.abs(a[:, k, None] - b[None, :, k]) for k in range(7))
        longest = np.maximum(size_a[:, None], size_b[None, :])
        alike = np.where((size_a[:, None] > 0) & (size_b[None, :] > 0), np.maximum(0.0, 1 - apart / np.maximum(longest, 1)), 0.0)
        return (alike * n).sum(1).tolist()

    return pd.Series([added(a, b, n) for a, b, n in zip(mine, theirs, times, strict=True)])


def consensus(spark: SparkSession, songs: DataFrame) -> DataFrame:
    """(title, song_id, cons): the mean agreement of each version's degrees with those of all other versions of its title, 1 if it has none.

    Agreement is one less the degrees that differ, as bags, over the longer length. Versions of equal bags are one class;
    classes stand in blocks, and blocks meet blocks, so a title of any size is spread over tasks, and only a
    number a class and block comes out, no pairs. ``songs`` has title, song_id and digits.
    """
    keep = folder(spark, "consensus")
    bag = F.array(*(F.length("digits") - F.length(F.replace("digits", F.lit(str(d)), F.lit(""))) for d in range(1, 8)))
    bags = keep(songs.select("title", "song_id", F.coalesce("digits", F.lit("")).alias("digits")).select("title", "song_id", bag.alias("bag")), "bags")
    classes = bags.groupBy("title", "bag").agg(F.count("*").alias("n"))
    sizes = classes.groupBy("title").agg(F.count("*").alias("classes"), F.sum("n").alias("versions"))
    dealt = classes.join(sizes, "title").withColumn("block", F.pmod(F.xxhash64("bag"), F.expr(f"(classes + {BLOCK - 1}) div {BLOCK}")))
    item = F.array_sort(F.collect_list(F.struct("bag", "n")))  # about BLOCK classes
    blocks = keep(dealt.groupBy("title", "block").agg(item.alias("c"), F.first("versions").alias("versions")), "blocks")
    flat = F.flatten(F.transform("c", lambda x: x["bag"]))
    mine = blocks.select("title", "versions", "block", F.transform("c", lambda x: x["bag"]).alias("bags"), flat.alias("mine"))
    theirs = blocks.select("title", F.col("block").alias("other"), flat.alias("theirs"), F.transform("c", lambda x: x["n"]).alias("times"))
    met = mine.join(theirs, "title").repartition("title", "block", "other")
    rows = met.select("title", "versions", F.explode(F.arrays_zip("bags", _agreement("mine", "theirs", "times").alias("sums"))).alias("x"))
    sums = rows.groupBy("title", "versions", F.col("x.bags").alias("bag")).agg(F.sum("x.sums").alias("all"))
    own = F.when(F.aggregate("bag", F.lit(0).cast("long"), lambda a, b: a + b) > 0, 1.0).otherwise(0.0)
    means = sums.select("title", "bag", F.when(F.col("versions") > 1, (F.col("all") - own) / (F.col("versions") - 1)).otherwise(1.0).alias("cons"))
    return bags.join(means, ["title", "bag"]).select("title", "song_id", "cons")


def scored(spark: SparkSession, songs: DataFrame) -> DataFrame:
    """(title, song_id, cons, dev, score): each version by consensus, share of readable signs and nearness to the median length (the
    upper one). ``songs`` has title, song_id, digits and unread, the share of unreadable signs.
    """
    length = F.length(F.coalesce("digits", F.lit("")))
    sized = songs.select("title", "song_id", length.alias("n"), "unread")
    counts = sized.groupBy("title", "n").agg(F.count("*").alias("k"))
    medians = nearest_ranks(counts, "title", "n", {"median": lambda n: F.floor(n / 2) + 1})
    median = F.greatest("median", F.lit(1))
    rows = sized.join(medians, "title").join(consensus(spark, songs), ["title", "song_id"]).withColumn("dev", F.abs(F.col("n") - median) / median)
    at_least = lambda c: F.greatest(F.lit(0.0), c)
    score = CONSENSUS * F.col("cons") + READABLE * at_least(1 - F.col("unread") / MOST_UNREAD) + LENGTH * at_least(1 - F.col("dev"))
    return rows.select("title", "song_id", "cons", "dev", score.alias("score"))


def best_of_title(scores: DataFrame) -> DataFrame:
    """The version of the highest score of each title (to nine places), the first of equals: a maximum, combined before its shuffle."""
    best = scores.groupBy("title").agg(F.max(F.struct(F.round("score", 9).alias("score"), (-F.col("song_id")).alias("less"))).alias("b"), F.count("*").alias("versions"))
    return best.select("title", (-F.col("b.less")).alias("song_id"), "b.score", "versions")


def numbered_in_ranges(spark: SparkSession, rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``rows`` with nth, from 1 in each key's order, of values of any kind: rows are dealt into ranges of (key, order), numbered
    there, and what a key has in the ranges before is added, so a key with any share of the rows is spread over tasks."""
    ranged = folder(spark, "ranges")(rows.repartitionByRange(key, *order).withColumn("_range", F.spark_partition_id()), "ranged")
    totals = ranged.groupBy(key, "_range").agg(F.count("*").alias("_k"))
    before = totals.withColumn("_before", F.sum("_k").over(Window.partitionBy(key).orderBy("_range")) - F.col("_k")).drop("_k")
    nth = F.row_number().over(Window.partitionBy(key, "_range").orderBy(*order)) + F.col("_before")
    return ranged.join(before, [key, "_range"]).withColumn("nth", nth.cast("long")).drop("_range", "_before")


def claims(spark: SparkSession, old: DataFrame, new: DataFrame) -> DataFrame:
    """(new_name, old_name): each new name with the old name it keeps: of those of one content (digest) the k-th takes the k-th.

    ``old`` and ``new`` have digest and name, each name once; names in order. What has no content claims nothing, and names beyond the
    other side's number stay as they are and are left out.
    """
    side = lambda df, c: numbered_in_ranges(spark, df.where("digest IS NOT NULL").select("digest", F.col("name").alias(c)), "digest", [c])
    return side(new, "new_name").join(side(old, "old_name"), ["digest", "nth"]).select("new_name", "old_name")
