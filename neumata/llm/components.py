"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step is an aggregation (combined before its shuffle) and a join (whose hot keys
adaptive execution splits), so a hub of any degree is never gathered in one place.
Edges are written to the shared folder after every round, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from neumata.llm.shared import Scratch


def _sum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "to"))).first())


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long): component is the smallest node reachable.

    Loops and repeated edges do no harm; nodes with null ends are left out; no edges
    give an empty table.
    """
    scratch = Scratch(spark, "components")
    ends = edges.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("to"))
    now = scratch.keep(ends.distinct(), "0")
    seen, step = _sum(now), 0
    while seen[0]:
        both = now.union(now.select("to", "node"))
        least = both.groupBy("node").agg(F.min("to").alias("low")).select("node", F.least("node", "low").alias("low"))
        large = both.join(least, "node").where("to > node").select(F.col("to").alias("node"), F.col("low").alias("to"))
        large = scratch.keep(large.distinct(), f"large{step}")
        low = large.groupBy("node").agg(F.min("to").alias("low"))
        small = large.join(low, "node").where("to <> low").select(F.col("to").alias("node"), F.col("low").alias("to"))
        after = scratch.keep(small.union(low).distinct(), f"{step + 1}")
        sums = _sum(after)
        scratch.drop(f"{step}")
        scratch.drop(f"large{step}")
        now, step = after, step + 1
        if sums == seen:
            break
        seen = sums
    roots = now.select(F.col("to").alias("node")).distinct()
    return now.select("node", F.col("to").alias("component")).union(roots.select("node", F.col("node").alias("component")))
