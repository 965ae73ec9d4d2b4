"""Work in rounds that a ledger remembers: what has been done goes on from where the last success left it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _rounds(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows of committed rounds: only folders that the commit has named count, whatever else lies there."""
    done = [r["folder"] for r in spark.read.schema("folder string").json(f"{path}/commits").collect()] if _exists(spark, f"{path}/commits") else []
    return spark.read.schema(schema).parquet(*(f"{path}/{d}" for d in done)) if done else spark.createDataFrame([], schema)


def _commit(spark: SparkSession, path: str, rows: DataFrame, crash: Callable[[], None] = lambda: None) -> None:
    """Write rows, then one line that names their folder; what fails before the line has never been."""
    name = f"rows-{uuid.uuid4().hex}"
    rows.write.parquet(f"{path}/{name}")
    crash()
    spark.createDataFrame([(name,)], "folder string").coalesce(1).write.mode("append").json(f"{path}/commits")


def recomputed(spark: SparkSession, inputs: DataFrame, key: str, used: list[Column], compute: Callable[[DataFrame], DataFrame], path: str, version: int = 1) -> DataFrame:
    """The results of all ``inputs``, of which only those are computed whose ``used`` values (or the version) differ from when they
    were last, or that are new; those of inputs that have gone are left out.

    ``compute`` takes the rows of inputs and gives a row for each, with ``key``. Results stand in ``path`` beside a
    fingerprint of their input; a run adds what it has computed as one round, and the last round of a key counts.
    """
    marked = inputs.withColumn("_mark", F.xxhash64(F.lit(version), *used))
    results = compute(inputs.limit(0))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in results.schema) + ", _mark long, _round long"
    held = _rounds(spark, path, schema)
    last = held.groupBy(key).agg(F.max_by(F.struct(*results.columns, "_mark"), "_round").alias("r")).select("r.*")
    stale = marked.join(last.select(key, "_mark"), [key, "_mark"], "left_anti")
    n = (held.agg(F.max("_round")).first()[0] or 0) + 1
    fresh = compute(stale.drop("_mark")).join(stale.select(key, "_mark"), key).withColumn("_round", F.lit(n).cast("long"))
    _commit(spark, path, fresh.select(*results.columns, "_mark", "_round"))
    every = _rounds(spark, path, schema)
    newest = every.groupBy(key).agg(F.max_by(F.struct(*results.columns, "_mark"), "_round").alias("r")).select("r.*")
    return newest.join(marked.select(key, "_mark"), [key, "_mark"], "left_semi").drop("_mark")


def last_round_size(spark: SparkSession, path: str, schema: str) -> int:
    """How many rows the last round has computed."""
    rounds = _rounds(spark, path, schema)
    return rounds.groupBy("_round").agg(F.count("*").alias("n")).agg(F.coalesce(F.max_by("n", "_round"), F.lit(0))).first()[0]


def next_batch(spark: SparkSession, candidates: DataFrame, path: str, size: int) -> DataFrame:
    """The batch that is next: of candidates (id, source, worth) not yet done the ``size`` that should be, sources in turn.

    A source's debt is how far it is behind the source that has had most; the k-th of a source counts as that many turns later, so the one
    in debt goes first, and within a source the worthiest, the smallest id of equals. What is next depends on what has been committed alone:
    after a failure the same batch is taken again.
    """
    done = _rounds(spark, path, "id long, source string")
    had = done.groupBy("source").agg(F.count("*").alias("had"))
    open_ = candidates.join(done.select("id"), "id", "left_anti")
    of_source = Window.partitionBy("source").orderBy(F.desc("worth"), "id")
    first = open_.withColumn("_place", F.row_number().over(of_source)).where(F.col("_place") <= size)  # cut to size before the shuffle
    turn = F.col("_place") + F.coalesce("had", F.lit(0))
    return first.join(had, "source", "left").withColumn("turn", turn).orderBy("turn", F.desc("worth"), "source", "id").limit(size).select("id", "source", "worth", "turn")


def take_round(spark: SparkSession, candidates: DataFrame, path: str, size: int, work: Callable[[DataFrame], None], crash: Callable[[], None] = lambda: None) -> int:
    """Do the next batch and move on: ``work`` gets it, and only when that has succeeded is it committed. Returns how many were done."""
    batch = next_batch(spark, candidates, path, size).cache()
    try:
        n = batch.count()
        if n:
            work(batch)
            _commit(spark, path, batch.select(F.col("id").cast("long").alias("id"), "source"), crash)
        return n
    finally:
        batch.unpersist()
