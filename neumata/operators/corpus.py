"""Corpus operators: gates, keep-one policies, versions, ledgers, merges and checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from neumata.functions import titles
from neumata.shared import folder


def keep_one(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key by ``order``; a maximum that combines before its shuffle, so no group is sorted in one place.

    ``order`` is of columns that sort ascending; give numbers negated for descending.
    """
    rest = [c for c in rows.columns if c not in keys]
    first = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("kept"), F.count("*").alias("n_rows"))
    return first.select(*keys, "kept.*", "n_rows")


def top_share(digits: Column) -> Column:
    """struct(top, degrees): occurrences of the most frequent degree, and how many degrees occur."""
    counts = F.array(*(F.length(digits) - F.length(F.replace(digits, F.lit(str(d)), F.lit(""))) for d in range(1, 8)))
    return F.struct(F.array_max(counts).alias("top"), F.size(F.filter(counts, lambda c: c > 0)).alias("degrees"))


def junk_tier(n: Column, n_tokens: Column, top: Column, degrees: Column) -> Column:
    """short, junk, suspect or fine: by note density and by how far one degree dominates.

    Scores of less than 20 tokens are not judged; of those with less than 20 notes only the density counts.
    """
    ratio, share = n / n_tokens, top / n
    long_ = (
        F.when((share >= 0.9) | (ratio < 0.25) | (degrees <= 2), "junk").when((share >= 0.5) | (ratio < 0.35), "suspect").otherwise("fine")
    )
    few = F.when(ratio < 0.25, "junk").when(ratio < 0.35, "suspect").otherwise("fine")
    return F.when(n_tokens < 20, "short").when(n < 20, few).otherwise(long_)


def bag_agreement(a: Column, b: Column) -> Column:
    """1 - |difference of the degree bags| / longer length, at least 0; 0 if either is empty."""
    count = lambda s, d: F.length(s) - F.length(F.replace(s, F.lit(str(d)), F.lit("")))
    apart = sum((F.abs(count(a, d) - count(b, d)) for d in range(1, 8)), F.lit(0))
    both = (F.length(a) > 0) & (F.length(b) > 0)
    return F.when(both, F.greatest(F.lit(0.0), F.round(1 - apart / F.greatest(F.length(a), F.length(b)), 6))).otherwise(0.0)


def bag_overlap(a: Column, b: Column) -> Column:
    """Size of the multiset intersection of two degree strings."""
    count = lambda s, d: F.length(s) - F.length(F.replace(s, F.lit(str(d)), F.lit("")))
    return sum((F.least(count(a, d), count(b, d)) for d in range(1, 8)), F.lit(0))


def in_ranges(rows: DataFrame, at: str, ranges: int = 1024) -> DataFrame:
    """``rows`` with range, equal parts of the span of a number or time column. Ordered work is done within (key, range), with what the
    ranges before leave over, so that a key with any share of the rows is spread over tasks."""
    low, high = rows.agg(F.min(F.col(at).cast("double")), F.max(F.col(at).cast("double"))).first()
    width = max(((high or 0.0) - (low or 0.0)) / ranges, 1e-6)
    return rows.withColumn("range", F.coalesce(F.floor((F.col(at).cast("double") - (low or 0.0)) / width), F.lit(-1)))


def carried(ranged: DataFrame, key: str, total: Column, carry: Callable[[Column], Column], backward: bool = False) -> DataFrame:
    """``ranged`` with before: ``carry`` of the ``total`` of each earlier range of the key (later ones if ``backward``); null in the first."""
    order = F.desc("range") if backward else F.col("range")
    ends = ranged.groupBy(key, "range").agg(total.alias("total"))
    before = carry(F.col("total")).over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    ends = ends.select(F.col(key).alias("of_key"), F.col("range").alias("of_range"), before.alias("before"))
    return ranged.join(ends, F.col(key).eqNullSafe(F.col("of_key")) & (F.col("range") == F.col("of_range"))).drop("of_key", "of_range")


def within_budget(rows: DataFrame, key: str, size: str, at: str, tie: str, budget: int) -> DataFrame:
    """``rows`` with kept: whether the newest rows of the key, up to and including this one, fit into ``budget``."""
    ranged = carried(in_ranges(rows, at), key, F.sum(size), F.sum, backward=True)
    newest = Window.partitionBy(key, "range").orderBy(F.desc(at), F.desc(tie)).rowsBetween(Window.unboundedPreceding, 0)
    return ranged.withColumn("kept", F.sum(size).over(newest) + F.coalesce("before", F.lit(0)) <= budget).select(*rows.columns, "kept")


def as_of(rows: DataFrame, value: Column, key: str, at: str, tie: str, name: str) -> DataFrame:
    """``rows`` with the last non-null ``value`` at or before each row of its key: an as-of join of two streams in one table."""
    held = rows.withColumn(name, value)
    last = F.max(F.when(F.col(name).isNotNull(), F.struct(at, tie, name)))
    ranged = carried(in_ranges(held, at), key, last, lambda t: F.last(t, ignorenulls=True))
    here = F.last(name, ignorenulls=True).over(Window.partitionBy(key, "range").orderBy(at, tie).rowsBetween(Window.unboundedPreceding, 0))
    return ranged.withColumn("here", here).select(*rows.columns, F.coalesce("here", F.col("before")[name]).alias(name))


def sessions(rows: DataFrame, key: str, at: str, tie: str, gap_s: int) -> DataFrame:
    """(key, session, n, first_at, last_at): runs of rows of a key with no gap over ``gap_s`` seconds; sessions count from 1."""
    ranged = carried(in_ranges(rows.select(key, at, tie), at), key, F.max(at), F.max)
    w = Window.partitionBy(key, "range").orderBy(at, tie)
    gap = F.col(at).cast("double") - F.coalesce(F.lag(at).over(w), F.col("before")).cast("double")
    marked = ranged.withColumn("new", F.coalesce(gap > gap_s, F.lit(True)).cast("long")).drop("before")
    counted = carried(marked, key, F.sum("new"), F.sum)
    session = F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)) + F.coalesce("before", F.lit(0))
    numbered = counted.withColumn("session", session)
    return numbered.groupBy(key, "session").agg(F.count("*").alias("n"), F.min(at).alias("first_at"), F.max(at).alias("last_at"))


def monophony(spans: DataFrame, key: str, tie: str) -> DataFrame:
    """(key, n, mono): the share of spans (a, b) that begin after all earlier ones of their key have ended."""
    ranged = carried(in_ranges(spans, "a"), key, F.max("b"), F.max)
    w = Window.partitionBy(key, "range").orderBy("a", tie).rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.greatest(F.max("b").over(w), F.col("before"))
    rows = ranged.withColumn("alone", F.when(F.coalesce(earlier > F.col("a"), F.lit(False)), 0.0).otherwise(1.0))
    return rows.groupBy(key).agg(F.count("*").alias("n"), F.round(F.avg("alone"), 6).alias("mono"))


def blank_filled(rows: DataFrame, found: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``rows`` whose null or empty ``columns`` are taken from ``found``; what is there already stays."""
    other = found.select(key, *(F.col(c).alias(f"found_{c}") for c in columns))
    filled = {c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"found_{c}")) for c in columns}
    return rows.join(other, key, "left").withColumns(filled).select(*rows.columns)


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(kind, n) over (name, digest) tables: same, changed, renamed, removed and added names.

    A name that went is renamed if its digest came under a new name; each side counts a digest once.
    """
    both = before.withColumnRenamed("digest", "old").join(after.withColumnRenamed("digest", "new"), "name", "full")
    kept = both.where("old IS NOT NULL AND new IS NOT NULL").select(F.when(F.col("old") == F.col("new"), "same").otherwise("changed").alias("kind"))
    gone, came = both.where("new IS NULL").select("old"), both.where("old IS NULL").select(F.col("new").alias("old"))
    sides = gone.groupBy("old").agg(F.count("*").alias("g"), F.lit(0).cast("long").alias("c")).unionByName(
        came.groupBy("old").agg(F.lit(0).cast("long").alias("g"), F.count("*").alias("c"))
    )
    pair = sides.groupBy("old").agg(F.sum("g").alias("g"), F.sum("c").alias("c")).withColumn("r", F.least("g", "c"))
    moved = pair.agg(F.sum("r").alias("renamed"), F.sum(F.col("g") - F.col("r")).alias("removed"), F.sum(F.col("c") - F.col("r")).alias("added"))
    rows = moved.select(F.explode(F.create_map(*(x for c in moved.columns for x in (F.lit(c), F.coalesce(c, F.lit(0).cast("long")))))).alias("kind", "n"))
    return kept.groupBy("kind").agg(F.count("*").alias("n")).unionByName(rows)


def rule_counts(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, broken, n): how many rows break each rule, in one pass; an unknown outcome counts as broken."""
    counts = rows.agg(F.count("*").alias("n"), *(F.count_if(~F.coalesce(ok, F.lit(False))).alias(f"r{k}") for k, ok in enumerate(rules.values())))
    each = F.explode(F.array(*(F.struct(F.lit(name).alias("rule"), F.col(f"r{k}").alias("broken")) for k, name in enumerate(rules))))
    return counts.select(each.alias("x"), "n").select("x.*", "n")


def closure(spark: SparkSession, edges: DataFrame, most: int = 100) -> DataFrame:
    """(ancestor, child, depth): every path of ``edges`` (parent, child), of any number of rows.

    One join a level; levels are written to the shared folder. Edges that go deeper than
    ``most`` levels, as those of a cycle do, are an error.
    """
    keep = folder(spark, "closure")
    edges = keep(edges.select("parent", "child").where("parent IS NOT NULL AND child IS NOT NULL"), "edges")
    level = edges.select(F.col("parent").alias("ancestor"), "child", F.lit(1).alias("depth"))
    out, depth = level, 1
    steps = edges.select(F.col("parent").alias("child"), F.col("child").alias("next"))
    while True:
        level = level.join(steps, "child").select("ancestor", F.col("next").alias("child"), F.lit(depth + 1).alias("depth"))
        level = keep(level, str(depth + 1))
        if level.isEmpty():
            return out
        if depth == most:
            raise ValueError(f"edges go deeper than {most} levels")
        out, depth = out.unionByName(level), depth + 1


def nearest_ranks(counts: DataFrame, key: str, value: str, ranks: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """(key, one column per rank): the value at each 1-based rank of its group, where ``counts`` has k rows of each value.

    The window runs over different values, whose running counts place the ranks.
    """
    w = Window.partitionBy(key).orderBy(value)
    all_ = F.sum("k").over(Window.partitionBy(key))
    placed = counts.withColumns({"upto": F.sum("k").over(w.rowsBetween(Window.unboundedPreceding, 0)), "all": all_})
    return placed.groupBy(key).agg(*(F.min(F.when(F.col("upto") >= rank(F.col("all")), F.col(value))).alias(name) for name, rank in ranks.items()))


def field_profile(rows: DataFrame) -> DataFrame:
    """(field, present, filled, n): non-null and non-empty values of every column, in one pass."""
    texts = {f.name for f in rows.schema if f.dataType.typeName() == "string"}
    filled = lambda c: F.nullif(F.col(c), F.lit("")) if c in texts else F.col(c)
    sums = rows.agg(F.count("*").alias("n"), *(f for k, c in enumerate(rows.columns) for f in (F.count(c).alias(f"p{k}"), F.count(filled(c)).alias(f"f{k}"))))
    each = F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"p{k}").alias("present"), F.col(f"f{k}").alias("filled")) for k, c in enumerate(rows.columns)))
    return sums.select(F.explode(each).alias("x"), "n").select("x.*", "n")


def numbered_within(rows: DataFrame, keys: list[str], order: str, ranges: int = 4096) -> DataFrame:
    """``rows`` with nth, 1-based in each key's order of a number column: counted within ranges of the number plus the totals of the
    ranges before, so that a key with any share of the rows is spread over tasks."""
    low, high = rows.agg(F.min(order), F.max(order)).first()
    width = max(1, ((high or 0) - (low or 0)) // ranges + 1)
    ranged = rows.withColumn("range", F.expr(f"({order} - {low or 0}) div {width}"))
    totals = ranged.groupBy(*keys, "range").agg(F.count("*").alias("k"))
    before = totals.withColumn("before", F.sum("k").over(Window.partitionBy(*keys).orderBy("range")) - F.col("k")).drop("k")
    nth = F.row_number().over(Window.partitionBy(*keys, "range").orderBy(order)) + F.col("before")
    return ranged.join(before, [*keys, "range"]).withColumn("nth", nth).drop("range", "before")
