"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, repeated in epochs. A
document's virtual finish time is the number of words its source has emitted up to
and including it, divided by the source's target. The queues are merged in order of
finish time and cut where the total budget is used up, so that every source gets its
target to within one document.

The sort is a range sort: finish times fall into turns, the turns before the cut are
taken whole, and only the turn of the cut is put in order. Running sums are two-level
too, within range buckets of the sort key plus the bounded table of bucket totals. Rows
that agree in id, source and size are one entry, an interval of its queue of which any
number of rows can be taken, so no group of copies is large anywhere. What is taken of
a queue is a prefix; one row per source says where it ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from neumata.llm.shared import Scratch, is_small, word_count

WEIGHTS = (5, 2, 1)
#: Range buckets of a source's shuffled order (three hex digits), and of the finish time in [0, 1).
KEY_DIGITS, FINISH_BUCKETS = 3, 4096
SMALL_SOURCES = 10_000


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = 3) -> DataFrame:
    """Targets per source: (source, source_rank, source_size, target).

    ``sizes`` has source and source_size. Sources by code point, null last, take the
    weights in turn and share the sum of all sizes; no target is above ``most_epochs``
    times its source's size, and the excess is shared again by weight. That is filling
    to a level: target = min(level * weight, cap), the level found from prefix sums
    over the sources sorted by cap / weight. There is one row per source here, so the
    two unpartitioned windows stay small whatever the number of documents: a million
    sources are some 50 MB in the one task that levels them.
    """
    ranked = sizes.withColumn("source_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).select(
        "source",
        "source_rank",
        "source_size",
        F.get(F.array(*map(F.lit, weights)), F.pmod("source_rank", F.lit(len(weights)))).alias("weight"),
        (F.lit(most_epochs) * F.col("source_size")).alias("cap"),
    )
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "source_rank")
    before = F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    everything = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = ranked.withColumn("level", (F.sum("source_size").over(everything) - before) / left)
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))
    return levels.withColumn("fill", F.max(fits).over(everything)).select(
        "source",
        "source_rank",
        "source_size",
        F.least(F.col("fill") * F.col("weight"), F.col("cap").cast("double")).alias("target"),
    )


def _by_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``sources`` (one row per source, null too), which is broadcast if it is small."""
    aside = sources.withColumnRenamed("source", "of_source")
    aside = F.broadcast(aside) if is_small(sources, SMALL_SOURCES) else aside
    return rows.join(aside, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")


def _key(seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def _rows_within(emitted: Column, start: Column) -> Column:
    """How many rows of an entry that starts at ``start`` end within the first ``emitted`` words of the queue."""
    return F.least(F.greatest(F.floor((emitted - start) / F.col("size")), F.lit(0)), F.col("n_rows")).cast("long")


def _plan(spark: SparkSession, docs: DataFrame, weights: tuple[int, ...], most_epochs: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Entries (doc_id, source, size, n_rows, key) and one row per source: source_size, target, full (epochs taken of every
    row), and the entry where the epoch after them breaks off: cut_key, cut_size, cut_id, of whose n_rows cut_rows are taken."""
    scratch = Scratch(spark, "mix")
    sized = scratch.keep(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
        .groupBy("doc_id", "source", "size")
        .agg(F.count("*").alias("n_rows"))
        .withColumn("key", _key(seed)),
        "sized",
    )
    words = F.col("size") * F.col("n_rows")
    targets = scratch.keep(
        source_targets(sized.groupBy("source").agg(F.sum(words).alias("source_size")), weights, most_epochs), "targets"
    )
    bucketed = sized.where("size > 0").withColumn("bucket", F.substring("key", 1, KEY_DIGITS))
    bucket_ends = Window.partitionBy("source").orderBy("bucket")
    starts = (
        bucketed.groupBy("source", "bucket")
        .agg(F.sum(words).alias("bucket_words"))
        .select(
            F.col("source").alias("at_source"),
            F.col("bucket").alias("at_bucket"),
            (F.sum("bucket_words").over(bucket_ends) - F.col("bucket_words")).alias("bucket_start"),
        )
    )
    in_bucket = Window.partitionBy("source", "bucket").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        bucketed.withColumn("running", F.sum(words).over(in_bucket))
        .join(starts, F.col("source").eqNullSafe(F.col("at_source")) & (F.col("bucket") == F.col("at_bucket")))
        .withColumn("start", F.col("bucket_start") + F.col("running") - words)
        .select("source", "doc_id", "key", "size", "n_rows", "start")
    )
    queue = scratch.keep(placed, "queue")

    # the rows of an entry by turn: those of an epoch that start before the target, in ranges of their finish time
    epochs = F.greatest(F.ceil(F.col("target") / F.col("source_size")).cast("int"), F.lit(1))
    turn_of = lambda row: F.least(
        F.floor((F.col("start") + row * F.col("size")) / F.col("target") * FINISH_BUCKETS), F.lit(2 * FINISH_BUCKETS)
    )
    last_in = lambda turn: F.least(
        F.greatest(F.ceil(((turn + 1) * F.col("target") / FINISH_BUCKETS - F.col("start")) / F.col("size")) - 1, F.lit(0)), F.col("n_rows")
    )
    queued = (
        _by_source(queue, targets)
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), epochs - 1)))
        .withColumn("start", F.col("epoch") * F.col("source_size") + F.col("start"))
        .where(F.col("start").cast("double") < F.col("target"))
        .withColumn("n_rows", F.least("n_rows", F.ceil((F.col("target") - F.col("start")) / F.col("size"))))
        .withColumn("turn", F.explode(F.sequence(turn_of(F.lit(1)), turn_of(F.col("n_rows")))))
        .withColumn("first", F.when(F.col("turn") == turn_of(F.lit(1)), 0).otherwise(last_in(F.col("turn") - 1)))
        .withColumn("last", F.when(F.col("turn") == turn_of(F.col("n_rows")), F.col("n_rows")).otherwise(last_in(F.col("turn"))))
        .where("last > first")
    )
    queued = scratch.keep(queued.select("source", "source_rank", "epoch", "key", "size", "start", "target", "turn", "first", "last"), "queued")
    turn_ends = Window.orderBy("turn")
    turns = queued.groupBy("turn").agg(F.sum((F.col("last") - F.col("first")) * F.col("size")).alias("turn_words"))
    turns = turns.select("turn", F.sum("turn_words").over(turn_ends).alias("turn_end"), "turn_words")  # 2 * FINISH_BUCKETS + 1 rows at most
    budget = F.lit(targets.agg(F.sum("source_size")).first()[0] or 0)
    turns = turns.select("turn", (F.col("turn_end") <= budget).alias("whole"), (budget - F.col("turn_end") + F.col("turn_words")).alias("room"))
    turns = scratch.keep(turns.where("room > 0"), "turns")
    met = queued.join(F.broadcast(turns), "turn")
    before = met.where("whole").groupBy("source").agg(F.sum((F.col("last") - F.col("first")) * F.col("size")).alias("taken"))
    at_cut = met.where("NOT whole").withColumn("row", F.explode(F.sequence(F.col("first") + 1, F.col("last"))))
    finish = (F.col("start") + F.col("row") * F.col("size")) / F.col("target")
    order = Window.partitionBy("turn").orderBy("finish", "source_rank", "epoch", "key", "size", "row")  # one turn at most has room and an end beyond it
    last = at_cut.withColumn("finish", finish).withColumn("running", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    taken = before.unionByName(last.where("running <= room").groupBy("source").agg(F.sum("size").alias("taken")))
    taken = taken.groupBy(F.col("source").alias("of_source")).agg(F.sum("taken").alias("taken"))
    ends = targets.join(taken, F.col("source").eqNullSafe(F.col("of_source")), "left").select(
        "source",
        "source_size",
        "target",
        F.coalesce(F.floor(F.try_divide("taken", "source_size")), F.lit(0)).cast("int").alias("full"),
        F.coalesce(F.try_mod("taken", "source_size"), F.lit(0)).alias("rest"),
    )
    ends = scratch.keep(ends, "ends")
    in_cut = (F.col("start") < F.col("rest")) & (F.col("start") + words >= F.col("rest"))  # one entry of a source
    cuts = _by_source(queue, ends.select("source", "rest")).where(in_cut).select(
        F.col("source").alias("of_source"),
        F.col("key").alias("cut_key"),
        F.col("size").alias("cut_size"),
        _rows_within(F.col("rest"), F.col("start")).alias("cut_rows"),
        F.col("n_rows").alias("cut_of"),
    )
    ends = ends.join(cuts, F.col("source").eqNullSafe(F.col("of_source")), "left").drop("of_source", "rest")
    return sized, scratch.keep(ends, "cuts")


def _before_cut() -> Column:
    """1 for entries before the one where the last epoch breaks off, 0 at and after it; null where it does not begin."""
    earlier = (F.col("key") < F.col("cut_key")) | ((F.col("key") == F.col("cut_key")) & (F.col("size") < F.col("cut_size")))
    return F.coalesce(earlier, F.lit(False)).cast("int")


def _at_cut() -> Column:
    return F.coalesce((F.col("key") == F.col("cut_key")) & (F.col("size") == F.col("cut_size")), F.lit(False))


def mix(
    spark: SparkSession, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = 3, seed: int = 1
) -> DataFrame:
    """How often the mix takes each document: (doc_id, source, size, n_rows, source_size, target, copies).

    ``docs`` needs doc_id, text and source; other columns are ignored. size is the
    number of words. n_rows rows that agree in doc_id, source and size have ``copies``
    each; where the mix breaks off among such rows, some of them have one more and make
    a result row of their own. Documents without words fill no budget and get no copies;
    a null text has no words; null sources are one source, the last; a text of any
    length counts whole. An empty table gives an empty result. Ties in the shuffled
    order are broken by size, so reruns agree.
    """
    sized, ends = _plan(spark, docs, weights, most_epochs, seed)
    rows = _by_source(sized, ends).withColumn("more", F.when(_at_cut(), F.col("cut_rows")).otherwise(_before_cut() * F.col("n_rows")))
    copies = F.when(F.col("size") > 0, F.col("full")).otherwise(0)
    share = lambda n, c: F.struct(n.alias("n_rows"), c.cast("int").alias("copies"))
    shares = F.array(share(F.col("more"), copies + 1), share(F.col("n_rows") - F.col("more"), copies))
    rows = rows.withColumn("more", F.when(F.col("size") > 0, F.col("more")).otherwise(0)).withColumn("share", F.explode(F.filter(shares, lambda s: s["n_rows"] > 0)))
    return rows.select("doc_id", "source", "size", "share.n_rows", "source_size", "target", "share.copies")


def mixed_documents(
    spark: SparkSession, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = 3, seed: int = 1
) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as the mix takes it.

    Columns are those of ``docs``, whatever their names. Texts that are null or hold no
    words have no size and are not taken; texts of any length are read whole; repeated rows,
    and rows without an id, are entries of their own; a null source is a source. An empty
    table gives an empty result.

    Texts are not shuffled: a row's copies follow from its key and its source's cut.
    Only of the one entry per source where the mix breaks off, if several rows share
    it, rows are numbered: by the row counts of the partitions they are written in,
    and within the one partition in which the cut falls.
    """
    _, ends = _plan(spark, docs, weights, most_epochs, seed)
    packed = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "source", word_count(F.col("text")).alias("size"))
    rows = _by_source(packed.withColumn("key", _key(seed)).where("size > 0"), ends)
    shared = _at_cut() & (F.col("cut_of") > 1) & (F.col("cut_rows") < F.col("cut_of"))
    more = F.when(_at_cut(), (F.col("cut_rows") > 0).cast("int")).otherwise(_before_cut())
    out = rows.where(~shared).select("row", (F.col("full") + more).alias("copies"))

    scratch = Scratch(spark, "mixed")
    split = scratch.keep(rows.where(shared).select("row", "source", "full", "cut_rows", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "split")
    if not split.isEmpty():
        ends_ = Window.partitionBy("source").orderBy("part")
        parts = split.groupBy("source", "part").agg(F.count("*").alias("n"), F.first("cut_rows").alias("cut_rows"))
        room = F.col("cut_rows") - F.sum("n").over(ends_) + F.col("n")
        parts = parts.select(F.col("source").alias("of_source"), F.col("part").alias("of_part"), room.alias("room"), (room >= F.col("n")).alias("whole"))
        met = split.join(parts, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("part") == F.col("of_part")))
        broken = (F.col("room") > 0) & ~F.col("whole")  # one partition of a source
        nth = F.row_number().over(Window.partitionBy("source", "part").orderBy("at"))
        some = met.where(broken).select("row", "full", (nth <= F.col("room")).cast("int").alias("more"))
        rest = met.where(~broken).select("row", "full", F.col("whole").cast("int").alias("more"))
        out = out.unionByName(some.unionByName(rest).select("row", (F.col("full") + F.col("more")).alias("copies")))
    return out.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
