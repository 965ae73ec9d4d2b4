"""Melody search: window scans, n-gram index joins, seed joins and rankings.

Queries are short lists and songs are many: a query side is broadcast only if its size
is checked, otherwise both sides shuffle on their grams. Results carry counts or the
best window per song, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from neumata.functions import melody, nearness

#: Rows up to which a query table is broadcast.
FEW = 10_000


def few(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it has FEW rows at most; as it is otherwise."""
    return F.broadcast(df) if df.limit(FEW + 1).count() <= FEW else df


def grams(songs: DataFrame, n: int, *columns: str) -> DataFrame:
    """(song_id, columns, pos from 0, gram): every window of n symbols."""
    return songs.select("song_id", *columns, F.posexplode(melody.ngrams(F.col("digits"), n)).alias("pos", "gram"))


def numbered_grams(songs: DataFrame, n: int, *columns: str) -> DataFrame:
    """``grams`` with each window as a number, its decimal reading: exact for n of 18 at most, and cheap to group and join."""
    if n > 18:
        raise ValueError("a long holds 18 symbols")
    return grams(songs, n, *columns).withColumn("gram", F.col("gram").cast("long"))


def differing(window: Column, query: str | Column, n: int) -> Column:
    """Symbols in which two strings of n symbols differ; plain comparisons, so that they compile into one loop."""
    other = (lambda k: F.lit(query[k - 1])) if isinstance(query, str) else (lambda k: F.substring(query, k, 1))
    return sum(((F.substring(window, k, 1) != other(k)).cast("int") for k in range(1, n + 1)), F.lit(0))


def best_of(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` (keys, diff, pos) reduced to the least diff of each key and where it first occurs.

    Both are packed into one number, which hash aggregation can update in place; a struct would be sorted.
    """
    packed = (F.col("diff").cast("long") * F.lit(1 << 32) + F.col("pos")).alias("b")
    best = rows.select(*keys, packed).groupBy(*keys).agg(F.min("b").alias("b"))
    return best.select(*keys, F.shiftright("b", 32).cast("int").alias("diff"), F.col("b").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("pos"))


def scan(songs: DataFrame, queries: str | list[str], *columns: str, symbols: str = "digits") -> DataFrame:
    """(song_id, columns, diff, pos, at): the best window of each song over one or several queries, the first of equals,
    and the starts of all that are as good. Songs shorter than every query are left out. Nothing is shuffled."""
    best = melody.best_windows(F.col(symbols), [queries] if isinstance(queries, str) else queries)
    rows = songs.select("song_id", *columns, best.alias("b")).where("b.diff IS NOT NULL")
    return rows.select("song_id", *columns, "b.diff", F.get("b.at", F.lit(0)).alias("pos"), "b.at")


def placed_by_section(hits: DataFrame, n: int) -> DataFrame:
    """``hits`` (at: equally good starts; sections) with pos, sec_w and section of the weightiest place, the first of equals."""
    rated = F.transform("at", lambda p: F.struct(melody.section_at(F.col("sections"), p, n).alias("s"), p.alias("pos")))
    order = lambda x: F.struct((-F.coalesce(x["s"]["weight"], F.lit(1.0))).alias("less"), x["pos"].alias("pos"), F.coalesce(x["s"]["name"], F.lit("")).alias("name"))
    best = hits.withColumn("best", F.array_min(F.transform(rated, order)))
    return best.withColumns({"pos": F.col("best.pos"), "sec_w": -F.col("best.less"), "section": F.col("best.name")}).drop("best")


def listed_hits(songs: DataFrame, query: str, most: int, cap: int = 96) -> DataFrame:
    """(song_id, pos, diff, best): windows within ``most`` errors, the first ``cap`` of a song, and the least errors of all of them."""
    rows = songs.select("song_id", melody.near_windows(F.col("digits"), query, most).alias("hits")).where(F.size("hits") > 0)
    rows = rows.select("song_id", F.array_min(F.transform("hits", lambda h: h["diff"])).alias("best"), F.explode(F.slice("hits", 1, cap)).alias("h"))
    return rows.select("song_id", "h.pos", "h.diff", "best")


def aligned_songs(songs: DataFrame, segments: list[str], most: int = 0, cap: int = 96, most_gap: int = 8) -> DataFrame:
    """(song_id, diff, at): songs that hold all segments; at are their starts as one phrase, null where they make none.

    diff is the largest of the least errors of the segments; ``cap`` places of a segment are tried.
    """
    names = [f"found{k}" for k in range(len(segments))]
    rows = songs.select("song_id", *(melody.near_windows(F.col("digits"), q, most).alias(c) for c, q in zip(names, segments, strict=True)))
    for c in names:
        rows = rows.where(F.size(c) > 0)
    least = F.greatest(*(F.array_min(F.transform(c, lambda h: h["diff"])) for c in names), F.lit(0))
    return rows.select("song_id", least.alias("diff"), melody.aligned(segments, [F.slice(c, 1, cap) for c in names], most_gap)["at"].alias("at"))


def exact_hits(songs: DataFrame, queries: DataFrame, n: int) -> DataFrame:
    """(query_id, song_id, n_hits, first_pos, last_pos) of queries of n symbols, overlapping hits included."""
    hits = grams(songs, n).join(few(queries.withColumnRenamed("q", "gram")), "gram")
    return hits.groupBy("query_id", "song_id").agg(
        F.count("*").alias("n_hits"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos")
    )


def seed_search(songs: DataFrame, queries: DataFrame, n: int, errors: int) -> DataFrame:
    """(query_id, song_id, diff, pos): the best window within ``errors`` of each query of n symbols; none beyond.

    A window within ``errors`` meets one of errors + 1 blocks exactly. Blocks of FEW queries go over all songs, whose windows
    are looked up under their blocks where the songs are; those that meet a query are compared, and only what is near goes on.
    """

    def scan(block: list) -> DataFrame:
        ids = np.array([r["query_id"] for r in block])
        asked = [nearness.Query(k, r["q"].encode(), errors) for k, r in enumerate(block)]

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                song = pdf["song_id"].to_numpy()
                for number, text, diff, pos in nearness.near(nearness.Texts(pdf["digits"]), asked):
                    yield pd.DataFrame({"query_id": ids[number], "song_id": song[text], "diff": diff, "pos": pos})

        return songs.select("song_id", "digits").mapInPandas(run, schema)

    of = lambda df, c: df.schema[c].dataType.simpleString()
    schema = f"query_id {of(queries, 'query_id')}, song_id {of(songs, 'song_id')}, diff int, pos int"
    found = [scan(block) for block in blocks(queries.where(F.length("q") == n), FEW)]
    none = songs.sparkSession.createDataFrame([], schema)
    return best_of(reduce(DataFrame.unionByName, found, none), "query_id", "song_id")


def blocks(queries: DataFrame, size: int) -> Iterator[list]:
    """The rows of a table of queries, in blocks of about ``size`` by a hash of query_id: any number of them can be asked, a block at a time."""
    n = max(1, -(-queries.count() // size))
    for k in range(n):
        if rows := queries.where(F.pmod(F.xxhash64("query_id"), F.lit(n)) == k).collect():
            yield rows


def annotate(hits: DataFrame, songs: DataFrame) -> DataFrame:
    """``hits`` (title, site, lang) with pop (songs of the title) and hot (the larger corpus frequency of its site and
    language names). Only these short columns are shuffled, never the symbols."""
    named = songs.select("title", "site", "lang")
    pops = named.groupBy("title").agg(F.count("*").alias("pop"))
    names = named.select(F.explode(F.array_distinct(F.array("site", "lang"))).alias("name")).groupBy("name").agg(F.count("*").alias("heat"))
    of = lambda c: few(names.select(F.col("name").alias(c), F.col("heat").alias(f"{c}_heat")))
    out = hits.join(pops, "title").join(of("site"), "site").join(of("lang"), "lang")
    return out.select(*hits.columns, "pop", F.greatest("site_heat", "lang_heat").alias("hot"))


def ranked(hits: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of hits (diff, pop, hot, sec_w, n_notes, title, song_id) with their rank."""
    order = ["diff", F.desc("pop"), F.desc("hot"), F.desc("sec_w"), "n_notes", "title", "song_id"]
    best = hits.orderBy(*order).limit(top)  # the report; TakeOrderedAndProject keeps ``top`` rows a task
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def first_of_title(songs: DataFrame) -> DataFrame:
    """``songs`` with first_id, the smallest song_id of the title."""
    firsts = songs.groupBy("title").agg(F.min("song_id").alias("first_id"))
    return songs.join(firsts, "title")


#: Counts up when windows of the same songs would come out otherwise.
INDEX_VERSION = 1


def window_index(songs: DataFrame, path: str, n: int) -> DataFrame:
    """(song_id, pos, gram): all windows of n symbols, from ``path`` if they were stored for these songs, stored there otherwise.

    The folder's name tells songs, n and version apart. Rows are in ranges of grams, so that a search for a few
    reads only the files and row groups that may hold them.
    """
    spark = songs.sparkSession
    n_songs, digest = songs.agg(F.count("*"), F.bit_xor(F.xxhash64("song_id", "digits"))).first()
    folder_ = f"{path}/v{INDEX_VERSION}-n{n}-{n_songs}-{(digest or 0) % (1 << 64):016x}"
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{folder_}/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        numbered_grams(songs, n).repartitionByRange("gram").sortWithinPartitions("gram").write.mode("overwrite").parquet(folder_)
    return spark.read.schema("song_id long, pos int, gram long").parquet(folder_)
