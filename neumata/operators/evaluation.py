"""Evaluation of retrieval: sampled fragments with errors, full scans, baselines, ranks and rates."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from neumata.functions import melody, nearness
from neumata.operators.search import FEW, blocks

#: Queries of a block that is scored by all scorers, and how many songs a task looks at before it knows what is near.
SCORED, FIRST_SONGS = 2000, (16, 128, 1024)


def _drawn(what: str, n: int, seed: int) -> Column:
    """A number of 28 bits from a hash of song, purpose, length and seed: the same wherever and however often it is drawn."""
    text = F.concat(F.col("song_id").cast("string"), F.lit(f":{what}:{n}:{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long")


def fragments(songs: DataFrame, n: int, errors: int, every: int = 100, seed: int = 1, indel: bool = False) -> DataFrame:
    """(query_id, true_title, q): a fragment of n notes of each song whose id ``every`` divides, with so many notes turned into
    a neighbouring degree, or with one left out or sung twice; the song's id is the query's."""
    rows = songs.where((F.col("song_id") % every == 0) & (F.length("digits") >= n))
    at = F.pmod(_drawn("start", n, seed), F.length("digits") - (n - 1)).cast("int")
    rows = rows.select("song_id", "title", F.substring("digits", at + 1, F.lit(n)).alias("q"))
    for k in range(errors):
        i = F.pmod(_drawn(f"place{k}", n, seed), F.lit(n)).cast("int")
        turn = F.when(_drawn(f"turn{k}", n, seed) % 2 == 0, 1).otherwise(-1)
        note = F.substring("q", i + 1, F.lit(1)).cast("int")
        wrong = F.when((note + turn).between(1, 7), note + turn).otherwise(note - turn)
        rows = rows.withColumn("q", F.concat(F.left("q", i), wrong.cast("string"), F.substring("q", i + 2, F.lit(n))))
    if indel:
        i = F.pmod(_drawn("indel", n, seed), F.lit(n)).cast("int")
        more = F.concat(F.left("q", i + 1), F.substring("q", i + 1, F.lit(n)))
        less = F.concat(F.left("q", i), F.substring("q", i + 2, F.lit(n)))
        rows = rows.withColumn("q", F.when(_drawn("kind", n, seed) % 2 == 0, less).otherwise(more))
    return rows.select(F.col("song_id").alias("query_id"), F.col("title").alias("true_title"), "q")


def _variants(q: str, deletions: bool) -> list[str]:
    return melody.deletion_variants(q) if deletions else [q]


def true_errors(songs: DataFrame, frags: DataFrame, deletions: bool = False, without_own: bool = False) -> DataFrame:
    """(query_id, q, mine): the least errors of each query among the songs of its true title, without the song it comes from if so
    asked; queries that no such song can hold are left out. Blocks of queries go to the songs; a title's songs meet its queries alone."""

    def least(block: list) -> DataFrame:
        asked = defaultdict(list)
        for r in block:
            asked[r["true_title"]].append((r["query_id"], [v.encode() for v in _variants(r["q"], deletions)]))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                found = []
                for title, rows in pdf[pdf["title"].isin(asked)].groupby("title"):
                    texts, at = nearness.Texts(rows["digits"]), {s: k for k, s in enumerate(rows["song_id"])}
                    least = [(i, texts.least(codes, at.get(i) if without_own else None)) for i, codes in asked[title]]
                    found += [(i, d) for i, d in least if d is not None]
                yield pd.DataFrame(found, columns=["query_id", "d"])

        return songs.select("song_id", "title", "digits").mapInPandas(run, "query_id long, d int")

    found = [least(block) for block in blocks(frags, FEW)]
    none = frags.select("query_id", F.lit(0).alias("d")).where(F.lit(False))
    mine = reduce(DataFrame.unionByName, found, none).groupBy("query_id").agg(F.min("d").alias("mine"))
    return frags.select("query_id", "q").join(mine, "query_id")


def nearer_titles(songs: DataFrame, frags: DataFrame, deletions: bool = False, without_own: bool = False) -> DataFrame:
    """(query_id, title, diff): the titles that are as near to a query as its true one, or nearer, with their least errors.

    Only these decide a rank. Blocks of queries, each with what its true title reaches, go over all songs, whose windows are looked at by
    the million; a task hands on the titles that are near enough.
    """

    def scan(block: list) -> DataFrame:
        ids = np.array([r["query_id"] for r in block])
        asked = [nearness.Query(k, v.encode(), r["mine"]) for k, r in enumerate(block) for v in _variants(r["q"], deletions)]

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                song, (code, titles) = pdf["song_id"].to_numpy(), pd.factorize(pdf["title"], use_na_sentinel=False)
                for held in _held(nearness.near(nearness.Texts(pdf["digits"]), asked)):
                    number, text, diff = held[:3]
                    if without_own:
                        number, text, diff = (x[ids[held[0]] != song[held[1]]] for x in (number, text, diff))
                    rows = pd.DataFrame({"query_id": ids[number], "title": code[text], "diff": diff.astype(np.int32)})
                    rows = rows.groupby(["query_id", "title"], as_index=False)["diff"].min()
                    yield rows.assign(title=titles[rows["title"]])

        return songs.select("song_id", "title", "digits").mapInPandas(run, "query_id long, title string, diff int")

    found = [scan(block) for block in blocks(true_errors(songs, frags, deletions, without_own), FEW)]
    none = frags.select("query_id", F.col("true_title").alias("title"), F.lit(0).alias("diff")).where(F.lit(False))
    return reduce(DataFrame.unionByName, found, none).groupBy("query_id", "title").agg(F.min("diff").alias("diff"))


def _held(found: Iterator[tuple[np.ndarray, ...]], most: int = 1 << 20) -> Iterator[tuple[np.ndarray, ...]]:
    """Small groups of arrays put together, up to ``most`` rows or so."""
    held, n = [], 0
    for rows in found:
        held.append(rows)
        n += len(rows[0])
        if n >= most:
            yield tuple(map(np.concatenate, zip(*held, strict=True)))
            held, n = [], 0
    if n:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def hit_rates(frags: DataFrame, best: DataFrame) -> DataFrame:
    """One row: queries, hits at 1, 3 and 5 by optimistic rank, hits at 1 if all ties go against, and mean ties.

    ``best`` has the least errors per query and title, at least of the titles as near as the true one. A query whose true title is not in it is a miss.
    """
    mine = best.join(frags, "query_id").where("title = true_title").select("query_id", F.col("diff").alias("mine"))
    ranks = best.join(mine, "query_id").groupBy("query_id").agg(
        (1 + F.count_if(F.col("diff") < F.col("mine"))).alias("rank"), F.count_if(F.col("diff") == F.col("mine")).alias("ties")
    )
    at = lambda k: F.count_if(F.col("rank") <= k).alias(f"hit{k}")
    rates = ranks.agg(at(1), at(3), at(5), F.count_if(F.col("rank") + F.col("ties") - 1 <= 1).alias("pessimistic1"), F.round(F.avg("ties"), 6).alias("mean_ties"))
    return frags.agg(F.count("*").alias("queries")).crossJoin(rates)  # one row and one row


def _nearest_windows(songs: DataFrame, block: list, top: int) -> DataFrame:
    """(query_id, song_id, title, diff): the songs with the ``top`` best windows of each query, of equals the smallest song_id, as each task
    knows them. A task looks at a few songs first and then only for what is as good as the last that it holds of a query."""
    ids = np.array([r["query_id"] for r in block])
    codes = [r["q"].encode() for r in block]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = pd.DataFrame({"number": np.empty(0, np.int64), "diff": np.empty(0, np.int64), "song_id": np.empty(0, np.int64), "title": np.empty(0, object)})
        for whole in batches:
            for pdf in (whole[a:b] for a, b in pairwise([0, *(n for n in FIRST_SONGS if n < len(whole)), len(whole)])):
                full = best.groupby("number")["diff"].agg(["size", "max"])
                most = {k: m for k, n, m in full.itertuples() if n >= top}
                asked = [nearness.Query(k, code, most.get(k, len(code))) for k, code in enumerate(codes)]
                song, title = pdf["song_id"].to_numpy(), pdf["title"].to_numpy(object)
                for number, text, diff, _ in _held(nearness.near(nearness.Texts(pdf["digits"]), asked)):
                    rows = pd.DataFrame({"number": number, "diff": diff, "song_id": song[text], "title": title[text]})
                    rows = pd.concat([best, rows]).sort_values(["number", "diff", "song_id"]).drop_duplicates(["number", "song_id"])
                    best = rows.groupby("number").head(top)
        yield pd.DataFrame({"query_id": ids[best["number"]], "song_id": best["song_id"], "title": best["title"], "diff": best["diff"]})

    return songs.select("song_id", "title", "digits").mapInPandas(run, "query_id long, song_id long, title string, diff int")


def _shortest(songs: DataFrame, n: int, top: int) -> DataFrame:
    """The songs that may be among the ``top`` least edits away from a text of n symbols. A song of m symbols is max(m, n) edits away at
    most and m - n at least, so much longer ones than the ``top`` shortest cannot be; of equal digits the first ``top`` songs do."""
    sized = songs.select("song_id", "title", "digits", F.length("digits").alias("m")).where("digits IS NOT NULL")
    lengths = [r["m"] for r in sized.select("m").orderBy("m").limit(top).collect()]
    short = sized if len(lengths) < top else sized.where(F.col("m") <= max(n, lengths[-1]) + n)
    alike = F.row_number().over(Window.partitionBy("digits").orderBy("song_id", "title"))
    return short.withColumn("k", alike).where(F.col("k") <= top).select("song_id", "title", "digits")


def nearest_songs(songs: DataFrame, frags: DataFrame, top: int) -> DataFrame:
    """(scorer, query_id, song_id, title, diff): the first ``top`` songs of each query by exact containment, by edits to whole scores and
    by the best window; equal scores go by song_id. Blocks of queries go over all songs.

    Songs that hold a query have its best windows; where they are too few, the first songs that do not hold it follow.
    """
    place = F.row_number().over(Window.partitionBy("scorer", "query_id").orderBy("diff", "song_id", "title"))
    first = lambda rows: rows.withColumn("place", place).where(F.col("place") <= top)
    columns = ["scorer", "query_id", "song_id", "title", "diff"]
    out = songs.select(F.lit("").alias("scorer"), F.lit(0).cast("long").alias("query_id"), "song_id", "title", F.lit(0).alias("diff")).where(F.lit(False))
    fillers = songs.where("digits IS NOT NULL").select("song_id", "title").orderBy("song_id", "title").limit(2 * top)
    for block in blocks(frags.select("query_id", "q"), SCORED):
        window = first(_nearest_windows(songs, block, top).withColumn("scorer", F.lit("window"))).select(*columns)
        asked = F.broadcast(songs.sparkSession.createDataFrame([(r["query_id"], r["q"]) for r in block], "query_id long, q string"))
        held = window.where("diff = 0").withColumn("scorer", F.lit("exact"))
        others = fillers.crossJoin(asked.select("query_id")).withColumn("diff", F.lit(1)).withColumn("scorer", F.lit("exact"))
        exact = held.unionByName(others.join(held.select("query_id", "song_id"), ["query_id", "song_id"], "left_anti"))
        short = _shortest(songs, max(len(r["q"]) for r in block), top).crossJoin(asked)
        edits = short.select(F.lit("edits").alias("scorer"), "query_id", "song_id", "title", F.levenshtein("digits", "q").alias("diff"))
        out = out.unionByName(window).unionByName(exact.select(*columns)).unionByName(edits)
    return first(out)


def baselines(songs: DataFrame, frags: DataFrame, top: int = 5) -> DataFrame:
    """(scorer, queries, hit1, hit5): whether the first or first five songs of ``nearest_songs`` have the true title."""
    best = nearest_songs(songs, frags, top).join(frags, "query_id")
    hit = lambda k: F.count_distinct(F.when((F.col("place") <= k) & (F.col("title") == F.col("true_title")), F.col("query_id")))
    return best.groupBy("scorer").agg(F.count_distinct("query_id").alias("queries"), hit(1).alias("hit1"), hit(top).alias(f"hit{top}"))
