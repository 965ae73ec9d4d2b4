"""Joins of titles and names by containment and by similarity, exact for tables of any size.

Texts are filed under short pieces of themselves. A text that holds another holds every
piece of it, so the one piece of a needle that the fewest texts have finds all of them.
Two texts of some similarity share a number of signs that their lengths decide, so they
meet in one of their rarest signs. What meets is compared itself; nothing is compared
within blocks of first letters, and no side has to be small.
"""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from neumata.functions import titles
from neumata.functions.common import let
from neumata.shared import folder


def _pieces(text: Column, n: int) -> Column:
    """The different pieces of n signs of a text."""
    starts = F.sequence(F.lit(1), F.length(text) - (n - 1))
    return F.when(F.length(text) >= n, F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))


def holding(texts: DataFrame, needles: DataFrame, q: int = 4) -> DataFrame:
    """(text, needle): every different text beside every different needle in it. ``texts`` has text, ``needles`` needle; nulls and
    empty needles hold nothing. A needle shorter than ``q`` is a piece by itself."""
    keep = folder(texts.sparkSession, "holding")
    needles = keep(needles.select("needle").where("needle <> ''").distinct(), "needles")
    sizes = sorted(r["n"] for r in needles.select(F.least(F.length("needle"), F.lit(q)).alias("n")).distinct().collect())  # q at most
    if not sizes:
        return texts.select("text", F.col("text").alias("needle")).where(F.lit(False))
    text, needle = F.col("text"), F.col("needle")
    filed = keep(texts.select("text").where("text IS NOT NULL").distinct().select("text", F.explode(F.concat(*(_pieces(text, n) for n in sizes))).alias("piece")), "filed")
    own = needles.select("needle", F.explode(F.when(F.length(needle) < q, F.array(needle)).otherwise(_pieces(needle, q))).alias("piece"))
    held = own.join(filed.groupBy("piece").agg(F.count("*").alias("texts")), "piece", "left")
    rarest = held.groupBy("needle").agg(F.min(F.coalesce("texts", F.lit(0))).alias("texts"), F.min_by("piece", F.struct(F.coalesce("texts", F.lit(0)), "piece")).alias("piece"))
    met = rarest.where("texts > 0").select("needle", "piece").join(filed, "piece")
    return met.where(text.contains(needle)).select("text", "needle")


def same_titles(have: DataFrame, want: DataFrame, head: int = 0) -> DataFrame:
    """(title, wanted): different titles of ``have`` that are ``titles.same_title`` as a wanted one, and begin with the same ``head`` signs."""
    have, want = have.select("title").where("title IS NOT NULL").distinct(), want.select("wanted").where("wanted IS NOT NULL").distinct()
    of = lambda df, c, name: df.select(F.col(c).alias(name))
    long_enough = lambda df, c: df.where(F.length(c) >= 4)
    equal = have.join(want, F.col("title") == F.col("wanted"))
    holds = holding(of(have, "title", "text"), of(long_enough(want, "wanted"), "wanted", "needle")).select(F.col("text").alias("title"), F.col("needle").alias("wanted"))
    held = holding(of(want, "wanted", "text"), of(long_enough(have, "title"), "title", "needle")).select(F.col("needle").alias("title"), F.col("text").alias("wanted"))
    pairs = equal.union(holds).union(held).where(F.left("title", F.lit(head)) == F.left("wanted", F.lit(head)))
    return pairs.where(titles.same_title(F.col("title"), F.col("wanted"))).distinct()


def _signs(text: Column) -> Column:
    """The signs of a text with how often each has been there before, which makes a set of them."""
    chars = F.split(text, "")
    numbered = lambda x: F.transform(x, lambda c, i: F.concat(c, F.size(F.filter(F.slice(x, 1, i), lambda d: d == c)).cast("string")))
    return let(chars, numbered)


def similar(have: DataFrame, want: DataFrame, least: float, held_counts: float = 0.75, held_from: int = 3) -> DataFrame:
    """(wanted, title, ratio): different titles that are similar to a wanted one by ``least`` or more in the sense of Ratcliff and
    Obershelp; of two of which one holds the other, both of ``held_from`` signs or more, the similarity counts as ``held_counts`` at least.

    What two texts match in are common signs: at least least / 2 of both lengths together, so of the rarest signs of
    each as many as are not needed for that, and one more, some are in common. Lengths and the places of the
    first common sign bound the rest before the texts are compared.
    """
    keep = folder(have.sparkSession, "similar")
    have, want = have.select("title").where("title <> ''").distinct(), want.select("wanted").where("wanted <> ''").distinct()
    listed = lambda df, c: keep(df.select(c, F.length(c).alias(f"n_{c}"), F.posexplode(_signs(F.col(c))).alias("at", "sign")).drop("at"), c)
    signs = {c: listed(df, c) for c, df in (("title", have), ("wanted", want))}
    common = signs["title"].groupBy("sign").agg(F.count("*").alias("texts"))

    def prefix(c: str) -> DataFrame:
        """The rarest signs of each text, in order."""
        n = F.col(f"n_{c}")
        place = F.row_number().over(Window.partitionBy(c).orderBy(F.coalesce("texts", F.lit(0)), "sign"))
        return signs[c].join(common, "sign", "left").withColumn(f"{c}_at", place).where(F.col(f"{c}_at") <= n - F.ceil(n * (least / (2 - least)) - 1e-9) + 1).drop("texts")

    needed = F.ceil((F.col("n_title") + F.col("n_wanted")) * (least / 2) - 1e-9)
    both = prefix("title").join(prefix("wanted"), "sign").where(F.least("n_title", "n_wanted") >= needed)
    met = both.groupBy("title", "wanted").agg(F.min("title_at").alias("i"), F.min("wanted_at").alias("j"), F.first("n_title").alias("n_title"), F.first("n_wanted").alias("n_wanted"))
    met = met.where(F.least(F.col("n_title") - F.col("i"), F.col("n_wanted") - F.col("j")) + 1 >= needed)
    enough = met.where(F.size(F.array_intersect(_signs(F.col("title")), _signs(F.col("wanted")))) >= needed).select("title", "wanted")

    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([difflib.SequenceMatcher(None, x, y, autojunk=False).ratio() for x, y in zip(a, b, strict=True)])

    close = enough.select("wanted", "title", ratio("title", "wanted").alias("ratio"))
    of = lambda df, c, name: df.where(F.length(c) >= held_from).select(F.col(c).alias(name))
    holds = holding(of(have, "title", "text"), of(want, "wanted", "needle"), held_from).select(F.col("needle").alias("wanted"), F.col("text").alias("title"))
    held = holding(of(want, "wanted", "text"), of(have, "title", "needle"), held_from).select(F.col("text").alias("wanted"), F.col("needle").alias("title"))
    rows = close.unionByName(holds.union(held).withColumn("ratio", F.lit(held_counts)))
    return rows.where(F.col("ratio") >= least).groupBy("wanted", "title").agg(F.max("ratio").alias("ratio"))


def most_similar(have: DataFrame, want: DataFrame, least: float) -> DataFrame:
    """(wanted, title, ratio): the most similar title of each wanted one, the first of equals, where any is similar by ``least``."""
    best = F.min_by(F.struct("title", "ratio"), F.struct((-F.col("ratio")).alias("less"), "title")).alias("b")
    return similar(have, want, least).groupBy("wanted").agg(best).select("wanted", "b.title", "b.ratio")


def covered(songs: DataFrame, want: DataFrame, least_notes: int = 11, least: float = 0.60) -> DataFrame:
    """``want`` (wanted, more columns) with verdict and found: hit, too short, alias, similar or missing.

    ``songs`` has title, alias, n_notes. Of several songs of a title the longest counts.
    """
    names = lambda c: songs.select(F.col(c).alias("title"), "n_notes").where("title <> ''").groupBy("title").agg(F.max("n_notes").alias("n_notes"))
    wanted = want.select("wanted").where("wanted <> ''").distinct()
    by_title, by_alias = names("title"), names("alias")
    rank = F.struct((F.col("n_notes") < least_notes).alias("short"), "title")
    direct = lambda rows: same_titles(rows, wanted).join(rows, "title").groupBy("wanted").agg(F.min(rank).alias("b"))
    hit = direct(by_title).select("wanted", F.col("b.short").alias("short"), F.col("b.title").alias("hit"))
    alias = direct(by_alias).select("wanted", F.col("b.title").alias("alias"))
    open_ = wanted.join(hit, "wanted", "left_anti").join(alias, "wanted", "left_anti")
    close = most_similar(by_title.select("title").union(by_alias.select("title")), open_, least).select("wanted", F.col("title").alias("similar"))
    out = want.join(hit, "wanted", "left").join(alias, "wanted", "left").join(close, "wanted", "left")
    verdict = (
        F.when(F.col("hit").isNotNull(), F.when(F.col("short"), "too short").otherwise("hit"))
        .when(F.col("alias").isNotNull(), "alias").when(F.col("similar").isNotNull(), "similar").otherwise("missing")
    )
    return out.select(*want.columns, verdict.alias("verdict"), F.coalesce("hit", "alias", "similar").alias("found"))


def spelled(names: DataFrame, known: DataFrame) -> DataFrame:
    """``names`` with artist: the known spelling (key, spelling) of its name; of a noisy name the first known spelling within it."""
    direct = names.join(known, F.lower("name") == F.col("key"), "left").drop("key")
    noisy = direct.where("spelling IS NULL").select(F.lower("name").alias("text"))
    found = holding(noisy, known.select(F.col("key").alias("needle"))).join(known, F.col("needle") == F.col("key"))
    within = found.groupBy("text").agg(F.min("spelling").alias("within"))
    rows = direct.join(within, F.lower("name") == F.col("text"), "left")
    return rows.withColumn("artist", F.coalesce("spelling", "within")).drop("spelling", "within", "text")
