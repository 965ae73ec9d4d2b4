"""Readers and writers of corpus files: song lines, score files, lists, page links and image folders."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SONG = """file array<string>, title string, artist array<string>, status string, n_notes int, bars array<int>, beats_per_bar double,
source string, transcriber array<string>, confidence string, conf_p10 string, tag array<string>, usertag array<string>, alias array<string>,
MBID string, link array<string>, sections array<struct<subtitle:string,score:string>>, score string"""
# Signs between several values of one header field, and what stands between two sections.
SEVERAL = "[,|，、]"
NEXT_SECTION = "NextScore"


def read_songs(spark: SparkSession, path: str) -> DataFrame:
    """Songs of JSON lines; blank and malformed lines are left out. status and source, one text or a list in the files, are lists here."""
    rows = spark.read.schema(SONG).option("mode", "DROPMALFORMED").json(path)
    listed = {c: F.coalesce(F.from_json(c, "array<string>"), F.array_compact(F.array(F.nullif(F.col(c), F.lit(""))))) for c in ("status", "source")}
    return rows.withColumns({c: F.when(F.col(c).startswith("["), x).otherwise(F.array_compact(F.array(F.col(c)))) for c, x in listed.items()})


def write_songs(songs: DataFrame, path: str) -> None:
    songs.write.mode("overwrite").json(path)


def parse_scores(texts: DataFrame) -> DataFrame:
    """(path, title, header: map of lists, sections, score) of score texts (path, value).

    key=value lines before the ``%--`` line make the header; other ``%`` lines are
    comments even with an equals sign; the body ends at ``%END``. Without ``%--``
    there is no body.
    """
    lines = F.transform(F.split(F.col("value"), "\r?\n", -1), lambda x: F.trim(x))
    cut = F.array_position(F.col("lines"), "%--").cast("int")
    end = F.array_position(F.col("lines"), "%END").cast("int")
    last = F.when(end > 0, end - 1).otherwise(F.size("lines"))
    head = F.slice("lines", 1, F.when(cut > 0, cut - 1).otherwise(F.size("lines")))
    body = F.when(cut > 0, F.slice("lines", cut + 1, F.greatest(last - cut, F.lit(0)))).otherwise(F.array().cast("array<string>"))
    pairs = F.filter(head, lambda x: ~x.startswith("%") & x.contains("="))
    values = lambda x: F.filter(F.transform(F.split(F.regexp_extract(x, "^[^=]*=(.*)$", 1), SEVERAL), lambda v: F.trim(v)), lambda v: v != "")
    keys = F.array_distinct(F.transform(pairs, lambda x: F.substring_index(x, "=", 1)))
    header = F.map_from_entries(
        F.transform(keys, lambda k: F.struct(k.alias("key"), F.flatten(F.transform(F.filter(pairs, lambda x: F.substring_index(x, "=", 1) == k), values)).alias("value")))
    )
    notes = F.filter(body, lambda x: ~x.startswith("%") & (x != ""))
    whole = F.array_join(notes, "\n")
    sections = F.transform(
        F.split(whole, rf"(?:^|\n){NEXT_SECTION}(?:\n|$)", -1),
        lambda s: F.struct(
            F.regexp_extract(s, r"(?m)^subtitle=(.*)$", 1).alias("subtitle"), F.trim(F.regexp_replace(s, r"(?m)^subtitle=.*$\n?", "")).alias("score")
        ),
    )
    rows = texts.withColumn("lines", lines).select("path", header.alias("header"), sections.alias("sections"))
    score = F.array_join(F.transform("sections", lambda s: s["score"]), "\n")
    title = F.get(F.try_element_at("header", F.lit("title")), F.lit(0))
    return rows.select("path", title.alias("title"), "header", "sections", score.alias("score"))


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """Score files, one row each; files are split over tasks by size as usual."""
    return parse_scores(spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value"))


def write_scores(scores: DataFrame, path: str) -> None:
    """(title, header, sections) as score texts, one row of a text table each, in the canonical layout."""
    header = F.array_join(F.transform(F.array_sort(F.map_keys("header")), lambda k: F.concat(k, F.lit("="), F.array_join(F.try_element_at("header", k), ","))), "\n")
    part = F.transform("sections", lambda s: F.concat(F.when(s["subtitle"] != "", F.concat(F.lit("subtitle="), s["subtitle"], F.lit("\n"))).otherwise(""), s["score"]))
    text = F.concat_ws("\n", header, F.lit("%--"), F.array_join(part, f"\n{NEXT_SECTION}\n"), F.lit("%END"))
    scores.select(text.alias("value")).write.mode("overwrite").option("lineSep", "\n\f\n").text(path)


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """(rank, title, artist) of a list with two or three tab-separated columns; # lines are comments."""
    parts = F.split("value", "\t")
    rows = spark.read.text(path).where(~F.trim("value").startswith("#") & (F.trim("value") != "")).select(parts.alias("p"))
    three = F.size("p") >= 3
    at = lambda i, j: F.trim(F.when(three, F.get("p", F.lit(i))).otherwise(F.get("p", F.lit(j))))
    return rows.select(F.when(three, F.get("p", F.lit(0)).try_cast("int")).alias("rank"), at(1, 0).alias("title"), F.coalesce(at(2, 1), F.lit("")).alias("artist"))


def page_links(pages: DataFrame) -> DataFrame:
    """(page_id, position, href, label): the links of each page in order."""
    pattern = r'(?is)<a[^>]*href="([^"]*)"[^>]*>(.*?)</a>'
    got = lambda k: F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(pattern), F.lit(k))
    rows = pages.select("page_id", F.posexplode(F.arrays_zip(got(1).alias("href"), got(2).alias("label"))).alias("position", "x"))
    return rows.select("page_id", "position", "x.href", F.trim(F.regexp_replace("x.label", "<[^>]*>", "")).alias("label"))


def image_pages(files: DataFrame) -> DataFrame:
    """(batch, title, site, ident, pages) of image paths ``batch/title__site-ident/NNN.ext``; page and strip crops do not count."""
    pattern = r"([^/]+)/([^/]+?)__([A-Za-z0-9]+)-([A-Za-z0-9]+)/([^/]+)\.(?:jpg|jpeg|png|webp|gif)$"
    got = [F.regexp_extract("path", pattern, k) for k in range(1, 6)]
    names = ["batch", "title", "site", "ident", "name"]
    rows = files.select(*(g.alias(n) for g, n in zip(got, names, strict=True))).where("site <> ''")
    return rows.where(~F.col("name").contains("__pg") & ~F.col("name").contains("_strip_")).groupBy(*names[:4]).agg(F.count("*").alias("pages"))


def write_report(rows: DataFrame, path: str) -> None:
    """A report as tab-separated files with a header line; lists are comma-joined."""
    flat = [F.array_join(c.name, ",").alias(c.name) if c.dataType.typeName() == "array" else F.col(c.name) for c in rows.schema]
    rows.select(*flat).write.mode("overwrite").csv(path, sep="\t", header=True)


def write_by(songs: DataFrame, path: str, attribute: str) -> None:
    """Songs as a table with a folder for each value of an attribute, for searches that name one; a list counts for each of its values."""
    many = songs.schema[attribute].dataType.typeName() == "array"
    key = F.explode_outer(attribute) if many else F.col(attribute)
    songs.withColumn(f"by_{attribute}", key).write.mode("overwrite").partitionBy(f"by_{attribute}").parquet(path)


def decoded(data: Column, charset: str = "gb18030") -> Column:
    """Bytes of a page as text: by UTF-8 if they are, else by the site's own charset, which Spark's own decoding may not know."""

    @F.pandas_udf("string")
    def read(pages: pd.Series) -> pd.Series:
        return pages.map(lambda b: None if b is None else bytes(b).decode(charset, "replace"))

    return F.coalesce(F.try_validate_utf8(data.cast("string")), read(data))
