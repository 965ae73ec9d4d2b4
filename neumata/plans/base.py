"""The registry of queries with their SQL, and the adapter from the test tables to scores, songs and queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from neumata.functions import melody

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df``, dealt out anew only if it has fewer partitions than the session has cores (one small file, say)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as songs: song_id, site, lang, title (the first word), digits."""
    text = F.coalesce("text", F.lit(""))
    return spread(table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")).select(
        F.col("doc_id").alias("song_id"),
        F.coalesce("source", F.lit("")).alias("site"),
        F.coalesce("lang", F.lit("")).alias("lang"),
        F.lower(F.regexp_extract(text, "[A-Za-z]+", 0)).alias("title"),
        melody.text_digits(text).alias("digits"),
    )


def fragments(spark: SparkSession, sf_dir: str, length: int, start: int = 1) -> DataFrame:
    """benchmark passages as melody queries: query_id, q (so many degrees from ``start``)."""
    q = F.substring(melody.text_digits(F.col("text")), start, length)
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), q.alias("q")).where(F.length("q") == length)


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as tokens: song_id, idx, token, tied (whether a tie sign follows)."""
    pick = lambda values, column, n: F.get(F.array(*map(F.lit, values)), (F.col(column) % n).cast("int"))
    duration = pick(("", "q", "s", "d"), "l_quantity", 4)
    dot = F.when((duration != "") & (F.col("l_linenumber") % 2 == 0), ".").otherwise("")
    parts = duration, pick(("", ",", "'"), "l_suppkey", 3), pick(("", "#", "b", "", ""), "l_suppkey", 5)
    token = F.concat(*parts, (F.col("l_partkey") % 8).cast("string"), dot)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("song_id"), F.col("l_linenumber").alias("idx"), token.alias("token"), (F.col("l_returnflag") == "R").alias("tied")
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of each song as one score text, ties written out. A song has few lines, so its list is small."""
    written = F.concat("token", F.when(F.col("tied"), " ~").otherwise(""))
    ordered = F.array_sort(F.collect_list(F.struct("idx", written.alias("w"))))
    return tokens(spark, sf_dir).groupBy("song_id").agg(F.array_join(F.transform(ordered, lambda x: x["w"]), " ").alias("score"))


#: Sections of the test songs: 100 notes each, in turn.
SECTIONS = ("intro", "verse", "chorus", "bridge")


def sectioned(songs: DataFrame) -> DataFrame:
    """``songs`` with n_notes and sections, an array of struct(start, name)."""
    parts = F.sequence(F.lit(0), F.floor(F.greatest(F.length("digits") - 1, F.lit(0)) / 100).cast("int"))
    name = lambda k: F.get(F.array(*map(F.lit, SECTIONS)), k % len(SECTIONS))
    sections = F.transform(parts, lambda k: F.struct((k * 100).alias("start"), name(k).alias("name")))
    return songs.withColumns({"n_notes": F.length("digits"), "sections": sections})


def section_weight_sql(pos: str) -> str:
    return f"[0.8, 1.25, 1.6, 1.1][1 + {pos} // 100 % 4]::DOUBLE"


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as folder names of all kinds: p_partkey, name. Some are doubled, numbered, bracketed, or end in markers and a site's number."""
    p, key = F.col("p_name"), F.col("p_partkey").cast("string")
    kinds = (
        p, F.concat(p, F.lit("简谱_李四演唱")), F.concat(F.lit("12春天"), p), F.concat(F.replace(p, F.lit(" "), F.lit("")), F.replace(p, F.lit(" "), F.lit("_"))),
        F.concat(p, F.lit("（张三词_王五曲）")), F.concat(p, F.lit("钢琴谱（C调）__sitea-"), key), F.concat(F.lit("春天"), p, F.lit("2简谱__siteb-"), key), F.concat(F.lit("_"), p, F.lit("123456")),
    )
    kind = F.get(F.array(*kinds), (F.col("p_partkey") % len(kinds)).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", kind.alias("name"))


NAMES_SQL = """names AS (SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN p_name WHEN 1 THEN p_name || '简谱_李四演唱' WHEN 2 THEN '12春天' || p_name
    WHEN 3 THEN replace(p_name, ' ', '') || replace(p_name, ' ', '_') WHEN 4 THEN p_name || '（张三词_王五曲）' WHEN 5 THEN p_name || '钢琴谱（C调）__sitea-' || p_partkey
    WHEN 6 THEN '春天' || p_name || '2简谱__siteb-' || p_partkey ELSE '_' || p_name || '123456' END AS name FROM part)"""
DIGITS_SQL = "translate(lower(regexp_replace(coalesce({}, ''), '[^A-Za-z]', '', 'g')), 'abcdefghijklmnopqrstuvwxyz', '12345671234567123456712345')"
SONGS_SQL = f"""songs AS (
    SELECT doc_id AS song_id, coalesce(source, '') AS site, coalesce(lang, '') AS lang,
           lower(regexp_extract(coalesce(text, ''), '[A-Za-z]+')) AS title, {DIGITS_SQL.format("text")} AS digits
    FROM documents)"""
TOKENS_SQL = """tokens AS (
    SELECT l_orderkey AS song_id, l_linenumber AS idx, l_returnflag = 'R' AS tied,
           ['', 'q', 's', 'd'][1 + CAST(l_quantity AS INT) % 4] AS dur, ['', ',', ''''][1 + l_suppkey % 3] AS octs,
           ['', '#', 'b', '', ''][1 + l_suppkey % 5] AS accs, l_partkey % 8 AS deg,
           CASE WHEN dur <> '' AND l_linenumber % 2 = 0 THEN '.' ELSE '' END AS dot,
           dur || octs || accs || deg || dot AS token,
           CAST(CASE WHEN deg > 0 THEN deg END AS INT) AS digit, CAST([0, 1, -1, 0, 0][1 + l_suppkey % 5] AS INT) AS acc,
           CAST([0, 1, -1][1 + l_suppkey % 3] AS INT) AS oct,
           ([1.0, 0.5, 0.25, 0.125][1 + CAST(l_quantity AS INT) % 4] * CASE WHEN dot = '.' THEN 1.5 ELSE 1.0 END)::DOUBLE AS beats
    FROM lineitem)"""


def fragments_sql(length: int, start: int = 1) -> str:
    return f"""fragments AS (
    SELECT item_id AS query_id, substr({DIGITS_SQL.format("text")}, {start}, {length}) AS q FROM benchmark WHERE length(q) = {length})"""


def windows_sql(n: int, of: str = "songs") -> str:
    """(song_id, title, pos from 0, w) of every window of n symbols."""
    return f"""windows AS (
    SELECT song_id, title, pos, substr(digits, pos + 1, {n}) AS w
    FROM (SELECT *, unnest(range(length(digits) - {n - 1})) AS pos FROM {of} WHERE length(digits) >= {n}))"""
