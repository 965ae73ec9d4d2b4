"""Queries over the corpus: gates, versions, titles, ledgers, merges, evaluation and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from neumata.functions import titles, tokens as T
from neumata.operators import corpus, search
from neumata.plans.base import SONGS_SQL, query, songs, table

BAG_SQL = " + ".join(f"{{f}}(length({{a}}) - length(replace({{a}}, '{d}', '')), length({{b}}) - length(replace({{b}}, '{d}', '')))" for d in range(1, 8))
APART_SQL = " + ".join(f"abs((length({{a}}) - length(replace({{a}}, '{d}', ''))) - (length({{b}}) - length(replace({{b}}, '{d}', ''))))" for d in range(1, 8))
TOP_SQL = ", ".join(f"length(digits) - length(replace(digits, '{d}', ''))" for d in range(1, 8))


def _word_count(c: str):
    return F.size(F.array_remove(F.split(F.coalesce(c, F.lit("")), r"[ \t\n\r]+"), ""))


@query(f"WITH {SONGS_SQL} SELECT song_id, title, count(*) OVER (PARTITION BY title) AS pop FROM songs")
def group_pop(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = songs(spark, sf_dir).select("song_id", "title")
    return rows.join(rows.groupBy("title").agg(F.count("*").alias("pop")), "title").select("song_id", "title", "pop")


@query(f"""WITH {SONGS_SQL}, heat AS (SELECT name, count(*) AS heat FROM (SELECT unnest(list_distinct([site, lang])) AS name FROM songs) GROUP BY name)
SELECT song_id, greatest(a.heat, b.heat) AS hot FROM songs JOIN heat a ON a.name = site JOIN heat b ON b.name = lang""")
def name_hotness(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = songs(spark, sf_dir)
    return search.annotate(every.select("song_id", "title", "site", "lang"), every).select("song_id", "hot")


@query(f"WITH {SONGS_SQL} SELECT title, count(*) AS n, count(DISTINCT site) AS sites FROM songs GROUP BY title")
def distinct_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_site = songs(spark, sf_dir).groupBy("title", "site").agg(F.count("*").alias("n"))
    return by_site.groupBy("title").agg(F.sum("n").alias("n"), F.count("*").alias("sites"))


@query("""SELECT conv_id, max(w) AS weight, arg_max(turn, w * 1000000 - turn) AS turn FROM (
    SELECT conv_id, turn, CASE role WHEN 'user' THEN 1.25 WHEN 'assistant' THEN 1.6 ELSE 1.0 END::DOUBLE AS w FROM conversations) GROUP BY conv_id""")
def section_weight_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.when(F.col("role") == "user", "intro,verse").when(F.col("role") == "assistant", "Chorus").otherwise("spoken")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", T.section_weight(role).alias("w"))
    best = rows.groupBy("conv_id").agg(F.max(F.struct("w", (-F.col("turn")).alias("t"))).alias("b"))
    return best.select("conv_id", F.col("b.w").alias("weight"), (-F.col("b.t")).alias("turn"))


@query("""SELECT event_id, last_value(CASE WHEN event_type = 'view' THEN event_id END IGNORE NULLS) OVER (
    PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_view FROM events""")
def bar_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    view = F.when(F.col("event_type") == "view", F.col("event_id"))
    return corpus.as_of(rows.withColumn("ts", F.col("ts").cast("timestamp")), view, "user_id", "ts", "event_id", "last_view").select("event_id", "last_view")


@query(r"""WITH counted AS (SELECT doc_id, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\r]+'), lambda w: w <> '')) AS n,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\r]+'), lambda w: contains(w, 'x'))) AS nx FROM documents)
SELECT doc_id, n, nx, n >= 20 AND nx >= 10 AND 100 * nx >= 30 * n AS rejected FROM counted""")
def high_x_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[ \t\n\r]+"), "")
    rows = table(spark, sf_dir, "documents").select("doc_id", words.alias("w"))
    rows = rows.select("doc_id", F.size("w").cast("long").alias("n"), F.size(F.filter("w", lambda x: x.contains("x"))).cast("long").alias("nx"))
    return rows.withColumn("rejected", (F.col("n") >= 20) & (F.col("nx") >= 10) & (100 * F.col("nx") >= 30 * F.col("n")))


@query(f"""WITH {SONGS_SQL} SELECT song_id, length(digits) AS n, list_max([{TOP_SQL}]) AS top, len(list_filter([{TOP_SQL}], lambda c: c > 0)) AS degrees FROM songs""")
def top_pitch_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = songs(spark, sf_dir).select("song_id", F.length("digits").cast("long").alias("n"), corpus.top_share(F.col("digits")).alias("t"))
    return rows.select("song_id", "n", F.col("t.top").cast("long").alias("top"), F.col("t.degrees").cast("long").alias("degrees"))


@query(rf"""WITH {SONGS_SQL}, measured AS (SELECT song_id, length(digits) AS n, list_max([{TOP_SQL}]) AS top, len(list_filter([{TOP_SQL}], lambda c: c > 0)) AS degrees,
    length(coalesce(text, '')) AS n_tokens FROM songs JOIN documents ON song_id = doc_id), tiers AS (SELECT CASE WHEN n_tokens < 20 THEN 'short'
    WHEN n < 20 THEN CASE WHEN n / n_tokens < 0.25 THEN 'junk' WHEN n / n_tokens < 0.35 THEN 'suspect' ELSE 'fine' END
    WHEN top / n >= 0.9 OR n / n_tokens < 0.25 OR degrees <= 2 THEN 'junk' WHEN top / n >= 0.5 OR n / n_tokens < 0.35 THEN 'suspect' ELSE 'fine' END AS tier FROM measured)
SELECT tier, count(*) AS n FROM tiers GROUP BY tier""")
def junk_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from neumata.functions.melody import text_digits

    rows = table(spark, sf_dir, "documents").select(F.length(F.coalesce("text", F.lit(""))).alias("n_tokens"), text_digits(F.col("text")).alias("digits"))
    rows = rows.select("n_tokens", F.length("digits").alias("n"), corpus.top_share(F.col("digits")).alias("t"))
    tier = corpus.junk_tier(F.col("n"), F.col("n_tokens"), F.col("t.top"), F.col("t.degrees"))
    return rows.select(tier.alias("tier")).groupBy("tier").agg(F.count("*").alias("n"))


@query(r"""SELECT conv_id, count(*) AS pages, CAST(sum(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\r]+'), lambda w: w <> ''))) AS BIGINT) AS notes,
    sum(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\r]+'), lambda w: w <> ''))) < 15 * count(*) AND count(*) >= 2 AS thin FROM conversations GROUP BY conv_id""")
def page_density_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("pages"), F.sum(_word_count("text")).alias("notes"))
    return rows.withColumn("thin", (F.col("notes") < 15 * F.col("pages")) & (F.col("pages") >= 2))


@query(f"""WITH {SONGS_SQL} SELECT song_id, n_rows FROM (SELECT song_id, count(*) OVER (PARTITION BY digits) AS n_rows,
    row_number() OVER (PARTITION BY digits ORDER BY site, song_id) AS k FROM songs WHERE length(digits) >= 40) WHERE k = 1""")
def dedupe_by_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = songs(spark, sf_dir).where(F.length("digits") >= 40).select(F.sha2("digits", 256).alias("key"), "site", "song_id")
    return corpus.keep_one(rows, ["key"], ["site", "song_id"]).select("song_id", "n_rows")


@query(f"""WITH {SONGS_SQL} SELECT site, title, song_id, n_rows FROM (SELECT site, title, song_id, count(*) OVER (PARTITION BY site, title) AS n_rows,
    row_number() OVER (PARTITION BY site, title ORDER BY length(digits) DESC, song_id) AS k FROM songs) WHERE k = 1""")
def dedupe_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = songs(spark, sf_dir).select("site", "title", "song_id", (-F.length("digits")).alias("less"))
    return corpus.keep_one(rows, ["site", "title"], ["less", "song_id"]).select("site", "title", "song_id", "n_rows")


@query("""SELECT p_brand, p_partkey, p_type, n_rows FROM (SELECT *, count(*) OVER (PARTITION BY p_brand) AS n_rows, row_number() OVER (
    PARTITION BY p_brand ORDER BY p_size > 25 DESC, contains(p_type, 'STEEL') DESC, p_size DESC, p_retailprice DESC, length(p_name), p_partkey) AS k FROM part) WHERE k = 1""")
def best_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    keys = [(c("p_size") <= 25).alias("o1"), (~c("p_type").contains("STEEL")).alias("o2"), (-c("p_size")).alias("o3"), (-c("p_retailprice")).alias("o4"), F.length("p_name").alias("o5")]
    rows = table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_type", *keys)
    return corpus.keep_one(rows, ["p_brand"], ["o1", "o2", "o3", "o4", "o5", "p_partkey"]).select("p_brand", "p_partkey", "p_type", "n_rows")


@query(f"""WITH {SONGS_SQL}, led AS (SELECT *, min(song_id) OVER (PARTITION BY title) AS first_id FROM songs)
SELECT a.song_id, CAST({BAG_SQL.format(f="least", a="a.digits", b="b.digits")} AS BIGINT) AS overlap,
    CASE WHEN a.digits <> '' AND b.digits <> '' THEN greatest(0.0, round(1 - ({APART_SQL.format(a="a.digits", b="b.digits")}) / greatest(length(a.digits), length(b.digits)), 6)) ELSE 0.0 END::DOUBLE AS agreement
FROM led a JOIN songs b ON b.song_id = a.first_id WHERE a.song_id <> a.first_id""")
def bag_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = search.first_of_title(songs(spark, sf_dir)).where("song_id <> first_id").select("song_id", "first_id", "digits")
    other = songs(spark, sf_dir).select(F.col("song_id").alias("first_id"), F.col("digits").alias("b"))
    a, b = F.col("digits"), F.col("b")
    return rows.join(other, "first_id").select("song_id", corpus.bag_overlap(a, b).cast("long").alias("overlap"), corpus.bag_agreement(a, b).alias("agreement"))


@query("""SELECT p_partkey, p_brand || CASE WHEN k > 1 THEN '_' || k ELSE '' END AS name FROM (
    SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand, p_size ORDER BY p_partkey) AS k FROM part)""")
def collision_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    suffix = F.when(F.col("nth") > 1, F.concat(F.lit("_"), F.col("nth").cast("string"))).otherwise("")
    return corpus.numbered_within(rows, ["p_brand", "p_size"], "p_partkey").select("p_partkey", F.concat("p_brand", suffix).alias("name"))


@query(r"""SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g')) AS title FROM pages""")
def html_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", titles.page_title(F.col("html")).alias("title"))


@query(r"""SELECT page_id, CASE WHEN regexp_extract(url, '^https?://([^./]+)', 1) <> '' AND regexp_extract(url, '^[^?#]*/(\d+)', 1) <> ''
    THEN regexp_extract(url, '^https?://([^./]+)', 1) || '-' || regexp_extract(url, '^[^?#]*/(\d+)', 1) END AS key FROM pages""")
def url_site_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", titles.site_key(F.col("url")).alias("key"))


@query(r"""SELECT p_partkey, lower(regexp_replace(regexp_replace(p_name, '[（(【\[《][^）)】\]》]*[）)】\]》]', '', 'g'), '[\s\-_·、,，。.]+', '', 'g')) AS title FROM part""")
def title_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", titles.normal_title(F.col("p_name")).alias("title"))


@query("""WITH n AS (SELECT p_partkey, lower(replace(p_type, ' ', '')) AS a, lower(regexp_replace(p_name, '[\\s\\-_.,]+', '', 'g')) AS b FROM part)
SELECT p_partkey, CASE WHEN a = '' OR b = '' THEN 'missing' WHEN a = b THEN 'strict' WHEN contains(a, b) OR contains(b, a) THEN 'loose' ELSE 'missing' END AS grade FROM n""")
def title_match_strict_loose(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = titles.normal_title(F.col("p_type")), titles.normal_title(F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", titles.match_grade(a, b).alias("grade"))


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def source_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey").join(done, "o_orderkey", "left_anti")


@query("""SELECT l_suppkey, arg_min(verdict, p) AS verdict, count(*) AS evidence FROM (SELECT l_suppkey,
    CASE l_returnflag WHEN 'R' THEN 'impure' WHEN 'A' THEN 'texture' ELSE 'unread' END AS verdict,
    CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END AS p FROM lineitem) GROUP BY l_suppkey""")
def reject_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    verdict = F.when(flag == "R", "impure").when(flag == "A", "texture").otherwise("unread")
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", verdict.alias("verdict"), F.when(flag == "R", 1).when(flag == "A", 2).otherwise(3).alias("p"))
    return rows.groupBy("l_suppkey").agg(F.min_by("verdict", "p").alias("verdict"), F.count("*").alias("evidence"))


@query("""WITH RECURSIVE edges AS (SELECT 'r' || r_regionkey AS parent, 'n' || n_nationkey AS child FROM region JOIN nation ON r_regionkey = n_regionkey
    UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer), closure AS (
    SELECT parent AS ancestor, child, 1 AS depth FROM edges UNION ALL SELECT c.ancestor, e.child, depth + 1 FROM closure c JOIN edges e ON c.child = e.parent)
SELECT ancestor, count(*) AS descendants, CAST(max(depth) AS INT) AS depth FROM closure GROUP BY ancestor""")
def tag_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, customer = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    tag = lambda kind, c: F.concat(F.lit(kind), F.col(c).cast("string"))
    edges = nation.select(tag("r", "n_regionkey").alias("parent"), tag("n", "n_nationkey").alias("child")).unionByName(
        customer.select(tag("n", "c_nationkey").alias("parent"), tag("c", "c_custkey").alias("child"))
    )
    return corpus.closure(spark, edges).groupBy("ancestor").agg(F.count("*").alias("descendants"), F.max("depth").alias("depth"))


@query("""WITH found AS (SELECT o_custkey AS c_custkey, min(o_orderpriority) AS c_mktsegment FROM orders GROUP BY 1)
SELECT c.c_custkey, coalesce(nullif(CASE WHEN c.c_custkey % 3 = 0 THEN '' ELSE c.c_mktsegment END, ''), f.c_mktsegment) AS c_mktsegment FROM customer c LEFT JOIN found f USING (c_custkey)""")
def fill_blank_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    blank = F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_mktsegment"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", blank.alias("c_mktsegment"))
    found = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderpriority").alias("c_mktsegment"))
    return corpus.blank_filled(rows, found, "c_custkey", ["c_mktsegment"])


@query("""WITH a AS (SELECT doc_id AS name, sha256(coalesce(text, '')) AS digest FROM documents WHERE doc_id % 7 <> 0),
b AS (SELECT CASE WHEN doc_id % 5 = 0 THEN doc_id + 10000000 ELSE doc_id END AS name, sha256(coalesce(text, '') || CASE WHEN doc_id % 11 = 0 THEN '!' ELSE '' END) AS digest FROM documents WHERE doc_id % 13 <> 0),
j AS (SELECT a.digest AS old, b.digest AS new FROM a FULL JOIN b USING (name)),
g AS (SELECT old AS digest, count(*) AS g FROM j WHERE new IS NULL GROUP BY 1), c AS (SELECT new AS digest, count(*) AS c FROM j WHERE old IS NULL GROUP BY 1),
p AS (SELECT coalesce(g, 0) AS g, coalesce(c, 0) AS c, least(coalesce(g, 0), coalesce(c, 0)) AS r FROM g FULL JOIN c USING (digest))
SELECT CASE WHEN old = new THEN 'same' ELSE 'changed' END AS kind, count(*) AS n FROM j WHERE old IS NOT NULL AND new IS NOT NULL GROUP BY 1
UNION ALL SELECT 'renamed', CAST(sum(r) AS BIGINT) FROM p UNION ALL SELECT 'removed', CAST(sum(g - r) AS BIGINT) FROM p UNION ALL SELECT 'added', CAST(sum(c - r) AS BIGINT) FROM p""")
def corpus_diff_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two states of one corpus, made from documents by rule: some rows go, come, change their name or their text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    i = F.col("doc_id")
    before = docs.where(i % 7 != 0).select(i.alias("name"), F.sha2("text", 256).alias("digest"))
    name, text = F.when(i % 5 == 0, i + 10_000_000).otherwise(i), F.concat("text", F.when(i % 11 == 0, "!").otherwise(""))
    return corpus.changes(before, docs.where(i % 13 != 0).select(name.alias("name"), F.sha2(text, 256).alias("digest")))


@query("""WITH t AS (SELECT event_type, count(*) AS n, count(*) FILTER (value > 10) AS hits FROM events GROUP BY 1), r AS (SELECT *, hits / n AS p, 1.96 * 1.96 AS zz FROM t)
SELECT event_type, n, hits, round(greatest((p + zz / (2 * n) - 1.96 * sqrt(p * (1 - p) / n + zz / (4 * n * n))) / (1 + zz / n), 0), 6) AS low,
    round(least((p + zz / (2 * n) + 1.96 * sqrt(p * (1 - p) / n + zz / (4 * n * n))) / (1 + zz / n), 1), 6) AS high FROM r""")
def wilson_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("value") > 10).alias("hits"))
    return counts.withColumn("w", titles.wilson(F.col("hits"), F.col("n"))).select("event_type", "n", "hits", "w.low", "w.high")


@query("""WITH y AS (SELECT event_type, avg(value) AS yield FROM events GROUP BY 1), b AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2)
SELECT user_id, CAST(sum(n) AS BIGINT) AS backlog, round(sum(n * yield), 4) AS expected FROM b JOIN y USING (event_type) GROUP BY user_id""")
def backlog_yield(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    yields = search.few(events.groupBy("event_type").agg(F.avg("value").alias("yield")))
    rows = events.groupBy("user_id", "event_type").agg(F.count("*").alias("n")).join(yields, "event_type")
    return rows.groupBy("user_id").agg(F.sum("n").alias("backlog"), F.round(F.sum(F.col("n") * F.col("yield")), 4).alias("expected"))


@query("""SELECT event_id, sum(CAST(floor(value) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC ROWS UNBOUNDED PRECEDING) <= 500 AS kept FROM events WHERE value IS NOT NULL""")
def retention_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").where("value IS NOT NULL").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), F.floor("value").alias("size"))
    return corpus.within_budget(rows, "user_id", "size", "ts", "event_id", 500).select("event_id", "kept")


@query("""WITH o AS (SELECT user_id, event_id, epoch_us(ts) AS t, lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events),
s AS (SELECT user_id, t, sum(CASE WHEN before IS NULL OR t - before > 3600000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS session FROM o)
SELECT user_id, CAST(session AS BIGINT) AS session, count(*) AS n, min(t) AS first_us, max(t) AS last_us FROM s GROUP BY 1, 2""")
def session_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"))
    out = corpus.sessions(rows, "user_id", "ts", "event_id", 3600)
    return out.select("user_id", "session", "n", F.unix_micros("first_at").alias("first_us"), F.unix_micros("last_at").alias("last_us"))


@query("""WITH n AS (SELECT count(*) AS n FROM documents) SELECT unnest(['id present', 'text present', 'known language', 'length agrees', 'source named']) AS rule,
    unnest([count(*) FILTER (doc_id IS NULL), count(*) FILTER (coalesce(text, '') = ''), count(*) FILTER (NOT coalesce(lang IN ('en', 'fr', 'de', 'es'), false)),
    count(*) FILTER (NOT coalesce(length(text) = n_chars, false)), count(*) FILTER (NOT coalesce(regexp_matches(source, '^src[0-9]+$'), false))]) AS broken, any_value(n) AS n FROM documents, n""")
def invariants_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return corpus.rule_counts(
        table(spark, sf_dir, "documents"),
        {
            "id present": c("doc_id").isNotNull(),
            "text present": F.coalesce("text", F.lit("")) != "",
            "known language": c("lang").isin("en", "fr", "de", "es"),
            "length agrees": F.length("text") == c("n_chars"),
            "source named": c("source").rlike("^src[0-9]+$"),
        },
    )


@query("SELECT source, quantile_disc(n_chars, 0.5) AS median, min(n_chars) AS low, max(n_chars) AS high, count(*) AS n FROM documents WHERE n_chars IS NOT NULL AND source IS NOT NULL GROUP BY source")
def length_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").where("n_chars IS NOT NULL AND source IS NOT NULL")
    return rows.groupBy("source").agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY n_chars)").cast("long").alias("median"), F.min("n_chars").alias("low"), F.max("n_chars").alias("high"), F.count("*").alias("n"))


@query("""SELECT lang, count(*) AS n, count(*) FILTER (n_chars >= 30) AS over30, count(*) FILTER (n_chars >= 200) AS over200, count(*) FILTER (n_chars >= 1000) AS over1000
FROM documents GROUP BY lang""")
def coverage_by_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    over = lambda n: F.count_if(F.col("n_chars") >= n).alias(f"over{n}")
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("n"), over(30), over(200), over(1000))


@query("""SELECT lower(role) AS key, mode(role) AS spelling, count(*) AS n FROM conversations GROUP BY 1""")
def canonical_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").groupBy(F.lower("role").alias("key"), "role").agg(F.count("*").alias("n"))
    return rows.groupBy("key").agg(F.min_by("role", F.struct(-F.col("n"), "role")).alias("spelling"), F.sum("n").alias("n"))
