"""Queries over records of songs, pages, folders, tags and tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from neumata.functions import melody, titles, tokens as T
from neumata.operators import corpus, records as R
from neumata.plans.base import NAMES_SQL, SONGS_SQL, TOKENS_SQL, fragments, fragments_sql, names, query, songs, table, tokens, windows_sql


@query(f"""WITH {SONGS_SQL}, t AS (SELECT song_id, [songs.lang, ['ok', 'ocr', 'midi'][1 + song_id % 3]] AS status, length(digits) AS n, length(coalesce(text, '')) AS n_tokens FROM songs JOIN documents ON song_id = doc_id)
SELECT song_id, array_to_string(list_filter([CASE WHEN NOT list_has_any(status, ['ok', 'ocr', 'converted']) THEN 'status' END, CASE WHEN n = 0 THEN 'empty' END, CASE WHEN n < 5 THEN 'short' END,
    CASE WHEN n_tokens >= 40 AND 2 * n < n_tokens THEN 'low digit' END], lambda x: x IS NOT NULL), ',') AS reasons FROM t""")
def quarantine_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.length(text).alias("n_tokens"), F.length(melody.text_digits(F.col("text"))).alias("n"))
    status = F.array("lang", F.get(F.array(*map(F.lit, ("ok", "ocr", "midi"))), (F.col("doc_id") % 3).cast("int")))
    why = R.reasons({"status": ~R.status_counts(status), "empty": F.col("n") == 0, "short": F.col("n") < 5, "low digit": R.low_digit(F.col("n"), F.col("n_tokens"))})
    return rows.select(F.col("doc_id").alias("song_id"), F.array_join(why, ",").alias("reasons"))


@query(f"WITH {fragments_sql(9)} SELECT query_id, length(left(q, query_id % 10)) < 5 AS refused FROM fragments")
def query_refusal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries of less than five notes are refused."""
    q = F.left("q", (F.col("query_id") % 10).cast("int"))
    return fragments(spark, sf_dir, 9).select("query_id", (F.length(q) < 5).alias("refused"))


@query("SELECT p_partkey, p_partkey % 8 >= 5 OR (p_size % 9 >= 5 AND p_partkey % 8 >= 4) AS impure FROM part")
def impure_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", R.impure(F.col("p_size") % 9, F.col("p_partkey") % 8).alias("impure"))


@query("""WITH k AS (SELECT o_orderkey AS k FROM orders), n AS (SELECT count(*) AS n FROM k)
SELECT unnest(['file', 'title', 'status', 'source', 'identifier', 'tags', 'notes', 'bars rise', 'bars bounded', 'beats', 'sections', 'tokens', 'link']) AS rule, unnest([
    greatest(count(*) FILTER (k % 50 = 0), 1) - 1, count(*) FILTER (k % 11 = 0), count(*) FILTER (k % 4 = 3), count(*) FILTER (k % 5 = 0), count(*) FILTER (k % 3 = 2), count(*) FILTER (k % 7 = 0), count(*) FILTER (k % 2 = 1),
    count(*) FILTER (k % 13 = 0), count(*) FILTER (k % 17 = 0 AND k % 13 <> 0 OR k % 2 = 1 AND (k % 13 = 0 OR k % 17 <> 0)), count(*) FILTER (k % 19 = 0), count(*) FILTER (k % 23 = 0), count(*) FILTER (k % 2 = 1), count(*) FILTER (k % 29 = 0)]) AS broken FROM k""")
def song_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules of song records, over records made from orders by rule, most of which break one."""
    k = F.col("o_orderkey")
    text = lambda c: F.lit(c)
    listed = lambda *v: F.array(*map(F.lit, v))
    score = F.when(k % 2 == 0, "1 2 | 3").otherwise("1 ?")
    rows = table(spark, sf_dir, "orders").select(
        F.when(k % 50 == 0, "f0").otherwise(F.concat(text("f"), k.cast("string"))).alias("file"),
        F.when(k % 11 == 0, " ").otherwise("t").alias("title"),
        F.array(F.get(listed("ok", "ocr", "converted", "midi"), (k % 4).cast("int"))).alias("status"),
        F.when(k % 5 == 0, "Bad").otherwise(F.concat(text("site-"), k.cast("string"))).alias("source"),
        F.when(k % 3 == 0, "").when(k % 3 == 1, "123e4567-e89b-42d3-a456-426614174000").otherwise("x").alias("MBID"),
        listed("a", "b").alias("tag"),
        F.when(k % 7 == 0, listed("c")).otherwise(listed("a")).alias("usertag"),
        score.alias("score"),
        F.lit(3).alias("n_notes"),
        F.when(k % 13 == 0, listed(2, 2)).when(k % 17 == 0, listed(9)).otherwise(listed(1, 2)).alias("bars"),
        F.when(k % 19 == 0, 0.0).otherwise(4.0).alias("beats_per_bar"),
        F.when(k % 23 == 0, F.array(score, score)).otherwise(F.array(score)).alias("sections"),
        F.when(k % 29 == 0, listed("nolink")).otherwise(listed("https://a.b/c")).alias("link"),
    )
    repeated = rows.groupBy("file").agg(F.count("*").alias("n")).agg(F.lit("file").alias("rule"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0).cast("long")).alias("broken"))
    return repeated.unionByName(corpus.rule_counts(rows, R.song_rules()).select("rule", "broken"))


@query(f"""WITH {SONGS_SQL}, led AS (SELECT *, min(song_id) OVER (PARTITION BY title) AS first_id FROM songs)
SELECT a.song_id, {", ".join(f"greatest(length(replace(b.digits, '{d}', '')) - length(b.digits) - length(replace(a.digits, '{d}', '')) + length(a.digits), 0) AS more{d}" for d in range(1, 8))}
FROM led a JOIN songs b ON b.song_id = a.first_id WHERE a.song_id <> a.first_id""")
def bag_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many more of each degree a version has than the first of its title. Only seven counts a song are shuffled."""
    count = lambda d: F.length("digits") - F.length(F.replace("digits", F.lit(str(d)), F.lit("")))
    bags = songs(spark, sf_dir).select("song_id", "title", *(count(d).alias(f"n{d}") for d in range(1, 8)))
    first = bags.groupBy("title").agg(F.min_by(F.struct("song_id", *(f"n{d}" for d in range(1, 8))), "song_id").alias("f"))
    both = bags.join(first, "title").where("song_id <> f.song_id")
    return both.select("song_id", *(F.greatest(F.col(f"n{d}") - F.col(f"f.n{d}"), F.lit(0)).cast("long").alias(f"more{d}") for d in range(1, 8)))


@query("""SELECT source, sorted[len(sorted) // 2 + 1] AS upper_median, sorted[greatest(CAST(ceil(0.9 * len(sorted)) AS INT), 1)] AS p90 FROM (
    SELECT source, list_sort(list(n_chars)) AS sorted FROM documents WHERE n_chars IS NOT NULL AND source IS NOT NULL GROUP BY source)""")
def upper_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upper median and the nearest-rank 0.9 quantile, from counts per value: values, not rows, are put in order."""
    counts = table(spark, sf_dir, "documents").where("n_chars IS NOT NULL AND source IS NOT NULL").groupBy("source", "n_chars").agg(F.count("*").alias("k"))
    return corpus.nearest_ranks(counts, "source", "n_chars", {"upper_median": lambda n: F.floor(n / 2) + 1, "p90": lambda n: F.greatest(F.ceil(n * 9 / 10), F.lit(1))})


@query("""SELECT CASE WHEN n_chars >= 1000 THEN '>=1000' WHEN n_chars >= 200 THEN '200-999' WHEN n_chars >= 50 THEN '50-199' WHEN n_chars IS NOT NULL THEN '<50' ELSE 'unknown' END AS bucket, count(*) AS n FROM documents GROUP BY 1""")
def length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_chars")
    bucket = F.when(n >= 1000, ">=1000").when(n >= 200, "200-999").when(n >= 50, "50-199").when(n.isNotNull(), "<50").otherwise("unknown")
    return table(spark, sf_dir, "documents").groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


@query("""SELECT unnest(['doc_id', 'text', 'lang', 'source', 'n_chars']) AS field, unnest([count(doc_id), count(text), count(lang), count(source), count(n_chars)]) AS present,
    unnest([count(doc_id), count(nullif(text, '')), count(nullif(lang, '')), count(nullif(source, '')), count(n_chars)]) AS filled, count(*) AS n FROM documents""")
def field_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows have each field at all, and how many have something in it; one pass."""
    return corpus.field_profile(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars"))


@query(f"""WITH {SONGS_SQL}, ends AS (SELECT song_id, length(digits) AS n, list_filter(range(1, length(digits) + 1), lambda i: i = length(digits) OR digits[i] <> digits[i + 1]) AS e FROM songs WHERE digits <> '')
SELECT song_id, e[1] AS head, coalesce(list_max(list_transform(range(2, len(e) + 1), lambda k: e[k] - e[k - 1])), 0) AS inside FROM ends""")
def head_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The length of a song's first run of one note, and of its longest later run."""
    lengths = F.transform(F.regexp_extract_all("digits", F.lit(r"(.)\1*"), F.lit(0)), lambda r: F.length(r))
    rows = songs(spark, sf_dir).where("digits <> ''").select("song_id", lengths.alias("r"))
    inside = F.coalesce(F.array_max(F.slice("r", 2, F.size("r"))), F.lit(0))
    return rows.select("song_id", F.get("r", F.lit(0)).cast("long").alias("head"), inside.cast("long").alias("inside"))


@query(f"""WITH {SONGS_SQL}, {windows_sql(7)}, counted AS (SELECT song_id, pos, count(*) OVER (PARTITION BY song_id, w) - 1 AS again FROM windows),
covered AS (SELECT song_id, p, max(again) AS again FROM (SELECT song_id, again, unnest(range(pos, pos + 7)) AS p FROM counted) GROUP BY 1, 2)
SELECT song_id, max(again) AS most, count(*) FILTER (again > 0) AS repeated FROM covered GROUP BY song_id""")
def repeat_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the most repeated window of a song comes again, and how many notes lie in a repeated one; within the row."""

    @F.pandas_udf("struct<most:long,repeated:long>")
    def profile(texts):
        return melody.repeat_profile(texts, 7)

    rows = songs(spark, sf_dir).where(F.length("digits") >= 7).select("song_id", profile("digits").alias("p"))
    return rows.select("song_id", "p.most", "p.repeated")


@query("""SELECT p_brand, max(p_size * w) AS popularity FROM (SELECT *, CASE WHEN contains(p_name, 'a') THEN 1.0 WHEN length(p_name) > 10 THEN 0.5 ELSE 0.2 END::DOUBLE AS w FROM part) GROUP BY p_brand""")
def weighted_popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best of plays times how well a title fits."""
    weight = F.when(F.col("p_name").contains("a"), 1.0).when(F.length("p_name") > 10, 0.5).otherwise(0.2)
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(F.max(F.col("p_size") * weight).alias("popularity"))


@query("""SELECT min(doc_id) AS kept, count(*) AS n, count(DISTINCT source) > 1 AS cross_source FROM documents WHERE coalesce(text, '') <> '' GROUP BY text HAVING count(*) > 1""")
def identical_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts, whether of one source or several; texts meet as digests."""
    rows = table(spark, sf_dir, "documents").where("coalesce(text, '') <> ''").select("doc_id", "source", F.sha2("text", 256).alias("key"))
    groups = rows.groupBy("key").agg(F.min("doc_id").alias("kept"), F.count("*").alias("n"), F.coalesce(F.min("source") != F.max("source"), F.lit(False)).alias("cross_source"))
    return groups.where("n > 1").select("kept", "n", "cross_source")


@query(f"""WITH {NAMES_SQL}, t AS (SELECT p_brand, name, regexp_matches(name, '{titles.INSTRUMENTS}') AS bad, NOT contains(name, '__sitea-') AS other, length(split_part(name, '__', 1)) AS n FROM names JOIN part USING (p_partkey))
SELECT p_brand, arg_min(name, (bad, other, n, name)) AS name, count(*) AS n_rows FROM t GROUP BY p_brand""")
def canonical_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the versions of a song the one that stands for it: no arrangement, the better site, the shorter name, the first by name."""
    rows = names(spark, sf_dir).join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_partkey")
    keys = {"bad": F.col("name").rlike(titles.INSTRUMENTS), "other": ~F.col("name").contains("__sitea-"), "length": F.length(F.substring_index("name", "__", 1))}
    rows = rows.select("p_brand", "name", *(c.alias(k) for k, c in keys.items()))
    return corpus.keep_one(rows, ["p_brand"], ["bad", "other", "length", "name"]).select("p_brand", "name", "n_rows")


@query("""SELECT o_orderpriority, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice, o_orderkey) AS k FROM orders) WHERE k <= 5""")
def round_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five of each source a round, the cheapest first."""
    rows = table(spark, sf_dir, "orders").select("o_orderpriority", "o_totalprice", "o_orderkey")
    return R.first_of_each(rows, ["o_orderpriority"], ["o_totalprice", "o_orderkey"], 5).select("o_orderpriority", "o_orderkey")


@query("""SELECT l_orderkey, arg_max(track, (mean, n, -track)) AS track FROM (SELECT l_orderkey, l_suppkey % 3 AS track, avg(l_partkey % 40) AS mean, count(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY 1""")
def melody_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The track of each song that lies highest, of equals the one with more notes, then the first."""
    tracks = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", (F.col("l_suppkey") % 3).alias("track")).agg(F.avg(F.col("l_partkey") % 40).alias("mean"), F.count("*").alias("n"))
    return tracks.groupBy("l_orderkey").agg(F.max(F.struct("mean", "n", (-F.col("track")).alias("less"))).alias("b")).select("l_orderkey", (-F.col("b.less")).alias("track"))


@query("""WITH t AS (SELECT p_partkey, [p_mfgr, 'x'] AS tag, [p_brand, 'x'] AS usertag FROM (SELECT *, p_partkey % 5 AS p_mfgr2, 'm' || p_partkey % 5 AS p_mfgr FROM part))
SELECT p_partkey, array_to_string(list_concat(tag, list_filter(usertag, lambda x: NOT list_contains(tag, x))), ',') AS added, array_to_string(list_filter(tag, lambda x: NOT list_contains(usertag, x)), ',') AS removed,
    len(list_filter(usertag, lambda x: NOT list_contains(tag, x))) = 0 AS within, least(p_partkey % 7, p_partkey % 11) AS either FROM t""")
def tag_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered union and difference of tags, whether one list is within the other, and the better of two ranks."""
    k = F.col("p_partkey")
    tag, usertag = F.array(F.concat(F.lit("m"), (k % 5).cast("string")), F.lit("x")), F.array("p_brand", F.lit("x"))
    joined = lambda c: F.array_join(c, ",")
    return table(spark, sf_dir, "part").select(
        "p_partkey", joined(R.added(tag, usertag)).alias("added"), joined(R.removed(tag, usertag)).alias("removed"), (F.size(F.array_except(usertag, tag)) == 0).alias("within"), F.least(k % 7, k % 11).alias("either")
    )


@query("""SELECT view, count(*) AS n, count(DISTINCT title) AS titles FROM (SELECT 'delivered' AS view, p_brand AS title FROM part WHERE p_size < 20 UNION ALL SELECT 'pending', p_brand FROM part WHERE p_size BETWEEN 20 AND 39
    UNION ALL SELECT 'duplicate', p_brand FROM part WHERE p_size >= 40) GROUP BY view""")
def coverage_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered, pending and duplicate rows as one table, counted by view."""
    part, size = table(spark, sf_dir, "part"), F.col("p_size")
    views = {"delivered": size < 20, "pending": size.between(20, 39), "duplicate": size >= 40}
    every = None
    for name, ok in views.items():
        rows = part.where(ok).select(F.lit(name).alias("view"), F.col("p_brand").alias("title"))
        every = rows if every is None else every.unionByName(rows)
    by_title = every.groupBy("view", "title").agg(F.count("*").alias("n"))
    return by_title.groupBy("view").agg(F.sum("n").alias("n"), F.count("*").alias("titles"))


@query("""WITH img AS (SELECT l_suppkey AS site, l_partkey % 50 AS ident, count(*) AS pages FROM lineitem GROUP BY 1, 2), s AS (SELECT o_orderkey, o_custkey % 100 + 1 AS site, o_orderkey % 60 AS ident FROM orders), f AS (SELECT ident, count(*) AS pages FROM lineitem, (SELECT unnest(range(60)) AS ident) WHERE l_partkey % 60 = ident GROUP BY 1)
SELECT o_orderkey, coalesce(img.pages, f.pages, 0) AS pages FROM s LEFT JOIN img USING (site, ident) LEFT JOIN f ON f.ident = s.ident""")
def page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of each song's image folder, by site and number and, where there is none, by number alone."""
    line = table(spark, sf_dir, "lineitem")
    image = line.groupBy(F.col("l_suppkey").alias("site"), (F.col("l_partkey") % 50).alias("ident")).agg(F.count("*").alias("pages"))
    other = line.groupBy((F.col("l_partkey") % 60).alias("ident")).agg(F.count("*").alias("other_pages"))
    song = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 100 + 1).alias("site"), (F.col("o_orderkey") % 60).alias("ident"))
    both = song.join(image, ["site", "ident"], "left").join(other, "ident", "left")
    return both.select("o_orderkey", F.coalesce("pages", "other_pages", F.lit(0)).cast("long").alias("pages"))


@query(f"""WITH {SONGS_SQL}, firsts AS (SELECT title, site, arg_min(digits, song_id) AS digits, min(song_id) AS song_id FROM songs GROUP BY 1, 2)
SELECT a.song_id AS a, b.song_id AS b FROM firsts a JOIN firsts b ON a.title = b.title AND a.site < b.site WHERE length(a.digits) >= 20 AND length(b.digits) >= 20""")
def cross_site_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of versions of one title from two sites; each site speaks with its first version, so a title has as many pairs as pairs of sites."""
    firsts = songs(spark, sf_dir).groupBy("title", "site").agg(F.min_by(F.struct("song_id", F.length("digits").alias("n")), "song_id").alias("f"))
    side = lambda c: firsts.where("f.n >= 20").select("title", F.col("site").alias(f"{c}_site"), F.col("f.song_id").alias(c))
    return side("a").join(side("b"), "title").where("a_site < b_site").select("a", "b")


@query(f"""WITH {SONGS_SQL}, longs AS (SELECT site, title, arg_max(song_id, (length(digits), -song_id)) AS better FROM songs WHERE length(digits) >= 200 GROUP BY 1, 2)
SELECT song_id, better FROM songs JOIN longs USING (site, title) WHERE length(digits) BETWEEN 1 AND 199""")
def short_vs_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short scores of which the same source has a long one, the longest."""
    rows = songs(spark, sf_dir).select("song_id", "site", "title", F.length("digits").alias("n"))
    better = rows.where("n >= 200").groupBy("site", "title").agg(F.max(F.struct("n", (-F.col("song_id")).alias("less"))).alias("b"))
    return rows.where("n BETWEEN 1 AND 199").join(better, ["site", "title"]).select("song_id", (-F.col("b.less")).alias("better"))


@query("""WITH clean AS (SELECT c_nationkey, c_mktsegment, min(c_name) AS twin FROM customer WHERE c_custkey % 3 <> 0 GROUP BY 1, 2)
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN coalesce(twin, c_name) ELSE c_name END AS name FROM customer LEFT JOIN clean USING (c_nationkey, c_mktsegment)""")
def twin_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A broken name is replaced by that of a clean twin under the same key, if there is one."""
    rows, broken = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), F.col("c_custkey") % 3 == 0
    clean = rows.where(~broken).groupBy("c_nationkey", "c_mktsegment").agg(F.min("c_name").alias("twin"))
    both = rows.join(clean, ["c_nationkey", "c_mktsegment"], "left")
    return both.select("c_custkey", F.when(broken, F.coalesce("twin", "c_name")).otherwise(F.col("c_name")).alias("name"))


@query("""SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_linenumber = 1) AND p_partkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def rescue_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is neither in the corpus nor set aside on purpose: two anti joins."""
    held = table(spark, sf_dir, "lineitem").where("l_linenumber = 1").select(F.col("l_partkey").alias("p_partkey"))
    aside = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("p_partkey"))
    return table(spark, sf_dir, "part").select("p_partkey").join(held, "p_partkey", "left_anti").join(aside, "p_partkey", "left_anti")


LETTERS = "len(list_distinct(list_filter(string_split({}, ''), lambda x: x <> '')))"


@query(r"""WITH t AS (SELECT p_partkey, p_name AS title, CASE p_partkey % 3 WHEN 0 THEN upper(p_name) WHEN 1 THEN reverse(p_name) ELSE p_type END AS found, p_partkey % 2 = 0 AS fits, p_size * 2 AS score FROM part),
b AS (SELECT *, regexp_replace(lower(title), '\s+', '', 'g') AS x, regexp_replace(lower(found), '\s+', '', 'g') AS y FROM t), c AS (SELECT *, x = y AS exact, score >= 90 AND length(y) >= 2 AND
    2 * len(list_intersect(list_distinct(list_filter(string_split(x, ''), lambda c: c <> '')), list_distinct(list_filter(string_split(y, ''), lambda c: c <> '')))) >= greatest(length(x), length(y)) AS near FROM b)
SELECT p_partkey, CASE WHEN exact AND fits THEN CASE WHEN score >= 90 THEN 'high' ELSE 'medium' END WHEN exact OR near THEN CASE WHEN score >= 90 THEN 'medium' ELSE 'low' END END AS tier FROM c""")
def identifier_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    found = F.when(k % 3 == 0, F.upper("p_name")).when(k % 3 == 1, F.reverse("p_name")).otherwise(F.col("p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", R.identifier_tier(F.col("p_name"), found, k % 2 == 0, F.col("p_size") * 2).alias("tier"))


@query("""WITH rates AS (SELECT source AS section, lang AS tag, count(*) / sum(count(*)) OVER (PARTITION BY source) AS rate FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL GROUP BY 1, 2),
best AS (SELECT section, max(rate) AS rate, arg_min(tag, (-rate, tag)) AS tag FROM rates GROUP BY section) SELECT section, tag, round(rate, 6) AS rate, rate >= 0.25 AS applied FROM best""")
def tag_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each section's most likely tag with its measured rate; it is applied only from a least rate on."""
    counts = table(spark, sf_dir, "documents").where("source IS NOT NULL AND lang IS NOT NULL").groupBy(F.col("source").alias("section"), F.col("lang").alias("tag")).agg(F.count("*").alias("n"))
    best = counts.groupBy("section").agg(F.sum("n").alias("all"), F.min(F.struct((-F.col("n")).alias("less"), "tag")).alias("b"))
    rate = -F.col("b.less") / F.col("all")
    return best.select("section", "b.tag", F.round(rate, 6).alias("rate"), (rate >= 0.25).alias("applied"))


@query("""SELECT p_partkey, array_to_string(list_distinct_ordered, ',') AS tags FROM (SELECT p_partkey, list_filter([a, CASE WHEN b = a THEN NULL ELSE b END, CASE WHEN c = a OR c = b THEN NULL ELSE c END], lambda x: x IS NOT NULL) AS list_distinct_ordered
    FROM (SELECT p_partkey, CASE WHEN p_size > 25 THEN 'page' || p_size % 3 END AS a, CASE WHEN p_brand LIKE '%1' THEN 'page1' ELSE 'batch' END AS b, CASE WHEN contains(p_name, 'e') THEN 'batch' WHEN contains(p_name, 'o') THEN 'title' END AS c FROM part))""")
def tag_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags from the page, then the batch, then the title, each once."""
    page = F.when(F.col("p_size") > 25, F.concat(F.lit("page"), (F.col("p_size") % 3).cast("string")))
    batch = F.when(F.col("p_brand").endswith("1"), "page1").otherwise("batch")
    title = F.when(F.col("p_name").contains("e"), "batch").when(F.col("p_name").contains("o"), "title")
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(F.array_distinct(F.array_compact(F.array(page, batch, title))), ",").alias("tags"))


@query("""WITH RECURSIVE edges AS (SELECT DISTINCT lower(left(p_brand, 7)) AS parent, p_brand AS child FROM part UNION ALL SELECT DISTINCT p_brand, p_type FROM part
), closure AS (SELECT parent AS ancestor, child, 1 AS depth FROM edges UNION ALL SELECT c.ancestor, e.child, depth + 1 FROM closure c JOIN edges e ON c.child = e.parent
), up AS (SELECT ancestor, child, min(depth) AS depth FROM closure GROUP BY ALL
), given AS (SELECT p_partkey, p_type AS tag, 0 AS i FROM part UNION ALL SELECT p_partkey, 's' || p_size, 1 FROM part
), gone AS (SELECT p_partkey, p_brand AS gone FROM part WHERE p_size % 2 = 0
), every AS (SELECT p_partkey, tag, min((i, depth)) AS place FROM (SELECT p_partkey, tag, i, 0 AS depth FROM given UNION ALL SELECT p_partkey, ancestor, i, depth FROM given JOIN up ON child = tag) GROUP BY 1, 2
), kept AS (SELECT * FROM every e WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.p_partkey = e.p_partkey AND (g.gone = e.tag OR EXISTS (SELECT 1 FROM up WHERE child = e.tag AND ancestor = g.gone))))
SELECT p.p_partkey, coalesce(string_agg(tag, ',' ORDER BY place, tag), '') AS tags FROM part p LEFT JOIN kept k ON p.p_partkey = k.p_partkey GROUP BY 1""")
def tag_negation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of parts as tags that imply every brand that has them, and so the brand's family; every other part negates its brand."""
    part = table(spark, sf_dir, "part")
    edges = part.select(F.lower(F.left("p_brand", F.lit(7))).alias("parent"), F.col("p_brand").alias("child")).distinct().union(part.select("p_brand", "p_type").distinct())
    tags = F.array_compact(F.array("p_type", F.concat(F.lit("s"), F.col("p_size").cast("string")), F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("!"), "p_brand"))))
    out = R.implied_tags(part.select("p_partkey", tags.alias("tags")), "p_partkey", corpus.closure(spark, edges))
    return out.select("p_partkey", F.array_join("tags", ",").alias("tags"))


@query(r"""WITH t AS (SELECT page_id, url, lower(regexp_replace(trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g')), '[\s\-_.,]+', '', 'g')) AS title FROM pages),
w AS (SELECT *, CASE WHEN page_id % 2 = 0 THEN left(title, 6) ELSE 'zzzz' END AS wanted, CAST(page_id AS VARCHAR) AS ident FROM t)
SELECT page_id, CASE WHEN length(wanted) >= 2 AND contains(title, wanted) THEN 'title' WHEN page_id % 3 = 0 AND regexp_extract(url, '/p?([0-9a-z_]+)(?:\.html?)?$', 1) = ident THEN 'id' END AS evidence FROM w""")
def page_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, title = F.col("page_id"), titles.page_title(F.col("html"))
    bare = F.lower(F.regexp_replace(title, r"[\s\-_.,]+", ""))
    wanted = F.when(k % 2 == 0, F.left(bare, F.lit(6))).otherwise("zzzz")
    return table(spark, sf_dir, "pages").select("page_id", R.page_evidence(title, wanted, F.col("url"), k.cast("string"), k % 3 == 0).alias("evidence"))


@query("""WITH i AS (SELECT l_orderkey AS o_orderkey, count(*) AS images FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1)
SELECT o_orderkey, CASE WHEN coalesce(images, 0) = 0 THEN 'no image' WHEN o_orderkey % 5 = 0 THEN 'dropped pages' WHEN images >= 2 OR o_custkey % 4 >= 2 THEN 'pages not read' ELSE 'short song' END AS kind FROM orders LEFT JOIN i USING (o_orderkey)""")
def fragment_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = table(spark, sf_dir, "lineitem").where("l_returnflag <> 'N'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("images"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(images, "o_orderkey", "left")
    dropped = F.when(F.col("o_orderkey") % 5 == 0, 1).otherwise(0)
    return rows.select("o_orderkey", R.triage(F.col("images"), dropped, F.col("o_custkey") % 4).alias("kind"))


@query("""WITH new AS (SELECT p_brand AS title, p_partkey, p_size, contains(p_type, 'STEEL') AS arranged FROM part WHERE p_size > 3 AND p_brand NOT IN (SELECT p_brand FROM part WHERE p_size = 1))
SELECT title, min(p_partkey) AS p_partkey, arg_min(arranged, p_partkey) AS arranged, count(*) - 1 AS repeats FROM new GROUP BY title""")
def crawl_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New songs in the order found, each title once, without what is in the corpus or has no image; arrangements are marked."""
    part = table(spark, sf_dir, "part").select(F.col("p_brand").alias("title"), "p_partkey", "p_size", F.col("p_type").contains("STEEL").alias("arranged"))
    new = part.where("p_size > 3").join(part.where("p_size = 1").select("title"), "title", "left_anti")
    best = corpus.keep_one(new.select("title", "p_partkey", "arranged"), ["title"], ["p_partkey"])
    return best.select("title", "p_partkey", "arranged", (F.col("n_rows") - 1).alias("repeats"))


@query("""WITH f AS (SELECT l_suppkey % 7 AS site, l_orderkey, count(*) AS pages FROM lineitem GROUP BY 1, 2) SELECT site, count(*) AS folders, CAST(sum(pages) AS BIGINT) AS pages, count(*) FILTER (pages = 1) AS single FROM f GROUP BY site""")
def stock_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image folders, pages and single pages of each site."""
    folders = table(spark, sf_dir, "lineitem").groupBy((F.col("l_suppkey") % 7).alias("site"), "l_orderkey").agg(F.count("*").alias("pages"))
    return folders.groupBy("site").agg(F.count("*").alias("folders"), F.sum("pages").alias("pages"), F.count_if(F.col("pages") == 1).alias("single"))


@query("""SELECT count(*) > 0 AND bool_and(doc_id IS NOT NULL) AND bool_and(n_chars IS NULL OR n_chars >= 0) AND count(DISTINCT lang) <= 10 AS accepted, count(*) FILTER (coalesce(text, '') = '') = 0 AS complete FROM documents""")
def acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a delivery passes all of its checks, and whether nothing in it is empty; one pass."""
    all_of = lambda c: F.coalesce(F.bool_and(c), F.lit(True))
    ok = (F.count("*") > 0) & all_of(F.col("doc_id").isNotNull()) & all_of(F.col("n_chars").isNull() | (F.col("n_chars") >= 0)) & (F.count_distinct("lang") <= 10)
    return table(spark, sf_dir, "documents").agg(ok.alias("accepted"), (F.count_if(F.coalesce("text", F.lit("")) == "") == 0).alias("complete"))


@query("""WITH c AS (SELECT c_custkey, c_mktsegment AS title, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'n' || c_nationkey END AS artist FROM customer), many AS (SELECT title FROM c WHERE artist <> '' GROUP BY title HAVING count(DISTINCT artist) >= 2)
SELECT c_custkey, title || '（' || artist || '）' || CASE WHEN k > 1 THEN '_' || k ELSE '' END AS name FROM (SELECT *, row_number() OVER (PARTITION BY title, artist ORDER BY c_custkey) AS k FROM c SEMI JOIN many USING (title) WHERE artist <> '')""")
def disambiguating_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Songs of one title by two and more known artists get the artist into their name, and a number if that is not enough."""
    artist = F.when(F.col("c_custkey") % 4 == 0, "").otherwise(F.concat(F.lit("n"), F.col("c_nationkey").cast("string")))
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("title"), artist.alias("artist")).where("artist <> ''")
    many = rows.groupBy("title").agg((F.min("artist") != F.max("artist")).alias("several")).where("several").select("title")
    numbered = corpus.numbered_within(rows.join(many, "title", "left_semi"), ["title", "artist"], "c_custkey")
    name = F.concat("title", F.lit("（"), "artist", F.lit("）"), F.when(F.col("nth") > 1, F.concat(F.lit("_"), F.col("nth").cast("string"))).otherwise(""))
    return numbered.select("c_custkey", name.alias("name"))


@query("""WITH by_name AS (SELECT o_orderkey % 1500 + 1 AS c_custkey, min(o_orderpriority) AS v FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1), by_source AS (SELECT n_nationkey AS c_nationkey, n_name AS v FROM nation)
SELECT c_custkey, coalesce(nullif(CASE WHEN c_custkey % 2 = 0 THEN '' ELSE c_mktsegment END, ''), a.v, b.v) AS segment FROM customer LEFT JOIN by_name a USING (c_custkey) LEFT JOIN by_source b USING (c_nationkey)""")
def two_key_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blanks are filled by name and, where that fails, by source."""
    blank = F.when(F.col("c_custkey") % 2 == 0, "").otherwise(F.col("c_mktsegment"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", blank.alias("segment"))
    by_name = table(spark, sf_dir, "orders").where("o_orderkey % 3 = 0").groupBy((F.col("o_orderkey") % 1500 + 1).alias("c_custkey")).agg(F.min("o_orderpriority").alias("segment"))
    by_source = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("segment"))
    once = corpus.blank_filled(rows, by_name, "c_custkey", ["segment"])
    return corpus.blank_filled(once, by_source, "c_nationkey", ["segment"]).select("c_custkey", "segment")


@query("""WITH e AS (SELECT l_suppkey AS key, l_orderkey % 40 AS dir, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END AS p FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 10 = 0))
SELECT key, ['impure', 'texture', 'unread'][min(p)] AS verdict, CASE WHEN count(DISTINCT dir) = 1 THEN min(dir) END AS dir, count(*) AS evidence FROM e GROUP BY key""")
def evidence_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New keys only: the weightiest verdict on each, and the folder if the evidence names but one."""
    flag = F.col("l_returnflag")
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("key"), (F.col("l_orderkey") % 40).alias("dir"), F.when(flag == "R", 1).when(flag == "A", 2).otherwise(3).alias("p"))
    known = table(spark, sf_dir, "supplier").where("s_suppkey % 10 = 0").select(F.col("s_suppkey").alias("key"))
    best = rows.join(known, "key", "left_anti").groupBy("key").agg(F.min("p").alias("p"), F.min("dir").alias("low"), F.max("dir").alias("high"), F.count("*").alias("evidence"))
    verdict = F.get(F.array(*map(F.lit, ("impure", "texture", "unread"))), F.col("p") - 1)
    return best.select("key", verdict.alias("verdict"), F.when(F.col("low") == F.col("high"), F.col("low")).alias("dir"), "evidence")


@query(f"""WITH {TOKENS_SQL} SELECT song_id, idx, token, dur || CASE acc WHEN 1 THEN '#' WHEN -1 THEN 'b' ELSE '' END || octs || deg || dot AS again,
    CASE WHEN accs = '' THEN dur || CASE WHEN octs = ',' THEN ',' ELSE '' END || deg || CASE WHEN octs = '''' THEN '''' ELSE '' END || dot ELSE token END AS high_after,
    (CASE dur WHEN 'q' THEN 0.5 WHEN 's' THEN 0.25 WHEN 'd' THEN 0.125 ELSE 1.0 END * CASE WHEN dot = '.' THEN 1.5 ELSE 1 END)::DOUBLE * CASE WHEN true THEN 1 END AS written FROM tokens""")
def token_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens taken apart and put together again, with high marks behind the note, and their beats as written."""
    t = F.col("token")
    return tokens(spark, sf_dir).select("song_id", "idx", "token", R.token_of(R.token_parts(t)).alias("again"), R.high_after(t).alias("high_after"), R.written_beats(t).alias("written"))


@query("""WITH p AS (SELECT l_orderkey, l_linenumber AS number, l_orderkey % 5 = 0 AS second_first, 'p' || l_linenumber AS name, CAST(l_quantity * 40 AS INT) AS width, l_partkey % 2000 AS height, CAST(l_extendedprice AS BIGINT) AS size FROM lineitem),
real AS (SELECT *, 10 * height >= 13 * width AS portrait FROM p WHERE width > 100 AND height > 100), big AS (SELECT * FROM real QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY size DESC, number, name) = 1),
tall AS (SELECT l_orderkey, arg_min(name, (number, name)) AS name FROM real WHERE portrait GROUP BY 1),
two AS (SELECT l_orderkey, min(name) AS name FROM real WHERE second_first AND number = 2 GROUP BY 1)
SELECT l_orderkey, CASE WHEN w.name IS NOT NULL THEN w.name WHEN b.portrait OR t.name IS NULL THEN b.name ELSE t.name END AS name FROM big b LEFT JOIN tall t USING (l_orderkey) LEFT JOIN two w USING (l_orderkey)""")
def page_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and widths are rounded to the even neighbour, as a cast does in SQL: 0.5 is no larger than 0."""
    n = F.col("l_linenumber")
    pages = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", n.alias("number"), (F.col("l_orderkey") % 5 == 0).alias("second_first"), F.concat(F.lit("p"), n.cast("string")).alias("name"), F.rint(F.col("l_quantity") * 40).cast("int").alias("width"), (F.col("l_partkey") % 2000).alias("height"), F.rint("l_extendedprice").cast("long").alias("size")
    )
    return R.chosen_page(pages, "l_orderkey")


@query()
def rebarred_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores in bars of three beats, filled with rests; a test compares each bar with a plain fold."""
    written = tokens(spark, sf_dir).groupBy("song_id").agg(F.array_sort(F.collect_list(F.struct("idx", "token"))).alias("t"))
    return written.select("song_id", R.rebarred(F.transform("t", lambda x: x["token"]), 3.0).alias("bars"))


def _gaps():
    return F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("i"), (F.col("l_partkey") % 7).alias("gap"))))


@query()
def onset_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes of a track that begin within 3 ticks of the first of their group: how many groups, and the most notes in one.

    A group's limit counts from its start, so this is an ordered fold over one track; a test does it in plain Python.
    """
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(R.grouped_onsets(_gaps(), 3).alias("g")).select("l_orderkey", F.size("g").alias("groups"), F.array_max("g").alias("most"))


@query()
def minor_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores with the tonic of a minor key an octave lower; tested on literal tokens."""
    written = tokens(spark, sf_dir).groupBy("song_id").agg(F.array_sort(F.collect_list(F.struct("idx", "token"))).alias("t"))
    return written.select("song_id", F.array_join(F.transform("t", lambda x: R.minor_lowered(x["token"])), " ").alias("line"))


@query("""SELECT page_id, CASE page_id % 3 WHEN 0 THEN '6=A' WHEN 2 THEN '1=C' END AS key, CASE WHEN page_id % 2 = 0 THEN '2/4' END AS metre, 'notes ' || page_id AS body FROM pages""")
def model_controls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key, metre and body of texts as a recogniser writes them."""
    k = F.col("page_id")
    key = F.when(k % 3 == 0, "6=A").when(k % 3 == 1, "none").otherwise("1=C")
    text = F.concat(F.lit("#KEY "), key, F.lit("\n#TIME "), F.when(k % 2 == 0, "D2/4").otherwise("free"), F.lit("\nnotes "), k.cast("string"), F.lit("\n#TEMPO none"))
    return table(spark, sf_dir, "pages").select("page_id", R.controls(text).alias("c")).select("page_id", "c.key", "c.metre", "c.body")


@query(r"""WITH got AS (SELECT page_id, regexp_extract_all(html, '(?is)<img[^>]*src="([^"]*)"', 1) AS src, regexp_extract_all(html, '(?is)<a[^>]*href="([^"]*)"[^>]*>\s*(?:next|下一页)', 1)[1] AS next FROM pages)
SELECT page_id, len(src) AS images, src[1] AS first, next FROM got""")
def page_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The images of a detail page and the address of the next list page."""
    return R.page_details(table(spark, sf_dir, "pages")).select("page_id", F.size("images").cast("long").alias("images"), F.get("images", F.lit(0)).alias("first"), "next")


@query("""SELECT o_orderkey FROM orders WHERE o_orderkey % 3 <> 0 AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def manifest_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Downloads not yet in the manifest: an idempotent run takes only these."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").where("o_orderkey % 3 <> 0")
    done = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return rows.join(done, "o_custkey", "left_anti").select("o_orderkey")


@query(f"""WITH {SONGS_SQL}, lines AS (SELECT song_id, length(digits) AS n, unnest(range(greatest(CAST(ceil(length(digits) / 50.0) AS BIGINT), 1))) AS k, digits FROM songs)
SELECT song_id, CASE WHEN n = 0 THEN 0 ELSE k + 1 END AS line, array_to_string(string_split(substr(digits, 50 * k + 1, 50), ''), ' ') AS body FROM lines""")
def wrapped_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All scores as lines of 100 signs at most: 50 notes with their blanks. A song without notes has one empty line, numbered 0."""
    rows = songs(spark, sf_dir).select("song_id", F.posexplode_outer(R.wrapped(melody.symbols(F.col("digits")), F.lit(100))).alias("k", "body"))
    return rows.select("song_id", F.coalesce(F.col("k") + 1, F.lit(0)).cast("long").alias("line"), F.coalesce("body", F.lit("")).alias("body"))


@query("""WITH rows AS (SELECT l_orderkey AS page, l_linenumber AS row, l_partkey % 100 AS dark FROM lineitem), lit AS (SELECT *, dark > greatest(3, 0.4 * max(dark) OVER (PARTITION BY page)) AS text FROM rows),
runs AS (SELECT page, row, row - row_number() OVER (PARTITION BY page ORDER BY row) AS island FROM (SELECT DISTINCT page, row FROM lit WHERE text))
SELECT page, count(*) AS bands, max(n) AS tallest FROM (SELECT page, island, count(*) AS n FROM runs GROUP BY 1, 2) GROUP BY page""")
def row_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bands of rows of a page with enough dark pixels, from the row sums."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("row"), (F.col("l_partkey") % 100).alias("dark"))
    bands = R.row_bands(rows, 3, 0.4)
    return bands.groupBy("page").agg(F.count("*").alias("bands"), F.max("n").alias("tallest"))


@query("""SELECT p_partkey, p_size % 20 >= 17 OR (p_partkey % 9 >= 6 AND p_partkey % 4 >= 1) AS accepted FROM part""")
def band_acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bands that are notes: most components tall, or six tall ones and an underline."""
    tall_share, tall, lines = (F.col("p_size") % 20) / 20, F.col("p_partkey") % 9, F.col("p_partkey") % 4
    return table(spark, sf_dir, "part").select("p_partkey", R.is_note_band(tall_share, tall, lines).alias("accepted"))


@query("""SELECT p_partkey, least(p_partkey % 3 * 2, 4) AS beam, least(p_partkey % 4, 3) AS low, least(p_partkey % 2 * 4, 1) AS high, least(p_partkey % 5, 1) AS dot FROM part""")
def geometry_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beams, low and high marks and dots of a note from its components, each up to its limit."""
    k = F.col("p_partkey")
    counted = R.geometry((k % 3) * 2, k % 4, (k % 2) * 4, k % 5)
    return table(spark, sf_dir, "part").select("p_partkey", counted.alias("g")).select("p_partkey", "g.*")


@query("""SELECT p_partkey, ['C', 'G', 'D', 'A', 'E', 'B', 'F#', 'Db', 'Ab', 'Eb', 'Bb', 'F'][1 + (p_partkey % 12) * 7 % 12] AS major, CAST((p_partkey % 12) * 7 % 12 - CASE WHEN (p_partkey % 12) * 7 % 12 > 6 THEN 12 ELSE 0 END AS INT) AS fifths FROM part""")
def key_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The major key on each tonic and its place on the circle of fifths."""
    return table(spark, sf_dir, "part").select("p_partkey", R.major_key((F.col("p_partkey") % 12).cast("int")).alias("k")).select("p_partkey", "k.major", "k.fifths")
