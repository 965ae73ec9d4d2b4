"""Queries over names, titles and artists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from neumata.functions import naming as N, titles
from neumata.operators import matching
from neumata.plans.base import NAMES_SQL, names, query, table

BARE = f"lower(regexp_replace({{}}, '[^0-9A-Za-z{N.HAN}]', '', 'g'))"


def doubled_sql(x: str) -> str:
    """Where the second half of a doubled text starts, less one; null otherwise."""
    halves = f"{BARE.format(f'left({x}, i)')} = {BARE.format(f'substr({x}, i + 1)')} AND length({BARE.format(f'left({x}, i)')}) >= 3 AND NOT regexp_matches(substr({x}, i, 2), '\\\\s')"
    third = f"greatest(length({x}) // 3, 1)"
    return f"list_filter(range({third}, length({x}) - {third} + 1), lambda i: {halves})[1]"


@query()
def title_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names whose UTF-8 bytes were read as Latin-1, repaired; DuckDB has no such decoding."""
    broken = F.decode(F.encode("name", "UTF-8"), "ISO-8859-1")
    return names(spark, sf_dir).select("p_partkey", "name", N.repaired(broken).alias("repaired"))


@query(rf"""WITH {NAMES_SQL}, based AS (SELECT p_partkey, name, regexp_replace(regexp_replace(regexp_replace(split_part(name, '__', 1), '(?:{N.CREDITS}).*$', ''),
    '[_-]?[（(][^（()）]*[)）]', '', 'g'), '^[0-9]{{1,3}}([{N.HAN}])', '\1') AS b FROM names
), halved AS (SELECT *, {doubled_sql("b")} AS half FROM based
), once AS (SELECT *, CASE WHEN half IS NULL THEN b WHEN length(left(b, half)) - length(replace(left(b, half), '_', '')) <= length(substr(b, half + 1)) - length(replace(substr(b, half + 1), '_', ''))
    THEN left(b, half) ELSE substr(b, half + 1) END AS t FROM halved)
SELECT p_partkey, regexp_replace(t, '^[_ -]+|[_ -]+$', '', 'g') AS title FROM once""")
def title_of_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names(spark, sf_dir).select("p_partkey", N.title_of(F.col("name")).alias("title"))


@query(rf"""WITH {NAMES_SQL}, cut AS (SELECT p_partkey, name, regexp_replace(trim(name), '(?s)(?:{N.MARKERS}).*$', '') AS t FROM names),
a AS (SELECT *, CASE WHEN strpos(t, '_') > 1 AND strpos(t, '_') < length(t) THEN left(t, strpos(t, '_') - 1) ELSE t END AS u FROM cut),
b AS (SELECT *, CASE WHEN strpos(u, '-') > 1 AND strpos(u, '-') < length(u) THEN left(u, strpos(u, '-') - 1) ELSE u END AS v FROM a),
parts AS (SELECT *, regexp_extract(name, '([一-龥A-Za-z0-9·]{{1,8}})演唱', 1) AS sung, list_filter(string_split(name, '_'), lambda x: x <> '') AS p FROM b)
SELECT p_partkey, regexp_replace(trim(v), '^[。！!· ]+|[。！!· ]+$', '', 'g') AS title, CASE WHEN sung <> '' THEN sung WHEN len(p) >= 2 AND regexp_matches(p[1], '简谱|歌词|曲谱|歌谱')
    AND trim(p[2]) <> '' AND NOT regexp_matches(trim(p[2]), '{N.NO_ARTIST}') AND length(trim(p[2])) <= 8 AND NOT regexp_matches(trim(p[2]), '[0-9]') THEN trim(p[2]) ELSE '' END AS artist FROM parts""")
def title_and_artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names(spark, sf_dir).select("p_partkey", N.clean_title(F.col("name")).alias("title"), N.guessed_artist(F.col("name")).alias("artist"))


@query(rf"""WITH {NAMES_SQL}, bare AS (SELECT p_partkey, lower(regexp_replace(name, '{N.LOOSE_SIGNS.replace("'", "''")}', '', 'g')) AS b FROM names),
cut AS (SELECT p_partkey, regexp_replace(b, '^(.+?)(?:{N.TYPE_SUFFIXES})+$', '\1') AS c FROM bare)
SELECT p_partkey, coalesce(nullif(regexp_replace(c, '^[0-9]{{1,3}}([{N.HAN}])', '\1'), ''), c) AS title FROM cut""")
def title_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names(spark, sf_dir).select("p_partkey", N.canonical(F.col("name")).alias("title"))


@query(rf"""WITH {NAMES_SQL}, a AS (SELECT p_partkey, regexp_replace(regexp_replace(name, '__[a-z0-9]+-\d+$', ''), '[（(【\[]([^)）】\]]*{N.CREDIT_NOTE}[^)）】\]]*)[)）】\]]', chr(1) || '\1' || chr(2), 'g') AS t FROM names),
b AS (SELECT p_partkey, replace(replace(regexp_replace(regexp_replace(t, '[（(【\[][^)）】\]]*[)）】\]]', '', 'g'), '[（(【\[].*$', ''), chr(1), '('), chr(2), ')') AS t FROM a),
c AS (SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(t, '{N.VERSION_WORDS}', '', 'g'), '[\s　]*\S*类[\s　]+\S*$', ''), '[\s　]*\S*类$', '') AS t FROM b)
SELECT p_partkey, trim(lower(regexp_replace(t, '{N.VERSION_SIGNS.replace("'", "''")}', '', 'g'))) AS song FROM c""")
def title_version_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names(spark, sf_dir).select("p_partkey", N.version_key(F.col("name")).alias("song"))


def _family_sql(x: str, rounds: int = 3) -> str:
    for _ in range(rounds):
        x = rf"list_transform([{x}], lambda g: coalesce(nullif(regexp_replace(regexp_replace(g, '{N.FAMILY_SUFFIX}', ''), '([{N.HAN}])[0-9]$', '\1'), ''), g))[1]"
    return x


@query(rf"""WITH {NAMES_SQL}, groups AS (SELECT p_partkey, regexp_extract(split_part(name, '__', 1), '^([^\s（(【\[《]*)', 1) AS cut, split_part(name, '__', 1) AS base FROM names)
SELECT p_partkey, {_family_sql("CASE WHEN cut <> '' THEN cut ELSE base END")} AS family FROM groups""")
def title_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names(spark, sf_dir).select("p_partkey", N.family_key(titles.title_group(F.col("name"))).alias("family"))


@query(r"""WITH files AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'a/b/想你0.01秒__sitea-' || page_id WHEN 1 THEN 'x__siteb-' || page_id || '.txt' WHEN 2 THEN 'plain ' || page_id ELSE ' y__sitec-0' || page_id END AS f FROM pages),
got AS (SELECT page_id, trim(split_part(f, '/', -1)) AS base FROM files), keyed AS (SELECT *, regexp_extract(base, '__([a-z0-9]+-[0-9a-z_]+)$', 1) AS whole,
    regexp_extract(regexp_replace(base, '(.)\.[^.]*$', '\1'), '__([a-z0-9]+-[0-9a-z_]+)$', 1) AS stem FROM got)
SELECT page_id, coalesce(nullif(whole, ''), nullif(stem, ''), base) AS key FROM keyed""")
def name_folder_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("page_id").cast("string")
    file = (
        F.when(F.col("page_id") % 4 == 0, F.concat(F.lit("a/b/想你0.01秒__sitea-"), i)).when(F.col("page_id") % 4 == 1, F.concat(F.lit("x__siteb-"), i, F.lit(".txt")))
        .when(F.col("page_id") % 4 == 2, F.concat(F.lit("plain "), i)).otherwise(F.concat(F.lit(" y__sitec-0"), i))
    )
    return table(spark, sf_dir, "pages").select("page_id", N.folder_key(file).alias("key"))


@query(rf"""WITH {NAMES_SQL} SELECT p_partkey, array_to_string(list_filter([CASE WHEN contains(name, '_') AND regexp_matches(name, '[{N.HAN}]') THEN 'underscore' END,
    CASE WHEN regexp_matches(name, '{N.META}') OR regexp_matches(name, '{N.CREDITED}') THEN 'credits' END, CASE WHEN regexp_matches(name, '{N.ODD_INSTRUMENTS}') THEN 'instrument' END,
    CASE WHEN regexp_matches(name, '{N.KEY_OR_SPEED}') THEN 'key or speed' END, CASE WHEN {doubled_sql("name")} IS NOT NULL THEN 'doubled' END, CASE WHEN length(name) > 24 THEN 'long' END,
    CASE WHEN starts_with(name, '{N.UNNAMED}') THEN 'placeholder' END, CASE WHEN regexp_matches(name, '{N.EDGES}') THEN 'edge signs' END, CASE WHEN regexp_matches(name, '[0-9]{{6,}}') THEN 'site number' END], lambda x: x IS NOT NULL), ',') AS odd FROM names""")
def odd_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names(spark, sf_dir).select("p_partkey", F.array_join(N.oddities(F.col("name")), ",").alias("odd"))


@query(rf"""WITH {NAMES_SQL}, t AS (SELECT n.p_partkey, name, p_name, p_size FROM names n JOIN part p USING (p_partkey))
SELECT p_partkey, regexp_matches(name, '{titles.INSTRUMENTS}') AS arrangement, p_size % 2 = 1 AND name NOT IN ('', '?') AND name <> p_name AND length(name) <= 40 AND NOT contains(name, chr(10)) AS accepted FROM t""")
def title_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = names(spark, sf_dir).join(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size"), "p_partkey")
    accepted = N.accepted_title(F.col("name"), F.col("p_name"), F.col("p_size") % 2)
    return rows.select("p_partkey", N.is_arrangement(F.col("name")).alias("arrangement"), accepted.alias("accepted"))


def _titles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Titles of a corpus (part types and words of names) and of a list that is looked up in it."""
    part = table(spark, sf_dir, "part")
    have = part.select(titles.normal_title("p_name").alias("title")).where("title <> ''").distinct()
    want = part.select("p_partkey", titles.normal_title(F.concat(F.substring_index("p_name", " ", 2), F.when(F.col("p_partkey") % 3 == 0, " x").otherwise(""))).alias("wanted"))
    return have, want.where("wanted <> ''")


TITLES_SQL = r"""have AS (SELECT DISTINCT title FROM (SELECT lower(regexp_replace(p_name, '[\s\-_.,]+', '', 'g')) AS title FROM part) WHERE title <> ''),
want AS (SELECT p_partkey, lower(regexp_replace(array_to_string(string_split(p_name, ' ')[1:2], ' ') || CASE WHEN p_partkey % 3 = 0 THEN ' x' ELSE '' END, '[\s\-_.,]+', '', 'g')) AS wanted FROM part)"""


@query(f"""WITH {TITLES_SQL} SELECT p_partkey, min(title) AS title, count(*) AS n FROM want JOIN have ON left(wanted, 2) = left(title, 2)
    AND (wanted = title OR ((contains(title, wanted) OR contains(wanted, title)) AND least(length(title), length(wanted)) >= 4 AND 2 * least(length(title), length(wanted)) >= greatest(length(title), length(wanted)))) GROUP BY 1""")
def fuzzy_title_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wanted titles that a title of the corpus equals or holds, and which begin with the same two signs."""
    have, want = _titles(spark, sf_dir)
    pairs = matching.same_titles(have, want, head=2)
    found = pairs.groupBy("wanted").agg(F.min("title").alias("title"), F.count("*").alias("n"))
    return want.join(found, "wanted").select("p_partkey", "title", "n")


@query()
def coverage_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the corpus has each of the wanted songs (every hundredth part): by title, but too short or not, by alias, by similarity of
    0.60 and more, or not at all. Similarity has no SQL; a test compares all pairs."""
    part = table(spark, sf_dir, "part")
    song = part.where("p_partkey % 7 <> 0").select(titles.normal_title("p_name").alias("title"), titles.normal_title("p_type").alias("alias"), F.col("p_size").alias("n_notes"))
    wish = F.when(F.col("p_partkey") % 300 == 0, F.col("p_type")).when(F.col("p_partkey") % 200 == 0, F.reverse(F.col("p_name"))).otherwise(F.col("p_name"))
    want = part.where("p_partkey % 100 = 0").select("p_partkey", titles.normal_title(wish).alias("wanted"))
    return matching.covered(song, want)


@query("""WITH counts AS (SELECT lower(role) AS key, role, count(*) AS n FROM conversations GROUP BY 1, 2), best AS (SELECT key, arg_min(role, (-n, role)) AS spelling FROM counts GROUP BY key),
noisy AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN 'the ' || upper(role) || ' (live)' WHEN turn % 3 = 1 THEN role ELSE 'various artists' END AS name FROM conversations)
SELECT conv_id, turn, coalesce(a.spelling, (SELECT min(spelling) FROM best WHERE contains(lower(name), key))) AS artist FROM noisy LEFT JOIN best a ON lower(name) = a.key""")
def artist_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artists in their most common spelling; of a noisy name the known one within it; null for noise."""
    rows = table(spark, sf_dir, "conversations")
    counts = rows.groupBy(F.lower("role").alias("key"), "role").agg(F.count("*").alias("n"))
    best = counts.groupBy("key").agg(F.min_by("role", F.struct(-F.col("n"), "role")).alias("spelling"))
    turn = F.col("turn") % 3
    name = F.when(turn == 0, F.concat(F.lit("the "), F.upper("role"), F.lit(" (live)"))).when(turn == 1, F.col("role")).otherwise("various artists")
    return matching.spelled(rows.select("conv_id", "turn", name.alias("name")), best).select("conv_id", "turn", "artist")
