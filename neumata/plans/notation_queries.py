"""Queries over notation that is read and written: repeats, ABC, durations, and versions of a title."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from neumata.functions import alignment, cleaning, durations
from neumata.operators import repeats, versions
from neumata.plans.base import SONGS_SQL, query, songs, spread, table
from neumata.sources import abc


@query("""WITH p AS (SELECT p_partkey, p_partkey % 4 AS k, p_name, p_brand, p_type FROM part)
SELECT p_partkey, CASE k WHEN 0 THEN p_name || chr(10) || p_name || ' ' || p_brand WHEN 1 THEN array_to_string([p_name, p_name, p_name], chr(10)) || ' ' || p_brand
    WHEN 2 THEN p_name || ' ' || p_brand || chr(10) || p_name || ' ' || p_type ELSE 'R3{ ' || p_name || ' } A{' || p_brand || '|' || p_type || '}' END AS score FROM p""")
def repeat_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of parts under repeat macros, written out; a macro whose number is not that of its endings stays."""
    k, name = F.col("p_partkey") % 4, F.concat(F.lit("{ "), "p_name", F.lit(" }"))
    endings = F.concat(F.lit(" A{"), "p_brand", F.lit("|"), "p_type", F.lit("}"))
    beside = F.concat(F.lit(" "), "p_brand")
    score = F.when(k == 0, F.concat(F.lit("R"), name, beside)).when(k == 1, F.concat(F.lit("R3"), name, beside)).when(k == 2, F.concat(F.lit("R2"), name, endings)).otherwise(F.concat(F.lit("R3"), name, endings))
    return table(spark, sf_dir, "part").select("p_partkey", repeats.macro_expanded(score).alias("score"))


@query()
def repeats_unrolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each line of an order is played, where lines are signs, every other a repeat sign or an ending; literal scores are tested.
    What follows what depends on a stack, which SQL does not have."""
    kinds = F.array(*map(F.lit, ("|:", "a", ":|", "b", "[1", "c", "[2", "d", "||", "e")))
    signs = table(spark, sf_dir, "lineitem").select("l_orderkey", F.struct("l_linenumber", F.get(kinds, (F.col("l_suppkey") % 10).cast("int")).alias("sign")).alias("s"))
    scores = signs.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("s")).alias("s"))  # seven lines at most
    rows = scores.withColumn("signs", F.transform("s", lambda x: x["sign"])).lateralJoin(repeats.PlayOrder(F.col("signs").outer()))
    heard = rows.where("nth IS NOT NULL").select("l_orderkey", F.get("s", F.col("at"))["l_linenumber"].alias("l_linenumber"), "nth")
    return heard.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("times"), F.min("nth").alias("first_nth"))


@query("""WITH tunes AS (SELECT doc_id, [0, 1, 2, -1][1 + doc_id % 4] AS fifths, string_split(regexp_replace(coalesce(text, ''), '[^A-Ga-g]', '', 'g'), '') AS letters FROM documents
), notes AS (SELECT doc_id, fifths, unnest(letters) AS c FROM tunes
), steps AS (SELECT doc_id, (CASE WHEN c BETWEEN 'a' AND 'g' THEN 7 ELSE 0 END) + strpos('CDEFGAB', upper(c)) - 1 - (4 * fifths + 28) % 7 AS step FROM notes WHERE c <> '')
SELECT doc_id, CAST((step + 70) % 7 + 1 AS INT) AS degree, CAST((step + 70) // 7 - 10 AS INT) AS octave, count(*) AS n FROM steps GROUP BY ALL""")
def abc_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Letters of documents as the notes of an ABC tune in one of four keys: degrees over the key's tonic, by octave."""
    key = F.get(F.array(*map(F.lit, ("C", "Em", "D", "G dorian"))), (F.col("doc_id") % 4).cast("int"))
    body = F.regexp_replace(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Ga-g]", ""), "(.{64})", "$1 |\n")
    tune = F.concat(F.lit("X:1\nM:4/4\nK:"), key, F.lit("\n"), body)
    tunes = spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", tune.alias("tune"))
    return abc.counted_notes(tunes).groupBy("doc_id", "degree", "octave").agg(F.sum("n").alias("n"))


HEADS_SQL = ", ".join(f"('{name}{dot}', {float(value * (Fraction(3, 2) if dot else 1))}, {2 * k + bool(dot)})" for k, (name, value) in enumerate(durations.LETTERS) for dot in ("", "."))
SIGNS_SQL = ", ".join(f"('{name}-', {float(value)}, {k})" for k, (name, value) in enumerate(durations.LETTERS))


@query(f"""WITH heads(h, v, r) AS (VALUES {HEADS_SQL}), signs(s, v, r) AS (VALUES {SIGNS_SQL}), every AS (
    SELECT [h] AS parts, v AS beats, [0, r] AS rank FROM heads UNION ALL SELECT [h, s], a.v + b.v, [1, a.r, b.r] FROM heads a, signs b
    UNION ALL SELECT [h, b.s, c.s], a.v + b.v + c.v, [2, a.r, b.r, c.r] FROM heads a, signs b, signs c
    UNION ALL SELECT [h, b.s, c.s, d.s], a.v + b.v + c.v + d.v, [3, a.r, b.r, c.r, d.r] FROM heads a, signs b, signs c, signs d
), known AS (SELECT beats::DOUBLE AS beats, arg_min(parts, rank) AS parts FROM every GROUP BY 1
), d AS (SELECT l_orderkey, l_linenumber, (CAST(l_quantity AS INT) * 13 % 512 + 1) / 32.0::DOUBLE AS beats FROM lineitem)
SELECT l_orderkey, l_linenumber, array_to_string(coalesce(a.parts, CASE WHEN d.beats >= 1 AND b.parts IS NOT NULL THEN list_concat(b.parts, list_transform(range(CAST(floor(d.beats) AS BIGINT) - 1), lambda i: '-')) END, ['']), ' ') AS parts,
    a.parts IS NOT NULL OR (d.beats >= 1 AND b.parts IS NOT NULL) AS exact
FROM d LEFT JOIN known a ON a.beats = d.beats LEFT JOIN known b ON b.beats = 1 + d.beats - floor(d.beats)""")
def duration_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Durations of up to 16 beats by 32nds as heads and signs that hold them on."""
    beats = (F.col("l_quantity").cast("int") * 13 % 512 + 1) / 32.0
    rows = durations.spelled(spark, table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", beats.alias("beats")), F.col("beats"))
    return rows.select("l_orderkey", "l_linenumber", F.array_join("parts", " ").alias("parts"), "exact")


COUNTS_SQL = ", ".join(f"length(digits) - length(replace(digits, '{d}', ''))" for d in range(1, 8))
UNREAD_SQL = "SELECT doc_id AS song_id, coalesce(length(regexp_replace(text, '[^0-9]', '', 'g')) / nullif(length(text), 0), 0) AS unread FROM documents"


@query(f"""WITH {SONGS_SQL}, read AS ({UNREAD_SQL}), s AS (SELECT song_id, title, length(digits) AS n, [{COUNTS_SQL}] AS bag, unread FROM songs JOIN read USING (song_id)
), agree AS (SELECT a.title, a.song_id, CASE WHEN a.n = 0 OR b.n = 0 THEN 0 ELSE greatest(0, 1 - list_sum(list_transform(list_zip(a.bag, b.bag), lambda z: abs(z[1] - z[2]))) / greatest(a.n, b.n)) END AS g
    FROM s a JOIN s b ON a.title = b.title AND a.song_id <> b.song_id
), cons AS (SELECT song_id, avg(g) AS cons FROM agree GROUP BY 1
), med AS (SELECT title, greatest(list(n ORDER BY n)[count(*) // 2 + 1], 1) AS med FROM s GROUP BY title
), scored AS (SELECT title, song_id, round(0.5 * coalesce(cons, 1) + 0.3 * greatest(0, 1 - unread / 0.1) + 0.2 * greatest(0, 1 - abs(n - med) / med), 6) AS score FROM s JOIN med USING (title) LEFT JOIN cons USING (song_id))
SELECT title, song_id, score FROM scored""")
def version_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each version of a title by how far it agrees with the others, how much of it is readable (no figures) and its length."""
    text = F.coalesce("text", F.lit(""))
    unread = F.when(F.length(text) > 0, F.length(F.regexp_replace(text, "[^0-9]", "")) / F.length(text)).otherwise(0.0)
    read = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("song_id"), unread.alias("unread"))
    every = songs(spark, sf_dir).select("title", "song_id", "digits").join(read, "song_id")
    return versions.scored(spark, every).select("title", "song_id", F.round("score", 6).alias("score"))


@query("""WITH old AS (SELECT c_nationkey AS digest, c_name AS name, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_name) AS k FROM customer),
new AS (SELECT CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE s_nationkey END AS digest, s_name AS name, row_number() OVER (PARTITION BY CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE s_nationkey END ORDER BY s_name) AS k FROM supplier)
SELECT new.name AS new_name, old.name AS old_name FROM new JOIN old USING (digest, k)""")
def name_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New names that keep the old name of their content; a third of all new names have one content."""
    old = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("digest"), F.col("c_name").alias("name"))
    new = table(spark, sf_dir, "supplier").select(F.when(F.col("s_suppkey") % 3 == 0, 0).otherwise(F.col("s_nationkey")).alias("digest"), F.col("s_name").alias("name"))
    return versions.claims(spark, old, new)


LETTERS_SQL = "lower(regexp_replace({}, '[^A-Za-z]', '', 'g'))"


@query(f"""WITH n AS (SELECT p_partkey, {LETTERS_SQL.format("p_name")} AS a, {LETTERS_SQL.format("p_name || p_type")} AS b, {LETTERS_SQL.format("reverse(p_name)")} AS c FROM part)
SELECT p_partkey, CAST(levenshtein(a, b) AS BIGINT) AS longer_edits, CAST(length(b) - length(a) AS BIGINT) AS longer_extra, CAST(levenshtein(a, c) AS BIGINT) AS turned_edits FROM n""")
def transcription_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names as notes (each letter a degree in one of four octaves) against a longer reading and one from behind; kinds of errors
    are tested against the whole table of the dynamic programme."""
    notes = lambda c: F.transform(F.filter(F.split(F.lower(F.regexp_replace(c, "[^A-Za-z]", "")), ""), lambda x: x != ""), lambda x: (F.ascii(x) - 97) % 7 + 1 + 8 * F.floor((F.ascii(x) - 97) / 7))
    name = F.col("p_name")
    rows = table(spark, sf_dir, "part").select("p_partkey", notes(name).alias("true"), notes(F.concat(name, "p_type")).alias("longer"), notes(F.reverse(name)).alias("turned"))
    both = rows.select("p_partkey", alignment.transcription_errors("true", "longer").alias("l"), alignment.transcription_errors("true", "turned").alias("t"))
    return both.select("p_partkey", F.col("l.edits").alias("longer_edits"), (F.col("l.extra") - F.col("l.missing")).alias("longer_extra"), F.col("t.edits").alias("turned_edits"))


SPELLED_SQL = r"""list_transform(list_transform(found[1:64], lambda t: {'a': regexp_extract(t, '^([#b]?)', 1), 'd': lower(regexp_extract(t, '^[#b]?([qsdhQ]?)', 1)),
    'b': regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '^[#b]?[qsdhQ]?', ''), '^[iI]', '1'''), '^(['',]*)8(.*)$', '\11''\2'), '^(['',]*)9(.*)$', '\12''\2'), '^([1-7])(,+)([.-]*)''*$', '\2\1\3')}),
    lambda x: x.a || x.d || regexp_replace(x.b, '^(''+)([1-7])([.-]*)''*$', '\2\1\3'))"""


@query(rf"""WITH lines AS (SELECT doc_id, i, trim(lines[i]) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents), LATERAL (SELECT unnest(range(1, len(lines) + 1)) AS i)
), found AS (SELECT doc_id, i, regexp_extract_all(line, '[#b'',]*[qsdhQ]?[0-9iI][.,''-]*|[-|]') AS found FROM lines WHERE line <> '' AND NOT regexp_matches(line, '^(?:subtitle=|NextScore|KeepLength|R\d*\s*\{{|A\s*\{{|%|#|\\bar)')
), spelled AS (SELECT doc_id, i, {SPELLED_SQL} AS t FROM found WHERE len(list_filter(found, lambda t: t NOT IN ('|', '-'))) > 0
), parted AS (SELECT doc_id, i, array_to_string(list_transform(t, lambda x: CASE WHEN regexp_matches(x, '^[qsdh]?[#b'',]*[0-7iI][.,'']*-+.*$') THEN trim(regexp_extract(x, '^([qsdh]?[#b'',]*[0-7iI][.,'']*)', 1)
    || repeat(' -', length(regexp_extract(x, '^[qsdh]?[#b'',]*[0-7iI][.,'']*(-+)', 1))) || ' ' || regexp_extract(x, '^[qsdh]?[#b'',]*[0-7iI][.,'']*-+(.*)$', 1)) ELSE x END), ' ') AS line FROM spelled)
SELECT doc_id, count(*) AS n_lines, md5(string_agg(line, chr(10) ORDER BY i)) AS body FROM parted GROUP BY doc_id""")
def cleaned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a recogniser's prose: the note lines in them (an i in a word is read as a high 1)."""
    text = F.regexp_replace(F.coalesce("text", F.lit("")), rf"(?m){cleaning.STRUCTURE_LINE}.*$", "")  # lines of structure have tests of their own
    rows = spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", cleaning.cleaned(text).alias("lines")).where(F.size("lines") > 0)
    return rows.select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.md5(F.array_join("lines", "\n").cast("binary")).alias("body"))
