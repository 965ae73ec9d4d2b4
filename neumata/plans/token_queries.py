"""Queries over tokens and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from neumata.functions import melody, tokens as T
from neumata.operators import corpus, notation
from neumata.plans.base import DIGITS_SQL, SONGS_SQL, TOKENS_SQL, query, scores, songs, table, tokens


@query(f"WITH {SONGS_SQL} SELECT song_id, digits, length(digits) AS n_notes FROM songs")
def digits_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return songs(spark, sf_dir).select("song_id", "digits", F.length("digits").cast("long").alias("n_notes"))


@query(f"WITH {TOKENS_SQL} SELECT song_id, idx, token, digit, acc, oct FROM tokens")
def token_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    note = F.get(T.parse_notes(F.col("token")), F.lit(0))
    return tokens(spark, sf_dir).withColumn("note", note).select("song_id", "idx", "token", "note.digit", "note.acc", "note.oct")


@query(f"WITH {TOKENS_SQL} SELECT song_id, idx, dur, beats FROM tokens")
def token_beats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens(spark, sf_dir).select("song_id", "idx", T.duration_letter(F.col("token")).alias("dur"), T.beat(F.col("token")).alias("beats"))


@query(f"WITH {TOKENS_SQL} SELECT song_id, sum(beats) AS beats, count(*) AS n_tokens, count(digit) AS n_notes FROM tokens GROUP BY song_id")
def beat_totals_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tokens(spark, sf_dir).select("song_id", T.beat(F.col("token")).alias("beats"), F.get(T.parse_notes(F.col("token")), F.lit(0))["digit"].alias("d"))
    return rows.groupBy("song_id").agg(F.sum("beats").alias("beats"), F.count("*").alias("n_tokens"), F.count("d").alias("n_notes"))


@query(f"""WITH {TOKENS_SQL} SELECT song_id, idx, coalesce(last_value(nullif(dur, '') IGNORE NULLS) OVER (
    PARTITION BY song_id ORDER BY idx, token ROWS UNBOUNDED PRECEDING), '') AS dur FROM tokens""")
def keep_length_ffill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tokens(spark, sf_dir).withColumn("own", T.duration_letter(F.col("token")))
    return notation.fill_forward(rows, "own", ["song_id"], ["idx", "token"]).select("song_id", "idx", F.coalesce("own", F.lit("")).alias("dur"))


@query(f"""WITH {TOKENS_SQL}, before AS (
    SELECT *, lag(tied) OVER w AS was_tied, lag(digit) OVER w AS was_digit, lag(acc) OVER w AS was_acc
    FROM tokens WINDOW w AS (PARTITION BY song_id ORDER BY idx, token || CASE WHEN tied THEN ' ~' ELSE '' END)
), kept AS (
    SELECT *, digit IS NOT NULL AND NOT coalesce(was_tied AND was_digit = digit AND was_acc = acc, false) AS kept FROM before
)
SELECT song_id, coalesce(string_agg(CASE WHEN kept THEN digit END, '' ORDER BY idx, token || CASE WHEN tied THEN ' ~' ELSE '' END), '') AS digits, count(CASE WHEN kept THEN 1 END) AS n_notes
FROM kept GROUP BY song_id""")
def tie_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    notes = scores(spark, sf_dir).select("song_id", T.merged_notes(F.col("score")).alias("notes"))
    digits = F.array_join(F.transform("notes", lambda n: n["digit"].cast("string")), "")
    return notes.select("song_id", digits.alias("digits"), F.size("notes").cast("long").alias("n_notes"))


@query(f"""WITH {SONGS_SQL} SELECT song_id, array_to_string(list_transform(range(1, length(digits)),
    lambda i: (CAST(digits[i + 1] AS INT) - CAST(digits[i] AS INT) + 7) % 7), '') AS contour FROM songs""")
def contour_mod7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return songs(spark, sf_dir).select("song_id", melody.contour(F.col("digits")).alias("contour"))


@query(f"""WITH {SONGS_SQL}, pitched AS (SELECT song_id, list_transform(range(1, length(digits) + 1),
    lambda i: [0, 2, 4, 5, 7, 9, 11][CAST(digits[i] AS INT)]) AS x FROM songs)
SELECT song_id, array_to_string(list_transform(range(1, len(x)), lambda i: chr(97 + (x[i + 1] - x[i] + 17) % 12)), '') AS steps FROM pitched""")
def interval_semitone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return songs(spark, sf_dir).select("song_id", melody.intervals(F.col("digits")).alias("steps"))


@query(f"""WITH {TOKENS_SQL} SELECT song_id, CASE WHEN sum(abs(oct)) <= least(sum(abs(oct + 1)), sum(abs(oct - 1))) THEN 0
    WHEN sum(abs(oct + 1)) <= sum(abs(oct - 1)) THEN 1 ELSE -1 END AS shift,
    CAST(least(sum(abs(oct)), sum(abs(oct + 1)), sum(abs(oct - 1))) AS BIGINT) AS marks FROM tokens WHERE digit IS NOT NULL GROUP BY song_id""")
def octave_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    note = F.get(T.parse_notes(F.col("token")), F.lit(0))
    return notation.octave_shift(tokens(spark, sf_dir).select("song_id", note.alias("n")).select("song_id", "n.*").where("digit IS NOT NULL"))


@query(f"WITH {TOKENS_SQL} SELECT dur, oct, dot = '.' AS dotted, count(*) AS n FROM tokens GROUP BY ALL")
def token_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("token")
    rows = tokens(spark, sf_dir).select(T.duration_letter(t).alias("dur"), F.get(T.parse_notes(t), F.lit(0))["oct"].alias("oct"), t.endswith(".").alias("dotted"))
    return rows.groupBy("dur", "oct", "dotted").agg(F.count("*").alias("n"))


@query("""WITH sizes AS (SELECT DISTINCT p_size AS fit_in, list_min(list_filter([2, 4, 8, 16, 32, 64, 128], lambda x: x >= p_size)) AS power FROM part)
SELECT fit_in || '[' AS mark, CASE WHEN power = fit_in THEN fit_in * 3 // 2 ELSE power // 2 END AS num, fit_in FROM sizes""")
def tuplet_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = table(spark, sf_dir, "part").select(F.concat(F.col("p_size").cast("string"), F.lit("[")).alias("mark")).distinct()
    return marks.withColumn("t", T.tuplet_ratio(F.col("mark"))).select("mark", "t.num", "t.fit_in")


@query(f"""WITH {TOKENS_SQL}, counted AS (
    SELECT song_id, count(*) AS n, count(*) FILTER (digit IS NULL) AS silent FROM tokens GROUP BY song_id)
SELECT song_id, n, silent, 10 * silent >= 7 * n AND n >= 3 AS rest_heavy FROM counted""")
def rest_heavy_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notation.rest_heavy(tokens(spark, sf_dir), least_tokens=3)


@query(f"""WITH {TOKENS_SQL}, placed AS (
    SELECT song_id, idx, token, coalesce(sum(beats) OVER (PARTITION BY song_id ORDER BY idx, token ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS onset FROM tokens)
SELECT song_id, idx, onset, CAST(floor(onset / 2.0) AS BIGINT) AS bar FROM placed""")
def bar_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tokens(spark, sf_dir).withColumn("beats", T.beat(F.col("token")))
    return notation.onsets(rows, ["song_id"], ["idx", "token"]).select("song_id", "idx", "onset", F.floor(F.col("onset") / 2.0).alias("bar"))


@query()
def rebar_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(spark, sf_dir).select("song_id", notation.bar_starts(F.col("score"), 2.0).alias("bars"))


@query("""WITH profiled AS (SELECT l_suppkey, l_partkey % 12 AS pc, l_quantity AS w FROM lineitem), bags AS (
    SELECT s.l_suppkey, p.pc, coalesce(sum(w), 0) AS w FROM (SELECT DISTINCT l_suppkey FROM profiled) s CROSS JOIN (SELECT unnest(range(12)) AS pc) p
    LEFT JOIN profiled x ON x.l_suppkey = s.l_suppkey AND x.pc = p.pc GROUP BY 1, 2
), shapes AS (SELECT unnest([false, true]) AS minor, unnest([[6.35, 2.23, 3.48, 2.33, 4.38, 4.09, 2.52, 5.19, 2.39, 3.66, 2.29, 2.88],
    [6.33, 2.68, 3.52, 5.38, 2.60, 3.53, 2.54, 4.75, 3.98, 2.69, 3.34, 3.17]]) AS shape
), rated AS (SELECT l_suppkey, tonic, minor, round(corr(w, shape[1 + (pc - tonic + 12) % 12]), 6) AS r
    FROM bags CROSS JOIN shapes CROSS JOIN (SELECT unnest(range(12)) AS tonic) GROUP BY 1, 2, 3)
SELECT l_suppkey, CAST(tonic AS INT) AS tonic, minor, r FROM rated QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY r DESC, tonic, minor) = 1""")
def ks_key_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighed = table(spark, sf_dir, "lineitem").select("l_suppkey", (F.col("l_partkey") % 12).cast("int").alias("pc"), F.col("l_quantity").alias("w"))
    return notation.infer_key(weighed, "l_suppkey")


@query("""WITH spans AS (SELECT user_id, event_id, epoch_us(ts) AS a, epoch_us(ts) + CAST(floor(value * 1000000) AS BIGINT) * 60 AS b FROM events WHERE value IS NOT NULL), seen AS (
    SELECT *, max(b) OVER (PARTITION BY user_id ORDER BY a, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > a AS meets FROM spans)
SELECT user_id, count(*) AS n, round(avg(CASE WHEN meets THEN 0.0 ELSE 1.0 END), 6) AS mono FROM seen GROUP BY user_id""")
def mono_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.unix_micros(F.col("ts").cast("timestamp"))
    spans = table(spark, sf_dir, "events").where("value IS NOT NULL").select("user_id", "event_id", start.alias("a"), (start + F.floor(F.col("value") * 1000000).cast("long") * 60).alias("b"))
    return corpus.monophony(spans, "user_id", "event_id")
