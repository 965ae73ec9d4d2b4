"""The thin queries over the test tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from neumata.llm import (
    classifier,
    filter_audit,
    licences,
    mixing,
    packing,
    quality_rules,
    ranked_search,
    secrets,
    sharding,
    simhash,
    substrings,
    token_files,
    vectors,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix(spark, _table(spark, sf_dir, "documents"))
    return plan.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), "n_rows"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op3_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.packed(packing.tokenised(docs, columns=("ids_crc32",)), docs.count())


def op4_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.scored(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licensed(_table(spark, sf_dir, "documents")).withColumn("licences", F.array_join("licences", ","))


def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(spark, _table(spark, sf_dir, "embeddings"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.counts(_table(spark, sf_dir, "documents"))


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicated(spark, _table(spark, sf_dir, "documents"))


def op9_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(spark, _table(spark, sf_dir, "documents"), shards=8).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_duplicates(spark, _table(spark, sf_dir, "documents"))
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(spark, _table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audited(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


OP1_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
           md5('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), ranked AS (
    SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_rank FROM sources
), weighed AS (
    SELECT *, [5, 2, 1][1 + source_rank % 3] AS weight, 3 * source_size AS cap FROM ranked
), levels AS (
    SELECT *, (CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (
                   ORDER BY cap / weight, source_rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
               / sum(weight) OVER (ORDER BY cap / weight, source_rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighed
), targets AS (
    SELECT source, source_rank, source_size,
           least(max(CASE WHEN level <= cap / weight THEN level END) OVER () * weight, CAST(cap AS DOUBLE)) AS target
    FROM levels
), queued AS (
    SELECT s.*, t.source_rank, t.source_size, t.target,
           sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS emitted
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
    WHERE size > 0
), turns AS (
    SELECT doc_id, source_rank, size, key, epoch, CAST(epoch * source_size + emitted AS BIGINT) / target AS finish
    FROM queued, (SELECT unnest([0, 1, 2]) AS epoch)
    WHERE epoch * source_size + emitted - size < target
), taken AS (
    SELECT doc_id, sum(size) OVER (ORDER BY finish, source_rank, epoch, key, doc_id, size ROWS UNBOUNDED PRECEDING) AS running
    FROM turns
), copies AS (
    SELECT doc_id, count(*) AS copies FROM taken
    WHERE running <= (SELECT sum(source_size) FROM sources) GROUP BY doc_id
)
SELECT s.doc_id, CAST(s.size AS BIGINT) AS size, t.source_size, t.target,
       CAST(s.size * coalesce(c.copies, 0) AS BIGINT) AS taken
FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source LEFT JOIN copies c ON s.doc_id = c.doc_id
"""

OP2_SQL = r"""
WITH split AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), grams AS (
    SELECT doc_id, i, array_to_string(words[i:i+4], ' ') AS gram
    FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 4)) AS i FROM split WHERE len(words) >= 5)
), twice AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams) WHERE n > 1
), repeated AS (
    SELECT doc_id, sum(least(coalesce(after - i, 5), 5)) AS n_repeat_words
    FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM twice) GROUP BY doc_id
), measures AS (
    SELECT s.doc_id, CAST(len(words) AS BIGINT) AS n_words,
           CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
           CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
           len(regexp_extract_all(text, '[!?]')) AS n_marks, len(lines) AS n_lines
    FROM split s LEFT JOIN repeated r ON s.doc_id = r.doc_id
), judged AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measures
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * n_symbols > n_words
            OR 2 * n_marks > n_words OR 2 * n_dup_lines > n_lines) AS kept
FROM judged
"""


OP6_SQL = """
WITH RECURSIVE good AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reach AS (
    SELECT vec_id AS node, vec_id AS seen FROM embeddings
    UNION
    SELECT r.node, l.b FROM reach r JOIN links l ON r.seen = l.a
), named AS (
    SELECT node, min(seen) AS component_id FROM reach GROUP BY node
)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, n.component_id, e.vec_id = n.component_id AS kept
FROM embeddings e JOIN named n ON e.vec_id = n.node
"""


OP8_SQL = r"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(words[i:i+19], ' ') AS w
    FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 19)) AS i FROM split WHERE len(words) >= 20)
), later AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS k FROM windows) WHERE k > 1
), gone AS (
    SELECT DISTINCT doc_id, pos FROM (SELECT doc_id, unnest(generate_series(i, i + 19)) AS pos FROM later)
), placed AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM split
), left_over AS (
    SELECT p.doc_id, count(*) FILTER (g.pos IS NULL) AS n_kept, string_agg(CASE WHEN g.pos IS NULL THEN word END, ' ' ORDER BY p.pos) AS kept
    FROM placed p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.pos = g.pos GROUP BY p.doc_id
)
SELECT s.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM split s LEFT JOIN left_over l ON s.doc_id = l.doc_id
"""


OP13_SQL = r"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), asked AS (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), of_item AS (SELECT item_id, term, count(*) AS q FROM asked GROUP BY ALL
), corpus AS (SELECT count(*) FILTER (len(terms) > 0) AS n_all, CAST(sum(len(terms)) AS BIGINT) AS l_all FROM split
), sized AS (SELECT doc_id, terms, 100 - 75 + (75 * CAST(len(terms) AS BIGINT) * n_all) // l_all AS m FROM split, corpus
), postings AS (SELECT doc_id, m, term, count(*) AS tf FROM (SELECT doc_id, m, unnest(terms) AS term FROM sized) GROUP BY ALL
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * CAST(n_all AS DOUBLE) + 2) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), corpus
), scores AS (
    SELECT item_id, doc_id, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM of_item JOIN weights USING (term) JOIN postings USING (term) GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""


def queries() -> dict[str, Query]:
    every = (
        op1_mix_sources,
        op2_quality_rules,
        op3_pack_sequences,
        op4_quality_scores,
        op5_licences,
        op6_near_vectors,
        op7_secrets,
        op8_substrings,
        op9_shard,
        op10_simhash,
        op11_token_files,
        op12_filter_audit,
        op13_ranked_search,
    )
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_mix_sources": OP1_SQL,
        "op2_quality_rules": OP2_SQL,
        "op5_licences": licences.sql(),
        "op6_near_vectors": OP6_SQL,
        "op8_substrings": OP8_SQL,
        "op12_filter_audit": filter_audit.SQL,
        "op13_ranked_search": OP13_SQL,
    }
