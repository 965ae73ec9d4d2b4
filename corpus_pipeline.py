"""The corpus pipeline: every stage reads what the one before it wrote.

Quality rules, SimHash near-duplicates, secrets, source mixing, sequence packing.
All but the last stage return the columns of documents. SQL cannot express the
fingerprints, the entropy windows and the packing, so there is no ORACLE_SQL; the
tests compare the rows with a plain Python version.

For all stages: null texts are empty ones, texts of any length are read whole, ties and
repeated rows are dealt with as the operator says, columns of any names pass, and an
empty table gives an empty one. What a stage drops is what its rule names and nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from neumata.llm import mixing, packing, quality_rules, secrets, simhash
from neumata.llm.shared import Scratch

ORACLE_SQL = None


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects; null, empty and very short texts go. Repeated rows stay or go together."""
    return quality_rules.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: the first by doc_id, null ids last; texts without words are one group."""
    return simhash.keep_one(spark, docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in them replaced by a mark; a null text stays null."""
    return secrets.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, as often as it takes them; those without words are not taken, a null source is a source."""
    return mixing.mixed_documents(spark, docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids, sequence and offset; a null text is one end id, repeated rows are packed apart."""
    return packing.packed(packing.tokenised(docs), docs.count())


STAGES = [
    ("quality rules", filter_quality),
    ("simhash near-dedup", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("source mixing", mix_sources),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = scratch.keep(stage(spark, docs, sf_dir), str(number))
    return STAGES[-1][1](spark, docs, sf_dir)
