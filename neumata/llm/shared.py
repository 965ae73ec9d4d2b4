"""What several operators need: shared scratch tables, word patterns and a let-expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from neumata.shared import clean, new_folder

#: A word: a maximal run of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"


__all__ = ["BLANKS", "WORD", "Scratch", "clean", "is_small", "let", "word_count", "words_of"]


class Scratch:
    """Tables written to the shared folder; they cut the lineage and survive lost executors.

    Results are lazy and may read these tables, so they stay until ``clean``; what no
    result reads is dropped at once by the operator that wrote it. ``clean`` deletes all
    folders when results have been written; DataFrames returned before are void.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.top = new_folder(spark, name)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.top}/{name}")
        return self.read(name, df)

    def read(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(f"{self.top}/{name}")

    def drop(self, name: str = "") -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.top}/{name}".rstrip("/"))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def words_of(text: Column) -> Column:
    """The words of a text, in order; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is evaluated once per row however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def is_small(df: DataFrame, rows: int) -> bool:
    """Whether a table has at most so many rows; the proof that a broadcast asks for."""
    return df.limit(rows + 1).count() <= rows
