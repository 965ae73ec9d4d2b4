"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; only a local session without it gets a folder under /tmp, a cluster is refused."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Folders made for scratch tables, by application.
_made: dict[str, list[str]] = {}


def new_folder(spark: SparkSession, name: str) -> str:
    """The path of a new folder for scratch tables, which ``clean`` will delete."""
    top = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(top)
    return top


def clean(spark: SparkSession) -> int:
    """Delete all folders of scratch tables of this session, and say how many: to be called when results have been written, as
    DataFrames returned before may read them."""
    done = _made.pop(spark.sparkContext.applicationId, [])
    for top in done:
        path = spark._jvm.org.apache.hadoop.fs.Path(top)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(done)


def folder(spark: SparkSession, name: str) -> Callable[[DataFrame, str], DataFrame]:
    """A function that writes a table into a new shared folder and reads it back: lineage ends there, and lost executors do no harm."""
    top = new_folder(spark, name)

    def keep(df: DataFrame, table: str) -> DataFrame:
        df.write.parquet(f"{top}/{table}")
        return spark.read.schema(df.schema).parquet(f"{top}/{table}")

    return keep
