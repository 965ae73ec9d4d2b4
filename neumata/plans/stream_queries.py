"""Queries over files and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from neumata.plans.base import query, table
from neumata.shared import shared_folder
from neumata.sources import corpus_files
from neumata.streaming import ledger


@query("""SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS start_us, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def window_events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/events.parque[t]"  # a pattern: the stream reader takes no single file by its name
    stream = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(path)
    folder = f"{shared_folder(spark)}/events-{uuid.uuid4().hex}"
    ledger.run_available(ledger.windowed_counts(stream), folder, "update")
    out = ledger.latest(ledger.written(spark, folder), ["start", "event_type"], ["n", "total"])
    return out.select(F.unix_micros("start").alias("start_us"), "event_type", "n", F.round("total", 4).alias("total"))


@query(r"""WITH got AS (SELECT page_id, regexp_extract_all(html, '(?is)<a[^>]*href="([^"]*)"[^>]*>(.*?)</a>', 1) AS h FROM pages)
SELECT page_id, CAST(unnest(range(len(h))) AS INT) AS position, unnest(h) AS href FROM got""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_files.page_links(table(spark, sf_dir, "pages")).select("page_id", "position", "href")
