"""Runs a registered query against its SQL in DuckDB, as an order-free comparison of whole rows."""

from __future__ import annotations

import math
import os
import sys

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return value


def mismatch(spark, name: str, sf_dir: str, entry=None) -> str:
    """Empty if rows and column names agree."""
    if entry is None:
        import __spark_entry__ as entry
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = entry.queries()[name](spark, sf_dir)
    rel = con.sql(entry.oracle_sql()[name])
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} and {sorted(rel.columns)}"
    names = sorted(df.columns)
    order = [rel.columns.index(c) for c in names]
    ours = sorted((tuple(plain(v) for v in r) for r in df.select(*names).collect()), key=repr)
    theirs = sorted((tuple(plain(r[i]) for i in order) for r in rel.fetchall()), key=repr)
    if ours == theirs:
        return ""
    diff = [(a, b) for a, b in zip(ours, theirs) if a != b][:2]
    return f"{len(ours)} and {len(theirs)} rows; {names}; {str(diff)[:900]}"


if __name__ == "__main__":
    import time

    from pyspark.sql import SparkSession

    sys.path.insert(0, ".")
    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    names = [n for n in entry.queries() if not sys.argv[1:] and n[:2] != "op" or any(n.startswith(a) for a in sys.argv[1:])]
    for n in names:
        t = time.time()
        try:
            if n in entry.oracle_sql():
                out = mismatch(spark, n, sf, entry) or "ok"
            else:
                out = f"rows only: {entry.queries()[n](spark, sf).count()}"
        except Exception as e:
            out = f"FAILED {type(e).__name__}: {str(e)[:1500]}"
        print(f"{n}: {out} ({time.time() - t:.1f} s)", flush=True)
