"""Every library query against its SQL on the smallest tables, and the driver's three functions."""

import pytest
from oracle import mismatch

import __spark_entry__ as entry
from neumata.plans import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, name):
    assert mismatch(spark, name, SMALL, entry) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry_is_ranked(spark):
    rows = entry.entry(spark).collect()
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
    assert [r["diff"] for r in rows] == sorted(r["diff"] for r in rows)


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_tag_closure_has_no_row_limit(spark):
    spark.conf.set("spark.sql.cteRecursionRowLimit", "100")
    try:
        assert mismatch(spark, "tag_closure", SMALL, entry) == ""
    finally:
        spark.conf.unset("spark.sql.cteRecursionRowLimit")
