"""Every bound query against DuckDB, and the plans of the row-level ones."""

import datetime
import decimal
import math
import re

import duckdb
import pytest

from aeroperf.bindings import driver

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return str(v) if isinstance(v, (datetime.date, datetime.datetime)) else v


def rows(columns, got):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in got), key=lambda r: [(x is None, str(x)) for x in r])


@pytest.mark.parametrize("name", list(driver.QUERIES))
def test_query_equals_its_sql(spark, sf, duck, name):
    df = driver.QUERIES[name](spark, sf)
    want = duck.sql(driver.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, df.collect()) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", ["kpi_daily", "nearest_asof", "islands_merge", "near_pairs", "keyed_diff_summary", "anti_left", "collapse_same_key"])
def test_plan_has_no_pairwise_join(spark, sf, name):
    plan = driver.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython", plan)


def test_scan_reads_only_what_is_needed(spark, sf):
    plan = driver.QUERIES["boundary_rows"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in plan


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_queries_look_at_whole_tables(spark, sf):
    assert sum(r.n for r in driver.QUERIES["month_coverage"](spark, sf).collect()) == spark.read.parquet(f"{sf}/orders.parquet").count()
    assert driver.QUERIES["scalar_text"](spark, sf).count() == spark.read.parquet(f"{sf}/pages.parquet").count()
