"""Every registered core query against its SQL twin in DuckDB (smallest scale)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from pricewatch.plans.catalog import ORACLE, QUERIES
from pricewatch.plans.driver import TABLES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v.isoformat() if hasattr(v, "isoformat") else v


def _rows(names, found):
    cols = sorted(names)
    at = [names.index(c) for c in cols]
    return cols, sorted((tuple(_norm(r[i]) for i in at) for r in found), key=repr)


def _spark_rows(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    return _rows(df.columns, df.collect())


def _duck_rows(duck, name):
    found = duck.execute(ORACLE[name])
    return _rows([d[0] for d in found.description], found.fetchall())


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "drop_percent" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    got = _spark_rows(spark, name)
    want = _duck_rows(duck, name)
    assert got[0] == want[0]
    assert got[1] == want[1]


@pytest.mark.parametrize("name", ["price_history_recent", "alerts_per_hour", "avg_price_by_time_source",
                                  "throughput_5min", "wire_roundtrip", "retention_filter",
                                  "price_drop_alerts"])
def test_time_queries_in_another_zone(spark, duck, name):
    """Driver timestamps are zone-less; results must not move with the
    session time zone."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = _spark_rows(spark, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    want = _duck_rows(duck, name)
    assert got == want
