"""Plan properties of every registered core query: JVM only, no cartesian or
nested-loop joins, and time windows pushed into the Parquet scan."""

import re

import pytest

from conftest import SF_SMALL, plan_text
from pricewatch.plans.catalog import QUERIES

NAMES = sorted(QUERIES)
PYTHON = re.compile(r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas|PythonUDF")
PAIRS = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin")
TIME_WINDOWED = ["retention_filter", "price_history_recent", "price_history_recent_event",
                 "price_stats", "price_stats_event", "incremental_drop_alerts",
                 "dashboard_price_series"]


def _plan(spark, name):
    return plan_text(QUERIES[name](spark, SF_SMALL))


@pytest.mark.parametrize("name", NAMES)
def test_jvm_only_and_no_pair_joins(spark, name):
    plan = _plan(spark, name)
    assert not PYTHON.search(plan), name
    assert not PAIRS.search(plan), name


@pytest.mark.parametrize("name", TIME_WINDOWED)
def test_time_window_pushed_to_scan(spark, name):
    plan = _plan(spark, name)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,", plan), name


def test_hot_keys_shuffle_on_key_and_chunk(spark):
    from pricewatch.operators import changes
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    hot = changes.classify_changes(ev, ["event_type"], "value", ["ts", "event_id"],
                                   hot_rows=0, probe_fraction=1.0)
    cold = changes.classify_changes(ev, ["event_type"], "value", ["ts", "event_id"],
                                    hot_rows=10 ** 9)
    assert re.search(r"Exchange hashpartitioning\(event_type#\d+, _pw_chunk", plan_text(hot))
    assert re.search(r"Exchange hashpartitioning\(event_type#\d+, \d+\)", plan_text(cold))
    assert "_pw_chunk" not in plan_text(cold)
