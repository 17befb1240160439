"""Stored tables, dated appends with partition pruning, alert store."""

from datetime import datetime

from pyspark.sql import functions as F

from pricewatch.operators import history, metrics
from pricewatch.sources import store


def test_store_tables_and_pruning(spark, scratch):
    names = store.create_store(spark, scratch)
    assert names == sorted(store.TABLES)
    cols = ("event_id string, source string, section string, row string, seat string, "
            "price double, fees double, total_price double, timestamp timestamp, "
            "listing_id string, listing_url string, quantity int")
    ev = spark.createDataFrame([("e", "m", None, None, None, 10.0, None, None,
                                 datetime(2024, 1, d), "l", None, 1) for d in (1, 2, 3)], cols)
    good, _ = history.ingest(ev)
    store.append_dated(good, scratch, "price_history")
    assert spark.table("price_history").count() == 3
    q = spark.table("price_history").where(F.col("date") >= "2024-01-03")
    from conftest import plan_text
    plan = plan_text(q)
    assert "PartitionFilters: [isnotnull(date" in plan and q.count() == 1


def test_store_alerts(spark):
    cols = ("event_id string, source string, section string, row string, seat string, "
            "old_price double, new_price double, drop_amount double, drop_percent double, "
            "alert_timestamp timestamp, listing_id string, listing_url string, alert_type string")
    t = datetime(2024, 1, 1)
    alerts = spark.createDataFrame([
        ("e1", "m", "A", "1", "1", 100.0, 90.0, 10.0, 10.0, t, "a", None, "price_drop"),
        ("e2", "m", "A", "1", "1", 100.0, 90.0, 10.0, 10.0, t, "b", None, "price_drop"),
        ("e1", "m", "A", "1", "1", 2e6, 1.0, 2e6 - 1, 1000.0, t, "c", None, "price_drop"),
    ], cols)
    dim = spark.createDataFrame([("e1",)], "event_id string")
    stored, rejects = history.store_alerts(alerts, dim)
    s = stored.collect()
    assert [(r.listing_id, str(r.old_price), str(r.drop_percent)) for r in s] == [("a", "100.00", "10.00")]
    assert sorted((r.listing_id, r.reject_reason) for r in rejects.collect()) == \
        [("b", "unknown_event"), ("c", "out_of_range_drop_percent")]
    m = {r.metric_name: r.metric_value for r in metrics.alert_metrics(alerts, stored, rejects).collect()}
    assert m == {"alerts_processed": 3, "alerts_stored": 1, "errors": 2}


def test_retention_prunes_days(spark, scratch):
    cols = "source string, timestamp timestamp"
    rows = [("m", datetime(2024, 1, d)) for d in range(1, 31)]
    df = spark.createDataFrame(rows, cols)
    kept = store.retain(df, "timestamp", "raw_prices", as_of="2024-01-31 00:00:00")
    assert kept.count() == 7
    assert store.retain(df, "timestamp", "price_alerts", as_of="2024-01-31 00:00:00").count() == 1


def test_replace_days_is_idempotent(spark, scratch):
    cols = ("event_id string, source string, section string, row string, seat string, "
            "price double, fees double, total_price double, timestamp timestamp, "
            "listing_id string, listing_url string, quantity int")
    day1 = spark.createDataFrame([("e", "m", None, None, None, 1.0, None, None,
                                   datetime(2024, 1, 1, h), "l", None, 1) for h in range(3)], cols)
    day2 = spark.createDataFrame([("e", "m", None, None, None, 2.0, None, None,
                                   datetime(2024, 1, 2, h), "l", None, 1) for h in range(2)], cols)
    g1, _ = history.ingest(day1)
    g2, _ = history.ingest(day2)
    store.append_dated(g1, scratch, "price_history", replace_days=True)
    store.append_dated(g2, scratch, "price_history", replace_days=True)
    store.append_dated(g2, scratch, "price_history", replace_days=True)   # run again
    got = store.read_dated(spark, scratch, "price_history").groupBy("date").count().collect()
    assert sorted((str(r["date"]), r["count"]) for r in got) == [("2024-01-01", 3), ("2024-01-02", 2)]
