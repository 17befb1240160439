"""Dashboard queries, thresholds, metrics and the notification payload."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pricewatch.operators import dashboard, metrics, notify, thresholds

T0 = datetime(2024, 1, 30, 0, 0)
HIST = "event_id long, source string, price double, timestamp timestamp, listing_id long"


def hist(spark, rows):
    return spark.createDataFrame(rows, HIST)


def test_stats_window_and_zero_default(spark):
    h = hist(spark, [(1, "a", 10.0, T0, 1), (1, "b", 30.0, T0 + timedelta(hours=1), 2),
                     (2, "a", 5.0, T0 - timedelta(days=5), 3)])
    s = dashboard.price_stats(h, 48, "2024-01-31 00:00:00").first()
    assert (s.total_listings, s.avg_price, s.min_price, s.max_price, s.num_sources) == \
        (2, 20.0, 10.0, 30.0, 2)
    e = dashboard.price_stats(h, 48, "2024-01-31 00:00:00", event_id=2).first()
    assert (e.total_listings, e.avg_price, e.min_price, e.num_sources) == (0, 0.0, 0.0, 0)


def test_time_filter_reaches_scan(spark):
    h = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(
        F.col("user_id").alias("event_id"), F.col("event_type").alias("source"),
        F.col("value").alias("price"), F.col("ts").alias("timestamp"),
        F.col("event_id").alias("listing_id"))
    from conftest import plan_text
    plan = plan_text(dashboard.recent(h, "timestamp", 48, "2024-01-31 00:00:00"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-29T00:00)]" in plan


def test_histogram_max_in_last_bin(spark):
    h = hist(spark, [(1, "a", float(p), T0, i) for i, p in enumerate([0, 1, 2, 29, 30])])
    got = {r.bin: r.n for r in dashboard.price_histogram(h, 30).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 30: 2}


def test_alert_filter_after_limit(spark):
    cols = ("event_id long, source string, old_price double, new_price double, drop_amount double, "
            "drop_percent double, alert_timestamp timestamp, listing_id long")
    rows = [(1 if i < 25 else 2, "a", 10.0, 9.0, 1.0, 10.0, T0 + timedelta(minutes=i), i)
            for i in range(30)]
    alerts = spark.createDataFrame(rows, cols)
    ev = spark.createDataFrame([(1, "One", "V"), (2, "Two", "W")], "event_id long, event_name string, venue string")
    top = dashboard.recent_alerts(alerts, ev, 20)
    assert top.count() == 20
    # event 1 has 25 alerts, but only those among the newest 20 are shown
    assert dashboard.recent_alerts(alerts, ev, 20, event_id=1).count() == 15


def test_cheapest_per_event(spark):
    h = hist(spark, [(e, "a", float(p), T0, e * 100 + p) for e in (1, 2) for p in range(10)])
    got = dashboard.cheapest_per_event(h, 3).collect()
    assert sorted((r.event_id, r.price) for r in got) == [(e, float(p)) for e in (1, 2) for p in range(3)]


def test_thresholds(spark):
    prices = spark.createDataFrame([
        ("e1", 90.0, "mock", "101", "5", "1", "l1", None, T0),
        ("e1", 90.0, "mock", "102", "A", "1", "l2", None, T0),
        ("e1", 150.0, "mock", "101", "3", "1", "l3", None, T0),
        ("e2", 10.0, "mock", "101", "1", "1", "l4", None, T0),
    ], "event_id string, price double, source string, section string, row string, seat string, "
       "listing_id string, listing_url string, timestamp timestamp")
    rules = spark.createDataFrame([
        (1, "e1", 100.0, None, None, True),      # any seat under 100
        (2, "e1", 100.0, "101", 10, True),       # section 101, rows up to 10
        (3, "e1", 100.0, "102", 10, True),       # lettered row never meets max_row
        (4, "e2", 100.0, None, None, False),     # inactive
    ], "id long, event_id string, target_price double, section string, max_row int, active boolean")
    got = sorted((r.alert_id, r.listing_id) for r in thresholds.match_thresholds(prices, rules).collect())
    assert got == [(1, "l1"), (1, "l2"), (2, "l1")]


@pytest.mark.parametrize("xs,want", [([100.0, 200.0, 50.0], 104.0), ([0.0, 0.0, 100.0, 200.0], 110.0),
                                     ([0.0], 0.0), ([5.0], 5.0)])
def test_ewma_fixture(spark, xs, want):
    df = spark.createDataFrame([("s", T0 + timedelta(hours=3 * i), i, x) for i, x in enumerate(xs)],
                               "source string, t timestamp, i int, x double")
    got = metrics.ewma(df, ["source"], ["t", "i"], "x").first()
    assert got.ewma == pytest.approx(want) and got.n == len(xs)


@pytest.mark.parametrize("chunk", ["minute", "day"])
def test_ewma_equals_loop(spark, chunk):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    want = {}
    for r in sorted(ev.collect(), key=lambda r: (r.ts, r.event_id)):
        m = want.get(r.event_type, 0.0)
        want[r.event_type] = r.value if m == 0 else 0.9 * m + 0.1 * r.value
    got = {r.event_type: r.ewma for r in
           metrics.ewma(ev, ["event_type"], ["ts", "event_id"], "value", chunk=chunk).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-12)


def test_latest_and_throughput(spark):
    df = spark.createDataFrame([("k", T0, 1, 1.0), ("k", T0 + timedelta(minutes=7), 2, 2.0),
                                ("j", T0, 3, 3.0)], "key string, t timestamp, i int, v double")
    got = {r.key: r.v for r in metrics.latest_per_key(df, ["key"], ["t", "i"], ["v"]).collect()}
    assert got == {"k": 2.0, "j": 3.0}
    tp = {r.window_start: (r.messages, r.per_minute) for r in metrics.throughput(df, "t").collect()}
    assert tp == {T0: (2, 0.4), T0 + timedelta(minutes=5): (1, 0.2)}


def test_payload(spark):
    cols = ("event_name string, venue string, section string, row string, seat string, "
            "old_price double, new_price double, drop_amount double, drop_percent double, "
            "source string, listing_url string, alert_timestamp timestamp")
    rows = [("Alpha", "North", "101", "5", "8", 400.0, 351.0, 49.0, 12.25, "mock", "http://x/1", T0),
            (None, None, None, None, None, 2.675, 1.0, 1.675, 62.617, None, "#", T0)]
    out = notify.with_payload(spark.createDataFrame(rows, cols)).collect()
    first = json.loads(out[0].payload)["embeds"][0]
    assert first["title"] == notify.TITLE and first["color"] == 65280
    assert first["description"] == "**Alpha**" and first["url"] == "http://x/1"
    values = [f["value"] for f in first["fields"]]
    assert values == ["North", "101 Row 5 Seat 8", "$400.00 → **$351.00**", "$49.00 (12.2%)", "MOCK"]
    assert [f["inline"] for f in first["fields"]] == [True, True, False, True, True]
    second = json.loads(out[1].payload)["embeds"][0]
    assert "url" not in second
    assert first["timestamp"] == "2024-01-30T00:00:00"
    assert [f["value"] for f in second["fields"]] == [
        "Unknown Venue", "Unknown Row N/A Seat N/A", "$2.67 → **$1.00**", "$1.68 (62.6%)", "UNKNOWN"]
    assert second["description"] == "**Unknown Event**"


def test_system_metrics_latest(spark):
    a = spark.createDataFrame([("errors", 1), ("stored", 5)], "metric_name string, metric_value long")
    b = spark.createDataFrame([("errors", 3)], "metric_name string, metric_value long")
    rows = metrics.as_system_metrics(a, "2024-01-01 00:00:00").unionByName(
        metrics.as_system_metrics(b, "2024-01-02 00:00:00"))
    got = {r.metric_name: str(r.metric_value) for r in metrics.latest_metrics(rows).collect()}
    assert got == {"errors": "3.00", "stored": "5.00"}


def test_alerts_per_hour_limit(spark):
    cols = "alert_timestamp timestamp, listing_id long"
    rows = [(T0 + timedelta(minutes=20 * i), i) for i in range(9)]     # 3 hours, 3 per hour
    a = spark.createDataFrame(rows, cols)
    assert [r.alerts for r in dashboard.alerts_per_hour(a).collect()] == [3, 3, 3]
    assert [r.alerts for r in dashboard.alerts_per_hour(a, limit=4).collect()] == [1, 3]


def test_best_offers(spark):
    prices = spark.createDataFrame([
        ("e1", 90.0, "mock", "101", "5", "1", "l1", None, T0),
        ("e1", 60.0, "mock", "102", "A", "1", "l2", None, T0),
        ("e1", 80.0, "mock", "101", "3", "1", "l3", None, T0 + timedelta(hours=1)),
        ("e1", 95.0, "mock", "101", "12", "1", "l5", None, T0),
        ("e2", 10.0, "mock", "101", "1", "1", "l4", None, T0),
    ], "event_id string, price double, source string, section string, row string, seat string, "
       "listing_id string, listing_url string, timestamp timestamp")
    rules = spark.createDataFrame([
        (1, "e1", 100.0, None, None, True),      # any seat: cheapest is l2 (row A)
        (2, "e1", 100.0, "101", 10, True),       # section 101, rows up to 10: l3
        (3, "e1", 70.0, "101", None, True),      # section 101 under 70: none
        (4, "e2", 100.0, None, None, False),     # inactive
    ], "id long, event_id string, target_price double, section string, max_row int, active boolean")
    got = {r.alert_id: (r.listing_id, float(r.price))
           for r in thresholds.best_offers(prices, rules).collect()}
    assert got == {1: ("l2", 60.0), 2: ("l3", 80.0)}
