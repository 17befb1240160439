"""Dated feeds: day partitions, the log of finished batches, replays,
retention; the constraint checks on the way in."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from pricewatch.__main__ import main
from pricewatch.operators import constraints, normalize, validate
from pricewatch.plans.report import dashboard_report
from pricewatch.sources import dated, files, store
from pricewatch.sources.feeds import price_event_feed, read_tagged_events
from pricewatch.streaming import jobs


def line(i, price, ts, event="ev_a", **more):
    return json.dumps({"event_id": event, "event_name": "Alpha", "venue": "North", "source": "m", "section": "A",
                       "row": "1", "seat": "1", "price": price, "timestamp": ts, "listing_id": f"l{i}",
                       "event_date": "2025-01-01T00:00:00Z", **more})


def land(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def data_files(root):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.startswith("part-"))


def forget(checkpoint, batch_id):
    """As if the driver had died before the batch was noted as finished."""
    for kind in ("commits", "offsets"):
        for name in (str(batch_id), f".{batch_id}.crc"):
            p = os.path.join(checkpoint, kind, name)
            if kind == "commits" and os.path.exists(p):
                os.remove(p)


def test_write_once_and_replay(spark, scratch):
    path = f"{scratch}/feed"
    rows = [(i, dt.datetime(2024, 1, 1 + i % 3)) for i in range(9)] + [(99, None)]
    df = spark.createDataFrame(rows, "id long, ts timestamp")
    assert dated.write(df, path, 0, "ts")
    began = dated.begin(spark, path, 0)
    before = data_files(path)
    assert not dated.write(df, path, 0, "ts") and data_files(path) == before
    got = spark.read.parquet(path)
    assert {str(r.date): r["count"] for r in got.groupBy("date").count().collect()} == {
        "2024-01-01": 3, "2024-01-02": 3, "2024-01-03": 3, str(began.date()): 1}

    # Cut off after two days were there: only the others are written again.
    files.delete(spark, f"{path}/_log/done/batch_id=0")
    files.delete(spark, f"{path}/date=2024-01-02")
    kept = data_files(path)
    assert dated.write(df, path, 0, "ts") and set(kept) <= set(data_files(path))
    assert spark.read.parquet(path).count() == 10 and dated.begin(spark, path, 0) == began


def test_empty_batches_and_feed(spark, scratch):
    path = f"{scratch}/feed"
    none = spark.createDataFrame([], "id long, ts timestamp, date date")
    dated.write(none, path, 0, "ts")
    assert spark.read.parquet(path).count() == 0
    dated.write(spark.createDataFrame([(1, None)], "id long, ts timestamp"), path, 1, "ts")
    seen = []

    def take(entries, batch_id):
        seen.append(sorted(r.id for r in feed.rows(entries).collect()))
    feed = dated.Feed(path, max_batches=1)
    (feed.entries(spark).writeStream.foreachBatch(take).trigger(availableNow=True)
     .option("checkpointLocation", f"{scratch}/ckpt").start().awaitTermination())
    assert seen == [[], [1]]


def test_replay_of_the_job_before_changes_nothing_behind(spark, scratch):
    """Detector -> alerts: batches of both are replayed, rows stay the same."""
    src, out = f"{scratch}/src", f"{scratch}/out"

    def run():
        jobs.start_detector_tables(read_tagged_events(spark, src, stream=True, max_files_per_trigger=1),
                                   f"{out}/processed", f"{out}/alerts", f"{out}/state", f"{out}/c1",
                                   rejects_path=f"{out}/bad").awaitTermination()
        jobs.start_storage(read_tagged_events(spark, src, stream=True, max_files_per_trigger=1),
                           f"{out}/history", f"{out}/rejects", f"{out}/events", f"{out}/c2",
                           metrics_path=f"{out}/metrics").awaitTermination()
        jobs.start_alert_store(dated.Feed(f"{out}/alerts"), f"{out}/stored", f"{out}/unknown", f"{out}/outbox",
                               f"{out}/c3", dimension_path=f"{out}/events").awaitTermination()

    land(src, "a.json", [line(0, 100, "2024-01-01T10:00:00Z"), "{broken", line(1, "x", "2024-01-01T10:00:00Z")])
    land(src, "b.json", [line(2, 80, "2024-01-02T10:00:00Z"), line(3, 70, "2024-01-02T11:00:00Z")])
    run()
    feeds = ("processed", "alerts", "bad", "history", "rejects", "metrics", "stored", "unknown", "outbox")
    before = {f: (data_files(f"{out}/{f}"), sorted(map(str, spark.read.parquet(f"{out}/{f}").collect())))
              for f in feeds}
    assert len(before["stored"][1]) == 2 and len(before["processed"][1]) == 4 and len(before["bad"][1]) == 1
    for c in ("c1", "c2", "c3"):
        forget(f"{out}/{c}", 1)
        forget(f"{out}/{c}", 0 if c == "c3" else 1)
    run()
    run()
    after = {f: (data_files(f"{out}/{f}"), sorted(map(str, spark.read.parquet(f"{out}/{f}").collect())))
             for f in feeds}
    assert after == before


def test_parsed_once(spark, scratch):
    land(f"{scratch}/src", "a.json", [line(0, 1, "2024-01-01T00:00:00Z")])
    tagged = read_tagged_events(spark, f"{scratch}/src")
    for df in (tagged, *normalize.from_wire(spark.read.text(f"{scratch}/src"))):
        plan = plan_text(df)
        assert plan.count("from_json") == 1


def test_report_and_retention_prune_days(spark, scratch):
    src, out = f"{scratch}/src", f"{scratch}/out"
    land(src, "a.json", [line(d, 100 - d, f"2024-01-{d:02d}T12:00:00Z") for d in range(1, 31)])
    jobs.start_storage(read_tagged_events(spark, src, stream=True), f"{out}/price_history", f"{out}/rejects",
                       f"{out}/events", f"{out}/c").awaitTermination()
    jobs.start_detector_tables(read_tagged_events(spark, src, stream=True), f"{out}/processed_prices",
                               f"{out}/price_alerts", f"{out}/state", f"{out}/c1").awaitTermination()
    jobs.start_alert_store(dated.Feed(f"{out}/price_alerts"), f"{out}/price_drop_alerts", f"{out}/unknown",
                           f"{out}/outbox", f"{out}/c2", dimension_path=f"{out}/events").awaitTermination()
    report = dashboard_report(spark, out, hours=24, as_of="2024-01-31 00:00:00")
    for part in ("recent_prices", "stats"):
        plan = plan_text(report[part])
        assert "PartitionFilters: [isnotnull(date" in plan or "PartitionFilters: [(date" in plan
    assert report["recent_prices"].count() == 1

    feed = spark.read.parquet(f"{out}/processed_prices")
    kept = store.retain(feed, "timestamp", "raw_prices", "2024-01-31 00:00:00")
    assert "PartitionFilters: [isnotnull(date" in plan_text(kept) and kept.count() == 7
    gone = store.drop_expired(spark, out, "processed_prices", "raw_prices", dt.datetime(2024, 1, 31))
    assert len(gone) == 23 and not any(files.exists(spark, f"{out}/processed_prices/date={d}") for d in gone)
    assert spark.read.parquet(f"{out}/processed_prices").count() == 7
    # A second batch: its entry outlives the first one's, whose days all went.
    dated.write(feed.limit(0), f"{out}/processed_prices", 1)
    store.drop_expired(spark, out, "processed_prices", "raw_prices", dt.datetime(2034, 1, 31))
    assert files.children(spark, f"{out}/processed_prices/_log/done") == ["batch_id=1"]


def test_catalog_partitions(spark, scratch):
    spark.sql("CREATE DATABASE IF NOT EXISTS pw_feeds")
    spark.catalog.setCurrentDatabase("pw_feeds")
    try:
        store.create_store(spark, scratch)
        rows = spark.createDataFrame([("m", 1.0, dt.datetime(2024, 1, d)) for d in (1, 2, 3)],
                                     "metric_name string, metric_value double, timestamp timestamp")
        typed = constraints.check(rows, "system_metrics").drop("reject_reason", "reject_reasons")
        store.append_dated(typed, scratch, "system_metrics", load=5)
        assert [r[0] for r in spark.sql("SHOW PARTITIONS system_metrics").collect()] == [
            f"date=2024-01-0{d}/batch_id=5" for d in (1, 2, 3)]
        assert spark.table("system_metrics").where("date = '2024-01-02'").count() == 1
        gone = store.drop_expired(spark, scratch, "system_metrics", "price_alerts", dt.datetime(2024, 1, 4))
        assert gone == ["2024-01-01", "2024-01-02"] and spark.table("system_metrics").count() == 1
        assert len(spark.sql("SHOW PARTITIONS system_metrics").collect()) == 1
    finally:
        for t in store.TABLES:
            spark.sql(f"DROP TABLE IF EXISTS {t}")
        spark.catalog.setCurrentDatabase("default")


def test_dimension_takes_checked_rows(spark, scratch):
    src, out = f"{scratch}/src", f"{scratch}/out"
    ts = "2024-01-01T10:00:00Z"
    land(src, "a.json", [line(0, 1, ts, "e" * 300), line(1, 2, ts, "ev_b", event_name=None, venue=None,
                                                          event_date="soon"),
                         line(2, 3, ts, "ev_c", event_name="n" * 256, section="s" * 51), line(3, 1e9, ts, "ev_d"),
                         line(4, 5, ts, "ev_a"), '{"price": 1}', "[1"])
    jobs.start_storage(read_tagged_events(spark, src, stream=True), f"{out}/history", f"{out}/rejects",
                       f"{out}/events", f"{out}/c", metrics_path=f"{out}/m").awaitTermination()
    dim = {r.event_id: r for r in jobs.read_dimension(spark, f"{out}/events").collect()}
    assert set(dim) == {"ev_a", "ev_b"}
    assert (dim["ev_b"].event_name, dim["ev_b"].venue) == ("", "") and dim["ev_b"].event_date is not None
    rejects = spark.read.parquet(f"{out}/rejects").collect()
    assert sorted(tuple(r.reject_reasons) for r in rejects) == [
        ("malformed_json",), ("null_event_id",), ("out_of_range_price", "out_of_range_total_price"),
        ("too_long_event_id",), ("too_long_section", "too_long_event_name")]
    assert all(r._raw for r in rejects)
    m = {r.metric_name: int(r.metric_value) for r in spark.read.parquet(f"{out}/m").collect()}
    assert m == {"messages_received": 7, "prices_stored": 2, "errors": 5, "events_created": 2}


def test_constraints_of_all_tables(spark):
    events = spark.createDataFrame([("a", "A", "v", "2024-01-01 00:00:00", "c" * 101, "s"),
                                    ("a", "A", "v", "2024-01-01 00:00:00", "c", "s" * 51),
                                    ("b", None, "v", "never", None, None), ("b", "B", "v", "2024-01-01", None, None),
                                    (None, "x" * 256, "v", "2024-01-01", None, None),
                                    ("d", "D", "v", "2024-01-01", None, None), ("d", "D", "v", "2024-01-01", None, None)],
                                   "event_id string, event_name string, venue string, event_date string, city string, "
                                   "state string")
    got = sorted((r.event_id or "", *r.reject_reasons) for r in constraints.check(events, "events").collect())
    assert got == [("", "null_event_id", "too_long_event_name"), ("a", "too_long_city"), ("a", "too_long_state"),
                   ("b",), ("b", "null_event_name", "unreadable_event_date"), ("d",), ("d", "duplicate_event_id")]
    rules = spark.createDataFrame([(1, "a", "10", None), (2, "zz", "1e9", "u" * 256), (1, "a", "10", None)],
                                  "id long, event_id string, target_price string, user_id string")
    known = spark.createDataFrame([("a",)], "event_id string")
    rows = constraints.check(rules, "alerts", known).collect()
    assert sorted((r.id, *r.reject_reasons) for r in rows) == [
        (1,), (1, "duplicate_id"), (2, "out_of_range_target_price", "too_long_user_id", "unknown_event")]
    assert {(r.user_id, r.notification_method, r.active) for r in rows if r.id == 1} == {
        ("default_user", "discord", True)}
    fired = spark.createDataFrame([(1, "5", None, "r" * 11), (9, None, "m", None)],
                                  "alert_id long, price string, source string, row string")
    assert sorted(tuple(r.reject_reasons) for r in constraints.check(fired, "alert_triggers", rules).collect()) == [
        ("null_price", "unknown_alert"), ("null_source", "too_long_row")]
    metric = spark.createDataFrame([("m" * 101, 1e14)], "metric_name string, metric_value double")
    assert [r.reject_reasons for r in constraints.check(metric, "system_metrics").collect()] == [
        ["out_of_range_metric_value", "too_long_metric_name"]]
    assert constraints.check(events.limit(0), "events").count() == 0
    assert validate.REASONS in constraints.check(events, "events").columns


def test_commands_write_rejects(spark, scratch):
    src, out = f"{scratch}/src", f"{scratch}/out"
    land(src, "a.json", [line(0, 100, "2024-01-01T10:00:00Z"), "{broken", line(1, 90, "2024-01-01T11:00:00Z")])
    for extra, name in (([], "state"), (["--state-table"], "table")):
        assert main(["detect", "--events", src, "--out", f"{out}/{name}", *extra]) == 0
        bad = spark.read.parquet(f"{out}/{name}/detect_rejects").collect()
        assert [(r._raw, r.reject_reason) for r in bad] == [("{broken", "malformed_json")]
        assert spark.read.parquet(f"{out}/{name}/price_alerts").count() == 1
    assert main(["store", "--events", src, "--out", out]) == 0
    assert [(r._raw, r.reject_reason) for r in spark.read.parquet(f"{out}/price_rejects").collect()] == [
        ("{broken", "malformed_json")]
    assert main(["retain", "--out", f"{out}/table", "--as-of", "2030-01-01"]) == 0
    assert not [d for d in os.listdir(f"{out}/table/processed_prices") if d.startswith("date=")]


def test_feed_of_wire_records(spark, scratch):
    rows = spark.createDataFrame([(line(0, 5, "2024-01-01T00:00:00Z"),), ("nope",)], "value string")
    dated.write(rows, f"{scratch}/w", 0, fmt="text")
    feed, got = price_event_feed(f"{scratch}/w"), []
    (feed.entries(spark).writeStream.trigger(availableNow=True).option("checkpointLocation", f"{scratch}/c")
     .foreachBatch(lambda e, i: got.extend((r.price, r._wire_reason) for r in feed.rows(e).collect()))
     .start().awaitTermination())
    assert sorted(got, key=str) == [(5.0, None), (None, "malformed_json")]


def test_alert_before_its_event(spark, scratch):
    src, out = f"{scratch}/src", f"{scratch}/out"
    alerts = spark.createDataFrame(
        [(e, "m", "A", "1", "1", 9.0, 8.0, 1.0, 11.1, dt.datetime(2024, 1, 1), f"l{e}", None, "price_drop")
         for e in ("ev_a", "ev_b")] + [("ev_a", "m" * 51, "A", "1", "1", 9.0, 8.0, 1.0, 11.1,
                                        dt.datetime(2024, 1, 1), "bad", None, "price_drop")],
        "event_id string, source string, section string, row string, seat string, old_price double, "
        "new_price double, drop_amount double, drop_percent double, alert_timestamp timestamp, listing_id string, "
        "listing_url string, alert_type string")
    with_names = alerts.withColumns({"event_name": F.lit("A"), "venue": F.lit("v"), "event_date": F.lit(None)
                                     .cast("timestamp")})
    dated.write(with_names, f"{out}/price_alerts", 0, "alert_timestamp")

    def run(*events):
        for e in events:
            land(src, f"{e}.json", [line(0, 5, "2024-01-01T00:00:00Z", e)])
        if events:
            assert main(["store", "--events", src, "--out", out]) == 0
        assert main(["alerts", "--alerts", f"{out}/price_alerts", "--dimension", f"{out}/events", "--out", out]) == 0
        jobs.start_alert_retry(f"{out}/alert_rejects", f"{out}/price_drop_alerts", f"{out}/price_history",
                               f"{out}/events", f"{out}/waiting", f"{out}/c", f"{out}/events_base").awaitTermination()
        return sorted(r.listing_id for r in spark.read.parquet(f"{out}/price_drop_alerts").collect())

    land(src, "x.json", [line(0, 5, "2024-01-01T00:00:00Z", "ev_x")])
    assert main(["store", "--events", src, "--out", out]) == 0
    assert run() == []
    assert run("ev_a") == ["lev_a"]
    forget(f"{out}/c", 1)                       # the storing batch again
    assert run() == ["lev_a"]
    assert run("ev_b") == ["lev_a", "lev_b"] and run() == ["lev_a", "lev_b"]
    assert len([n for n in os.listdir(f"{out}/waiting") if n.startswith("batch_id=")]) <= 2


def test_listener_and_detector_counters(spark, scratch):
    src, out = f"{scratch}/src", f"{scratch}/out"
    land(src, "a.json", [line(i, p, f"2024-01-01T{i:02d}:00:00Z") for i, p in enumerate([10, 9, "x", 10, 12, 0])])
    listener = jobs.MetricsListener(spark, f"{out}/m1")
    spark.streams.addListener(listener)
    try:
        tagged = read_tagged_events(spark, src, stream=True)
        jobs.start_detector(normalize.good_events(tagged), f"{out}/p1", f"{out}/a1", f"{out}/c1").awaitTermination()
        end = dt.datetime.now() + dt.timedelta(seconds=30)
        while not os.path.exists(f"{out}/m1/_SUCCESS") and dt.datetime.now() < end:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    jobs.start_detector_tables(read_tagged_events(spark, src, stream=True), f"{out}/p2", f"{out}/a2", f"{out}/s2",
                               f"{out}/c2", metrics_path=f"{out}/m2").awaitTermination()
    want = {"events_processed": 6, "price_changes": 2, "price_drops": 1, "price_increases": 1, "unchanged": 1,
            "new_listings": 1, "invalid_prices": 1, "errors": 1}
    seen = {r.metric_name: int(r.metric_value) for r in spark.read.parquet(f"{out}/m1").collect()}
    assert seen == {f"{jobs.DETECTOR_METRICS}.{k}": v for k, v in want.items()}
    assert {r.metric_name: int(r.metric_value) for r in spark.read.parquet(f"{out}/m2").collect()} == want


def test_log_order(spark, scratch, monkeypatch):
    """Records of a message log are taken in the log's order, not by scrape
    time; the command line reads a topic the same way."""
    from pricewatch.sources import feeds
    rows = [("100", 1, 0, 0, 9), ("90", 2, 0, 1, 1), ("95", 2, 1, 0, 5), ("120", 2, 1, 1, 3), ("80", 3, 0, 2, 2)]
    records = [(line(o + 10 * p, price, f"2024-01-01T0{scraped}:00:00Z", event_name=f"n{price}"),
                dt.datetime(2024, 1, 1, 0, 0, t), p, o) for price, t, p, o, scraped in rows]
    spark.createDataFrame(records[::-1], "value string, timestamp timestamp, partition int, offset long") \
        .coalesce(1).write.parquet(f"{scratch}/log")
    want = {"100.0": ("new", None), "90.0": ("drop", 100.0), "95.0": ("drop", 100.0), "120.0": ("increase", 100.0),
            "80.0": ("drop", 120.0)}
    monkeypatch.setattr(feeds, "read_kafka",
                        lambda s, servers, topic, starting, most: feeds.read_landed_log(s, f"{scratch}/{topic}"))
    for extra in ([], ["--state-table"]):
        out = f"{scratch}/out{len(extra)}"
        assert main(["detect", "--kafka", "host:1", "--events", "log", "--out", out, *extra]) == 0
        got = {str(r.price): (r.change_type, r.old_price)
               for r in spark.read.parquet(f"{out}/processed_prices").collect()}
        assert got == want
    assert main(["store", "--kafka", "host:1", "--events", "log", "--out", f"{scratch}/st"]) == 0
    dim = jobs.read_dimension(spark, f"{scratch}/st/events").collect()
    assert [(r.event_name, r.created_at.hour, r.last_updated.hour) for r in dim] == [("n100", 1, 9)]
    assert "partition" not in spark.read.parquet(f"{scratch}/st/price_history").columns


if __name__ == "__main__":
    pytest.main([__file__])
