"""The streaming detector equals the batch detector when records arrive in
time order, also across a stop and restart on the same checkpoint."""

import json
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from pricewatch.operators import changes, normalize
from pricewatch.sources.feeds import read_price_events
from pricewatch.streaming import jobs


def price_events(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    none = F.lit(None).cast("string")
    return ev.select(
        F.col("user_id").cast("string").alias("event_id"), F.lit("Event").alias("event_name"),
        F.lit("Venue").alias("venue"), F.lit(None).cast("timestamp").alias("event_date"),
        F.col("event_type").alias("source"), none.alias("section"), none.alias("row"),
        none.alias("seat"), (F.col("value") - 10).alias("price"),
        F.lit(None).cast("double").alias("fees"), F.lit(None).cast("double").alias("total_price"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.format_string("%08d", "event_id").alias("listing_id"),
        none.alias("listing_url"), F.lit(1).alias("quantity"),
        none.alias("delivery_method"), none.alias("seller_notes"))


def land(spark, df, folder, parts):
    """Write ``df`` as JSON lines in ``parts`` time-ordered files."""
    bounds = df.approxQuantile("ts_num", [i / parts for i in range(1, parts)], 0.0) \
        if parts > 1 else []
    edges = [None] + bounds + [None]
    for i in range(parts):
        q = df
        if edges[i] is not None:
            q = q.where(F.col("ts_num") > edges[i])
        if edges[i + 1] is not None:
            q = q.where(F.col("ts_num") <= edges[i + 1])
        normalize.to_wire(q.drop("ts_num")).select("value").coalesce(1) \
            .write.mode("overwrite").text(os.path.join(folder, f"part{i:02d}"))


def with_num(df):
    return df.withColumn("ts_num", F.col("timestamp").cast("double"))


def run_detector(spark, source_glob, out, ckpt):
    events, _ = read_price_events(spark, source_glob, stream=True, max_files_per_trigger=1)
    q = jobs.start_detector(events, f"{out}/processed", f"{out}/alerts", ckpt)
    q.awaitTermination()
    return q


def batch_truth(spark):
    b = changes.classify_changes(price_events(spark))
    return {r.listing_id: (r.change_type, r.old_price) for r in b.collect()}


def test_stream_equals_batch(spark, scratch):
    src = os.path.join(scratch, "src")
    land(spark, with_num(price_events(spark)), src, 4)
    q = run_detector(spark, f"{src}/*/", f"{scratch}/out", f"{scratch}/ckpt")
    processed = spark.read.parquet(f"{scratch}/out/processed")
    got = {r.listing_id: (r.change_type, r.old_price) for r in processed.collect()}
    truth = batch_truth(spark)
    assert got == truth
    alerts = spark.read.parquet(f"{scratch}/out/alerts")
    assert alerts.count() == sum(1 for v in truth.values() if v[0] == "drop")
    assert processed.select("batch_id").distinct().count() == 4
    metrics = [p["observedMetrics"].get(jobs.DETECTOR_METRICS) for p in q.recentProgress
               if p.get("observedMetrics")]
    assert sum(m["price_drops"] for m in metrics) == alerts.count()


def test_restart_keeps_state(spark, scratch):
    df = with_num(price_events(spark))
    staged = os.path.join(scratch, "staged")
    land(spark, df, staged, 4)
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    ckpt, out = f"{scratch}/ckpt", f"{scratch}/out"
    for i in range(2):
        os.symlink(os.path.join(staged, f"part{i:02d}"), os.path.join(src, f"part{i:02d}"))
    run_detector(spark, f"{src}/*/", out, ckpt)
    first = spark.read.parquet(f"{out}/processed").count()
    for i in range(2, 4):
        os.symlink(os.path.join(staged, f"part{i:02d}"), os.path.join(src, f"part{i:02d}"))
    run_detector(spark, f"{src}/*/", out, ckpt)
    processed = spark.read.parquet(f"{out}/processed")
    got = {r.listing_id: (r.change_type, r.old_price) for r in processed.collect()}
    assert 0 < first < len(got)
    assert got == batch_truth(spark)


def test_storage_stream_dimension_merge(spark, scratch):
    df = with_num(price_events(spark))
    src = os.path.join(scratch, "src")
    land(spark, df, src, 3)
    events, _ = read_price_events(spark, f"{src}/*/", stream=True, max_files_per_trigger=1)
    root = f"{scratch}/store"
    q = jobs.start_storage(events, f"{root}/history", f"{root}/rejects", f"{root}/dimension",
                           f"{scratch}/ckpt", metrics_path=f"{root}/metrics")
    q.awaitTermination()
    hist = spark.read.parquet(f"{root}/history")
    assert hist.count() == df.count()
    m = spark.read.parquet(f"{root}/metrics")
    sums = {r.metric_name: int(r.s) for r in
            m.groupBy("metric_name").agg(F.sum("metric_value").alias("s")).collect()}
    assert sums == {"messages_received": df.count(), "prices_stored": df.count(), "errors": 0,
                    "events_created": df.select("event_id").distinct().count()}
    observed = [p["observedMetrics"][jobs.STORAGE_METRICS]["messages_received"]
                for p in q.recentProgress if p.get("observedMetrics")]
    assert sum(observed) == df.count()
    dim = jobs.read_dimension(spark, f"{root}/dimension")
    assert spark.read.parquet(f"{root}/dimension").select("batch_id").distinct().count() == 3
    want = df.groupBy("event_id").agg(F.min("timestamp").alias("c"), F.max("timestamp").alias("u"))
    got = {r.event_id: (r.created_at, r.last_updated) for r in dim.collect()}
    assert got == {r.event_id: (r.c, r.u) for r in want.collect()}


def test_throughput_stream(spark, scratch):
    df = with_num(price_events(spark))
    src = os.path.join(scratch, "src")
    land(spark, df, src, 2)
    events, _ = read_price_events(spark, f"{src}/*/", stream=True, max_files_per_trigger=1)
    q = (jobs.throughput_stream(events).writeStream.format("memory")
         .queryName("pw_tp").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r.window_start: r.messages for r in spark.table("pw_tp").collect()}
    batch = (df.groupBy(F.window("timestamp", "5 minutes").start.alias("s")).count().collect())
    want = {r.s: r["count"] for r in batch}
    # windows ending within the lateness of the newest record are not final yet
    assert got and all(want[k] == v for k, v in got.items())
    assert len(got) >= len(want) - 5


def test_normalizer_stream(spark, scratch):
    import json
    from pricewatch.schemas import TRACKED_EVENT
    src = os.path.join(scratch, "responses")
    os.makedirs(src)
    batches = [
        {"event_id": "ev_a", "listings": [{"id": "1", "price": 100, "section": "101", "row": 5},
                                          {"id": "2", "price": "abc"}]},
        {"event_id": "ev_a", "listings": [{"id": "1", "price": 90, "section": "101", "row": 5},
                                          {"id": "3", "price": "75.5", "fees": {"total": 5}}]},
    ]
    for i, b in enumerate(batches):
        with open(os.path.join(src, f"r{i}.json"), "w") as fh:
            fh.write(json.dumps(b) + "\n")
    tracked = spark.createDataFrame([("ev_a", "Alpha", "North", "2025-05-15T19:00:00Z")],
                                    TRACKED_EVENT)
    q = jobs.start_normalizer(spark, src, tracked, "seatgeek", f"{scratch}/wire",
                              f"{scratch}/rejects", f"{scratch}/ckpt", max_files_per_trigger=1)
    q.awaitTermination()
    events, bad = read_price_events(spark, f"{scratch}/wire")
    got = sorted((r.listing_id, r.price, r.total_price, r.event_name) for r in events.collect())
    assert got == [("seatgeek_1", 90.0, 90.0, "Alpha"), ("seatgeek_1", 100.0, 100.0, "Alpha"),
                   ("seatgeek_3", 75.5, 80.5, "Alpha")]
    assert bad.count() == 0
    rejects = spark.read.parquet(f"{scratch}/rejects").collect()
    assert [(r.listing_id, r.reject_reason) for r in rejects] == [("seatgeek_2", "bad_number")]


def test_two_consumers_one_source(spark, scratch):
    df = with_num(price_events(spark))
    src = os.path.join(scratch, "src")
    land(spark, df, src, 2)
    detector_in, _ = read_price_events(spark, f"{src}/*/", stream=True)
    storage_in, _ = read_price_events(spark, f"{src}/*/", stream=True)
    q1 = jobs.start_detector(detector_in, f"{scratch}/processed", f"{scratch}/alerts",
                             f"{scratch}/ckpt_detector")
    q2 = jobs.start_storage(storage_in, f"{scratch}/history", f"{scratch}/rejects",
                            f"{scratch}/dimension", f"{scratch}/ckpt_storage")
    q1.awaitTermination()
    q2.awaitTermination()
    n = df.count()
    assert spark.read.parquet(f"{scratch}/processed").count() == n
    assert spark.read.parquet(f"{scratch}/history").count() == n


def test_stream_error_for_junk_price(spark, scratch):
    from pricewatch.streaming.detector import detect_changes_stream
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    lines = ['{"event_id": "e", "source": "m", "price": "10", "timestamp": "2024-01-01T00:00:00Z", "listing_id": "a"}',
             '{"event_id": "e", "source": "m", "price": "abc", "timestamp": "2024-01-01T01:00:00Z", "listing_id": "b"}',
             '{"event_id": "e", "source": "m", "price": 8, "timestamp": "2024-01-01T02:00:00Z", "listing_id": "c"}']
    with open(os.path.join(src, "p.json"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    events, _ = read_price_events(spark, src, stream=True)
    q = (detect_changes_stream(events, raw_price="_raw_price").writeStream.format("memory")
         .queryName("pw_err").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r.listing_id: (r.change_type, r.old_price) for r in spark.table("pw_err").collect()}
    assert got == {"a": ("new", None), "b": ("error", None), "c": ("drop", 10.0)}


def test_stream_with_rocksdb_state(spark, scratch):
    from pricewatch.session import STREAMING_CONF
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, STREAMING_CONF[key])
    try:
        src = os.path.join(scratch, "src")
        land(spark, with_num(price_events(spark)), src, 2)
        run_detector(spark, f"{src}/*/", f"{scratch}/out", f"{scratch}/ckpt")
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
    processed = spark.read.parquet(f"{scratch}/out/processed")
    got = {r.listing_id: (r.change_type, r.old_price) for r in processed.collect()}
    assert got == batch_truth(spark)


def test_dimension_compaction(spark, scratch):
    df = with_num(price_events(spark))
    src = os.path.join(scratch, "src")
    staged = os.path.join(scratch, "staged")
    land(spark, df, staged, 4)
    os.makedirs(src)
    root, base = f"{scratch}/store", f"{scratch}/store/dimension_base"

    def run():
        events, _ = read_price_events(spark, f"{src}/*/", stream=True, max_files_per_trigger=1)
        jobs.start_storage(events, f"{root}/history", f"{root}/rejects", f"{root}/dimension",
                           f"{scratch}/ckpt").awaitTermination()

    for i in range(2):
        os.symlink(os.path.join(staged, f"part{i:02d}"), os.path.join(src, f"part{i:02d}"))
    run()
    assert jobs.compact_dimension(spark, f"{root}/dimension", base) == 1
    for i in range(2, 4):
        os.symlink(os.path.join(staged, f"part{i:02d}"), os.path.join(src, f"part{i:02d}"))
    run()
    plain = {r.event_id: tuple(r) for r in jobs.read_dimension(spark, f"{root}/dimension").collect()}
    with_base = {r.event_id: tuple(r)
                 for r in jobs.read_dimension(spark, f"{root}/dimension", base).collect()}
    assert plain == with_base and len(plain) == df.select("event_id").distinct().count()
    assert jobs.compact_dimension(spark, f"{root}/dimension", base) == 3
    again = {r.event_id: tuple(r)
             for r in jobs.read_dimension(spark, f"{root}/dimension", base).collect()}
    assert again == plain


def test_stream_bucket_mode(spark, scratch):
    from pricewatch.streaming.detector import detect_changes_stream
    src = os.path.join(scratch, "src")
    land(spark, with_num(price_events(spark)), src, 2)
    events, _ = read_price_events(spark, f"{src}/*/", stream=True, max_files_per_trigger=1)
    q = (detect_changes_stream(events, buckets=16, listing_ttl="365 days").writeStream
         .format("memory").queryName("pw_per_listing").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r.listing_id: (r.change_type, r.old_price) for r in spark.table("pw_per_listing").collect()}
    assert got == batch_truth(spark)


def test_table_state_detector_equals_batch(spark, scratch):
    df = with_num(price_events(spark))
    staged = os.path.join(scratch, "staged")
    land(spark, df, staged, 4)
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    out, ckpt = f"{scratch}/out", f"{scratch}/ckpt"

    def run():
        events, _ = read_price_events(spark, f"{src}/*/", stream=True, max_files_per_trigger=1)
        jobs.start_detector_tables(events, f"{out}/processed", f"{out}/alerts", f"{out}/state",
                                   ckpt, base_path=f"{out}/state_base").awaitTermination()

    for i in range(2):
        os.symlink(os.path.join(staged, f"part{i:02d}"), os.path.join(src, f"part{i:02d}"))
    run()
    keys = list(changes.LISTING_KEYS)
    before = {tuple(r)[:-1]: r[-1] for r in
              jobs.read_baselines(spark, f"{out}/state", keys).collect()}
    assert jobs.compact_baselines(spark, f"{out}/state", f"{out}/state_base", keys) == 1
    after = {tuple(r)[:-1]: r[-1] for r in jobs.read_baselines(
        spark, f"{out}/state", keys, base_path=f"{out}/state_base").collect()}
    assert after == before
    for i in range(2, 4):
        os.symlink(os.path.join(staged, f"part{i:02d}"), os.path.join(src, f"part{i:02d}"))
    run()
    processed = spark.read.parquet(f"{out}/processed")
    got = {r.listing_id: (r.change_type, r.old_price) for r in processed.collect()}
    assert got == batch_truth(spark)
    assert processed.select("batch_id").distinct().count() == 4


def test_table_state_previous_mode(spark, scratch):
    df = with_num(price_events(spark))
    staged = os.path.join(scratch, "staged")
    land(spark, df, staged, 3)
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    out = f"{scratch}/out"

    def run():
        events, _ = read_price_events(spark, f"{src}/*/", stream=True, max_files_per_trigger=1)
        jobs.start_detector_tables(events, f"{out}/processed", f"{out}/alerts", f"{out}/state",
                                   f"{scratch}/ckpt", baseline="previous",
                                   base_path=f"{out}/base").awaitTermination()

    for i in range(3):
        os.symlink(os.path.join(staged, f"part{i:02d}"), os.path.join(src, f"part{i:02d}"))
        run()
        if i == 1:
            jobs.compact_baselines(spark, f"{out}/state", f"{out}/base",
                                   list(changes.LISTING_KEYS), baseline="previous")
    got = {r.listing_id: (r.change_type, r.old_price)
           for r in spark.read.parquet(f"{out}/processed").collect()}
    want = changes.classify_changes(price_events(spark), baseline="previous")
    assert got == {r.listing_id: (r.change_type, r.old_price) for r in want.collect()}


def test_alert_store_stream(spark, scratch):
    """Detector -> alerts files -> alert store: payloads for all alerts,
    alerts of unknown events rejected, counters add up."""
    df = with_num(price_events(spark))
    src = os.path.join(scratch, "src")
    land(spark, df, src, 2)
    out = f"{scratch}/out"
    run_detector(spark, f"{src}/*/", out, f"{scratch}/ckpt_d")
    alerts_static = spark.read.parquet(f"{out}/alerts")
    n_alerts = alerts_static.count()
    # the store knows every event but one
    events_seen = df.select("event_id").distinct().orderBy("event_id").collect()
    missing = events_seen[0].event_id
    dim_rows = (df.where(F.col("event_id") != missing)
                .select("event_id", "event_name", "venue", "event_date", "timestamp", "listing_id"))
    from pricewatch.operators import history
    (history.event_dimension(dim_rows).withColumn("batch_id", F.lit(0))
     .write.mode("overwrite").partitionBy("batch_id").parquet(f"{scratch}/dimension"))
    alerts = spark.readStream.schema(alerts_static.schema).parquet(f"{out}/alerts")
    q = jobs.start_alert_store(alerts, f"{scratch}/stored", f"{scratch}/rejected",
                               f"{scratch}/outbox", f"{scratch}/ckpt_a",
                               dimension_path=f"{scratch}/dimension",
                               metrics_path=f"{scratch}/metrics")
    q.awaitTermination()
    outbox = spark.read.parquet(f"{scratch}/outbox")
    assert outbox.count() == n_alerts and outbox.where(F.col("payload").isNull()).count() == 0
    stored = spark.read.parquet(f"{scratch}/stored")
    rejected = spark.read.parquet(f"{scratch}/rejected")
    unknown = alerts_static.where(F.col("event_id") == missing).count()
    assert rejected.count() == unknown > 0
    assert {r.reject_reason for r in rejected.collect()} == {"unknown_event"}
    assert stored.count() == n_alerts - unknown
    assert dict(stored.dtypes)["old_price"] == "decimal(10,2)"
    m = spark.read.parquet(f"{scratch}/metrics")
    sums = {r.metric_name: int(r.s) for r in
            m.groupBy("metric_name").agg(F.sum("metric_value").alias("s")).collect()}
    assert sums == {"alerts_processed": n_alerts, "alerts_stored": n_alerts - unknown,
                    "errors": unknown}


def test_throughput_drops_late_records(spark, scratch):
    """Records older than the watermark (newest time minus 10 minutes) are
    not counted in windows that are already final."""
    src = os.path.join(scratch, "src")
    os.makedirs(src)

    def line(ts, lid):
        return json.dumps({"event_id": "e", "source": "m", "price": "1", "timestamp": ts,
                           "listing_id": lid})

    batches = [
        [line("2024-01-01T00:01:00Z", "a"), line("2024-01-01T00:02:00Z", "b")],
        [line("2024-01-01T01:00:00Z", "c")],                 # moves the watermark to 00:50
        [line("2024-01-01T00:03:00Z", "late"), line("2024-01-01T01:30:00Z", "d")],
    ]
    events, _ = read_price_events(spark, src, stream=True, max_files_per_trigger=1)
    q = (jobs.throughput_stream(events).writeStream.format("parquet")
         .option("path", f"{scratch}/tp").outputMode("append")
         .option("checkpointLocation", f"{scratch}/ckpt").trigger(availableNow=True))
    for i, b in enumerate(batches):
        with open(os.path.join(src, f"b{i}.json"), "w") as fh:
            fh.write("\n".join(b) + "\n")
        q.start().awaitTermination()
    got = {r.window_start.strftime("%H:%M"): r.messages
           for r in spark.read.parquet(f"{scratch}/tp").collect()}
    assert got["00:00"] == 2          # the late 00:03 record is not added


def _fixture_lines(prices, start=0):
    out = []
    for i, p in enumerate(prices, start):
        price = "NaN" if p != p else p
        out.append(json.dumps({"event_id": "ev_alpha", "source": "mock", "section": "A",
                               "row": "1", "seat": "1", "price": str(price),
                               "timestamp": f"2025-01-01T{i:02d}:00:00Z", "listing_id": f"l{i}"}))
    return out


def test_fixture_sequence_with_restart(spark, scratch):
    """The fixture's eight prices, stopped after the third and restarted."""
    prices = [100.0, 90.0, 95.0, 100.0, 120.0, 0.0, float("nan"), 119.0]
    want = [("new", None), ("drop", 100.0), ("drop", 100.0), ("same", 100.0),
            ("increase", 100.0), ("invalid", None), ("invalid", None), ("drop", 120.0)]
    for mode in ("store", "table"):
        src = os.path.join(scratch, mode, "src")
        os.makedirs(src)
        out = os.path.join(scratch, mode, "out")
        for part, (lo, hi) in enumerate(((0, 3), (3, 8))):
            with open(os.path.join(src, f"p{part}.json"), "w") as fh:
                fh.write("\n".join(_fixture_lines(prices[lo:hi], lo)) + "\n")
            events, _ = read_price_events(spark, src, stream=True)
            if mode == "store":
                q = jobs.start_detector(events, f"{out}/processed", f"{out}/alerts", f"{out}/ckpt")
            else:
                q = jobs.start_detector_tables(events, f"{out}/processed", f"{out}/alerts",
                                               f"{out}/state", f"{out}/ckpt")
            q.awaitTermination()
        rows = sorted(spark.read.parquet(f"{out}/processed").collect(), key=lambda r: r.listing_id)
        assert [(r.change_type, r.old_price) for r in rows] == want, mode
        assert spark.read.parquet(f"{out}/processed").select("batch_id").distinct().count() == 2


def test_transform_with_state_engine(spark, scratch):
    from pricewatch.session import STREAMING_CONF
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, STREAMING_CONF[key])
    try:
        staged = os.path.join(scratch, "staged")
        land(spark, with_num(price_events(spark)), staged, 4)
        src = os.path.join(scratch, "src")
        os.makedirs(src)
        out = f"{scratch}/out"
        for lo, hi in ((0, 2), (2, 4)):           # stop and restart in between
            for i in range(lo, hi):
                os.symlink(os.path.join(staged, f"part{i:02d}"), os.path.join(src, f"part{i:02d}"))
            events, _ = read_price_events(spark, f"{src}/*/", stream=True, max_files_per_trigger=1)
            jobs.start_detector(events, f"{out}/processed", f"{out}/alerts", f"{scratch}/ckpt",
                                engine="transform").awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
    got = {r.listing_id: (r.change_type, r.old_price)
           for r in spark.read.parquet(f"{out}/processed").collect()}
    assert got == batch_truth(spark)


def test_storage_dedup_within_watermark(spark, scratch):
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    lines = _fixture_lines([100.0, 90.0, 95.0])
    with open(os.path.join(src, "a.json"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    with open(os.path.join(src, "b.json"), "w") as fh:          # the same feed delivered again
        fh.write("\n".join(lines[1:]) + "\n")
    root = f"{scratch}/store"
    events, _ = read_price_events(spark, src, stream=True, max_files_per_trigger=1)
    jobs.start_storage(events, f"{root}/history", f"{root}/rejects", f"{root}/dimension",
                       f"{scratch}/ckpt", dedup_within="1 day").awaitTermination()
    assert spark.read.parquet(f"{root}/history").count() == 3


def test_state_folders_stay_few(spark, scratch):
    """Fifty batches, compacted after each fifth: readers see the same, and
    the folders don't pile up."""
    from pricewatch.sources.feeds import write_batch
    from pricewatch.streaming import deltas
    path, base, every = f"{scratch}/state", f"{scratch}/base", {}
    for i in range(50):
        rows = [(f"k{j}", float((i * 37 + j * 11) % 101), i) for j in range(i % 4, 12, 3)]
        df = spark.createDataFrame(rows, "listing string, value double, last_order int").coalesce(1)
        write_batch(df, path, i)
        for k, v, _ in rows:
            every.setdefault(k, []).append((i, v))
        if i % 5 == 4:
            assert jobs.compact_baselines(spark, path, base, ["listing"]) == i
        counts = len(os.listdir(path)), len(os.listdir(base)) if os.path.exists(base) else 0
        assert counts[0] <= 12 and counts[1] <= 2
    got = {r.listing: r._pw_seed for r in jobs.read_baselines(spark, path, ["listing"], base_path=base).collect()}
    assert got == {k: max(v for _, v in x) for k, x in every.items()}
    # A replay of the last batch reads the version before.
    before = jobs.read_baselines(spark, path, ["listing"], base_path=base, before=49).collect()
    assert {r.listing: r._pw_seed for r in before} == {k: max(v for i, v in x if i < 49) for k, x in every.items()}
    assert deltas.newest_batch(spark, path, base) == 49
    assert jobs.read_baselines(spark, f"{scratch}/none", ["listing"]) is None


def test_thresholds_stream_equals_batch(spark, scratch):
    """Rules with sections, rows and bad values; three batches, compaction
    after each; the stream's triggers are the batch operator's."""
    from pricewatch.operators import constraints, thresholds
    from pricewatch.sources import dated
    from pricewatch.sources.feeds import read_tagged_events
    src, out, rules = os.path.join(scratch, "src"), f"{scratch}/out", os.path.join(scratch, "rules.json")
    os.makedirs(src)
    lines = []
    for i in range(90):
        lines.append(json.dumps({
            "event_id": f"e{i % 2}", "source": "m", "section": "AB"[i % 3 % 2], "row": ["3", "12", "AA"][i % 3],
            "seat": "1", "price": (i * 53) % 97 or "junk", "timestamp": f"2024-01-01T{i // 4:02d}:{i % 4}0:00Z",
            "listing_id": f"l{i:03d}"}))
    for part in range(3):
        with open(os.path.join(src, f"p{part}.json"), "w") as fh:
            fh.write("\n".join(lines[part * 30:part * 30 + 30]) + "\n")
        os.utime(fh.name, (1e9 + part, 1e9 + part))         # taken in this order
    with open(rules, "w") as fh:
        for i in range(12):
            fh.write(json.dumps({"id": i, "event_id": f"e{i % 2}", "target_price": 10 + 7 * i,
                                 "section": [None, "A", "B"][i % 3], "max_row": [None, 5, 12, None][i % 4],
                                 "active": i != 5 or None, "created_at": "2024-01-01T00:00:00Z"}) + "\n")
        fh.write('{"id": 3, "event_id": "e1", "target_price": 1}\n{"id": 99, "event_id": null, "target_price": 1}\n')
    for _ in range(2):                          # the second run finds nothing new
        jobs.start_thresholds(read_tagged_events(spark, src, stream=True, max_files_per_trigger=1), rules,
                              f"{out}/triggers", f"{out}/bad", f"{out}/last", f"{out}/c", base_path=f"{out}/base",
                              compact_every=1).awaitTermination()
    good, _ = read_price_events(spark, src)
    checked = constraints.check(spark.read.json(rules).withColumn("created_at", F.to_timestamp("created_at")), "alerts",
                                order=["created_at"])
    want = thresholds.threshold_crossings(good, checked.where("reject_reason is null")).drop("seat", "listing_url")
    got = spark.read.parquet(f"{out}/triggers").select(want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 10
    bad = spark.read.parquet(f"{out}/bad").where("batch_id = 0").collect()
    assert sorted((r.id, r.reject_reason) for r in bad) == [(3, "duplicate_id"), (99, "null_event_id")]
    moved = {r.id: r.last_triggered for r in jobs.read_rules(spark, rules, f"{out}/triggers").collect()}
    newest = {r.alert_id: r.t for r in got.groupBy("alert_id").agg(F.max("triggered_at").alias("t")).collect()}
    assert moved == {i: newest.get(i) for i in range(12)} and dated.finished(spark, f"{out}/triggers", 2)
