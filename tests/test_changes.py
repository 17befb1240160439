"""Change detection: the fixture sequence, ties, interleaving, and the
windowed form against a plain state machine on the driver's events."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pricewatch.operators import changes

T0 = datetime(2024, 1, 1, 12, 0, 0)
SCHEMA = ("event_id string, source string, section string, row string, seat string, "
          "price double, timestamp timestamp, listing_id string")


def events(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def one_listing(prices, gap=timedelta(minutes=30)):
    return [("ev1", "mock", "A", "1", "1", p, T0 + i * gap, f"l{i}") for i, p in enumerate(prices)]


def by_time(df):
    return sorted(df.collect(), key=lambda r: (r.timestamp, r.listing_id))


def test_fixture_sequence(spark):
    # price, change_type, old_price: rule R1 (baseline = max of earlier valid)
    prices = [100.0, 90.0, 95.0, 100.0, 120.0, 0.0, float("nan"), 119.0]
    want = [("new", None), ("drop", 100.0), ("drop", 100.0), ("same", 100.0),
            ("increase", 100.0), ("invalid", None), ("invalid", None), ("drop", 120.0)]
    got = by_time(changes.classify_changes(events(spark, one_listing(prices))))
    assert [(r.change_type, r.old_price) for r in got] == want
    alerts = by_time(changes.drop_alerts(changes.classify_changes(events(spark, one_listing(prices)))))
    assert [(r.old_price, r.new_price, round(r.drop_amount, 6), round(r.drop_percent, 4))
            for r in alerts] == [(100.0, 90.0, 10.0, 10.0), (100.0, 95.0, 5.0, 5.0),
                                 (120.0, 119.0, 1.0, 0.8333)]
    assert {r.alert_type for r in alerts} == {"price_drop"}


def test_previous_mode(spark):
    prices = [100.0, 90.0, 95.0, 100.0, 120.0, 0.0, 119.0]
    got = by_time(changes.classify_changes(events(spark, one_listing(prices)), baseline="previous"))
    assert [r.change_type for r in got] == ["new", "drop", "increase", "increase", "increase",
                                            "invalid", "drop"]
    assert [r.old_price for r in got][-1] == 120.0


@pytest.mark.parametrize("hot_rows", [10 ** 9, 0])
def test_interleaved_ties_and_null_keys(spark, hot_rows):
    rows = [
        ("ev1", "mock", None, "1", "1", 50.0, T0, "b"),
        ("ev1", "mock", None, "1", "1", 40.0, T0, "a"),       # same time: 'a' comes first
        ("ev1", "mock", "B", "1", "1", 10.0, T0, "c"),
        ("ev1", "mock", None, "1", "1", 45.0, T0 + timedelta(hours=1), "d"),
        ("ev1", "mock", "B", "1", "1", 5.0, T0 + timedelta(hours=2), "e"),
    ]
    got = {r.listing_id: (r.change_type, r.old_price)
           for r in changes.classify_changes(events(spark, rows), hot_rows=hot_rows,
                                   probe_fraction=1.0 if hot_rows == 0 else 0.01).collect()}
    assert got == {"a": ("new", None), "b": ("increase", 40.0), "c": ("new", None),
                   "d": ("drop", 50.0), "e": ("drop", 10.0)}


def state_machine(rows):
    """The detector loop, row by row, over rows in (key, time, tie) order."""
    cache, out = {}, {}
    for key, price, rid in rows:
        if price is None or math.isnan(price) or price <= 0:
            out[rid] = ("invalid", None)
            continue
        if key in cache:
            old = cache[key]
            if price < old:
                out[rid] = ("drop", old)
                continue
            out[rid] = ("increase", old) if price > old else ("same", old)
        else:
            out[rid] = ("new", None)
        cache[key] = price
    return out, cache


@pytest.mark.parametrize("chunk", ["minute", "hour", "day", "year"])
def test_window_equals_state_machine(spark, chunk):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("value", F.col("value") - 10)
    rows = sorted(ev.select("user_id", "event_type", "ts", "event_id", "value").collect(),
                  key=lambda r: (r.ts, r.event_id))
    want, _ = state_machine([((r.user_id, r.event_type), r.value, r.event_id) for r in rows])
    got = changes.classify_changes(ev, ("user_id", "event_type"), "value", ("ts", "event_id"),
                                   chunk=chunk, hot_rows=0, probe_fraction=1.0)
    got = {r.event_id: (r.change_type, r.old_price) for r in got.collect()}
    assert got == want
    assert any(v[0] == "invalid" for v in want.values())


def test_baselines_equal_cache(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    rows = sorted(ev.collect(), key=lambda r: (r.ts, r.event_id))
    _, cache = state_machine([((r.user_id, r.event_type), r.value, r.event_id) for r in rows])
    got = changes.listing_baselines(ev, ("user_id", "event_type"), "value", ("ts", "event_id"))
    got = {(r.user_id, r.event_type): r.baseline_price for r in got.collect()}
    assert got == cache


def test_metrics_row(spark):
    prices = [100.0, 90.0, 95.0, 100.0, 120.0, 0.0, float("nan"), 119.0]
    m = changes.change_metrics(changes.classify_changes(events(spark, one_listing(prices)))).first()
    assert (m.events_processed, m.price_drops, m.price_increases, m.unchanged, m.new_listings,
            m.invalid_prices, m.price_changes) == (8, 3, 1, 1, 1, 2, 4)


def test_error_when_price_text_is_junk(spark):
    rows = [("ev1", "mock", "A", "1", "1", 10.0, T0, "a", "10"),
            ("ev1", "mock", "A", "1", "1", None, T0 + timedelta(hours=1), "b", "abc")]
    df = spark.createDataFrame(rows, SCHEMA + ", raw string")
    got = {r.listing_id: r.change_type
           for r in changes.classify_changes(df, raw_price="raw").collect()}
    assert got == {"a": "new", "b": "error"}


@pytest.mark.parametrize("chunk,hot_rows", [("second", 0), ("minute", 1000), ("day", 0),
                                            ("minute", 10 ** 9)])
@pytest.mark.parametrize("baseline", ["max", "previous"])
def test_hot_keys(spark, chunk, hot_rows, baseline):
    """Keyed by source only, each key holds about a fifth of all rows."""
    from conftest import SF_MID
    ev = spark.read.parquet(f"{SF_MID}/events.parquet").withColumn("value", F.col("value") - 10)
    rows = sorted(ev.select("event_type", "ts", "event_id", "value").collect(),
                  key=lambda r: (r.ts, r.event_id))
    if baseline == "max":
        want, _ = state_machine([(r.event_type, r.value, r.event_id) for r in rows])
    else:
        want, last = {}, {}
        for r in rows:
            if r.value is None or math.isnan(r.value) or r.value <= 0:
                want[r.event_id] = ("invalid", None)
                continue
            old = last.get(r.event_type)
            want[r.event_id] = ("new", None) if old is None else (
                ("drop" if r.value < old else "increase" if r.value > old else "same"), old)
            last[r.event_type] = r.value
    got = changes.classify_changes(ev, ("event_type",), "value", ("ts", "event_id"),
                                   baseline=baseline, chunk=chunk, hot_rows=hot_rows,
                                   probe_fraction=1.0 if hot_rows == 0 else 0.01)
    assert {r.event_id: (r.change_type, r.old_price) for r in got.collect()} == want


@pytest.mark.parametrize("hot_rows", [10 ** 9, 0])
@pytest.mark.parametrize("baseline", ["max", "previous"])
def test_seeded_second_half_equals_whole(spark, hot_rows, baseline):
    """Classifying the later rows with each listing's value from the earlier
    rows as seed gives the same answer as classifying everything."""
    from conftest import SF_MID
    from pricewatch.functions.columns import valid_price
    from pricewatch.operators.scan import SEED
    ev = spark.read.parquet(f"{SF_MID}/events.parquet").withColumn("value", F.col("value") - 10)
    keys, order = ("user_id", "event_type"), ("ts", "event_id")
    whole = changes.classify_changes(ev, keys, "value", order, baseline=baseline, hot_rows=hot_rows,
                                   probe_fraction=1.0 if hot_rows == 0 else 0.01)
    cut = F.col("ts") >= F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    early = ev.where(~cut & valid_price("value"))
    if baseline == "max":
        seed = early.groupBy(*keys).agg(F.max("value").alias(SEED))
    else:
        seed = early.groupBy(*keys).agg(F.max_by("value", F.struct(*order)).alias(SEED))
    late = changes.classify_changes(ev.where(cut), keys, "value", order, baseline=baseline,
                                    hot_rows=hot_rows, seed=seed,
                                    probe_fraction=1.0 if hot_rows == 0 else 0.01)
    want = {r.event_id: (r.change_type, r.old_price) for r in whole.where(cut).collect()}
    got = {r.event_id: (r.change_type, r.old_price) for r in late.collect()}
    assert got == want


@pytest.mark.parametrize("baseline", ["max", "previous"])
@pytest.mark.parametrize("spread", [0, 1, 50_000])
def test_one_minute_holds_a_listing(spark, spread, baseline):
    """All rows of a listing within a minute: cut by seconds or by points of
    time (``spread`` in microseconds), with a seed from before."""
    from pricewatch.operators import scan
    rows = [("x", T0 + timedelta(microseconds=i * spread), i, float((i * 7919) % 997)) for i in range(1000)]
    rows += [("y", T0 + timedelta(days=i), 5000 + i, float(i % 7)) for i in range(40)] + [(None, None, 6000, 3.0)]
    df = spark.createDataFrame(rows, "listing string, ts timestamp, rid long, price double")
    seed = spark.createDataFrame([("x", 500.0), (None, 4.0)], f"listing string, {scan.SEED} double")
    got, plain = (
        {r.rid: (r.change_type, r.old_price) for r in changes.classify_changes(
            df, ["listing"], "price", ["ts", "rid"], baseline=baseline, seed=seed, hot_rows=n).collect()}
        for n in (20, 10 ** 9))
    assert got == plain and got[0] == ("invalid", None) and got[1][1] == 500.0
    units = {r.listing: r[scan._UNIT] for r in scan.hot_keys(df, ["listing"], "ts", 20).collect()}
    assert units == {"x": "second" if spread == 50_000 else "microsecond", "y": "day"}
