"""Listing normalisation, typed history, rejects, dimension, dedup."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from pricewatch.operators import history, normalize, validate
from pricewatch.schemas import RAW_RESPONSE, TRACKED_EVENT

TRACKED = [("ev_alpha", "Alpha Tour", "North Stadium", "2025-05-15T19:00:00Z"),
           ("ev_beta", "Beta Tour", "South Arena", "not a date")]


def responses(spark, listings, event_id="ev_alpha"):
    line = json.dumps({"event_id": event_id, "listings": listings})
    raw = spark.read.schema(RAW_RESPONSE).json(spark.sparkContext.parallelize([line]))
    return normalize.explode_listings(raw)


def tracked(spark):
    return spark.createDataFrame(TRACKED, TRACKED_EVENT)


def parse(spark, listings, source="seatgeek", event_id="ev_alpha"):
    good, rejects = normalize.ADAPTERS[source](responses(spark, listings, event_id), tracked(spark),
                                               scrape_time=F.lit(datetime(2025, 1, 1, 10)))
    return {r.listing_id: r for r in good.collect()}, rejects.collect()


def test_listing_cases(spark):
    good, rejects = parse(spark, [
        {"id": "1", "section": "101", "row": 5, "seat_number": "8-9", "price": 100.0},
        {"id": 2, "section": "102", "row": "A", "price": "50.5", "fees": {"total": 0}},
        {"id": "3", "price": 80, "fees": {"total": 12.5}},
        {"id": "4", "price": 80, "fees": {"total": 12.5}, "total_price": 99},
        {"id": "5", "price": "abc"},
    ])
    a = good["seatgeek_1"]
    assert (a.price, a.fees, a.total_price, a.row, a.seat, a.quantity, a.delivery_method) == \
        (100.0, None, 100.0, "5", "8-9", 1, "unknown")
    assert (a.event_name, a.venue, a.event_date) == ("Alpha Tour", "North Stadium",
                                                     datetime(2025, 5, 15, 19, 0))
    b = good["seatgeek_2"]
    assert (b.price, b.fees, b.row, b.seat) == (50.5, None, "A", "Unknown")
    c = good["seatgeek_3"]
    assert (c.section, c.fees, c.total_price) == ("Unknown", 12.5, 92.5)
    assert good["seatgeek_4"].total_price == 99.0
    assert [r.reject_reason for r in rejects] == ["bad_number"]
    assert rejects[0].listing_id == "seatgeek_5"


def test_mock_defaults_and_bad_date(spark):
    good, _ = parse(spark, [{"id": "9", "price": 10}], source="mock", event_id="ev_beta")
    r = good["mock_9"]
    assert r.delivery_method == "mobile" and r.source == "mock"
    assert r.event_date > datetime(2025, 1, 1)      # fallback: now + 30 days


def test_untracked_event_rejected(spark):
    good, rejects = parse(spark, [{"id": "1", "price": 10}], event_id="ev_gamma")
    assert not good and [r.reject_reason for r in rejects] == ["untracked_event"]


def price_events(spark, rows):
    cols = ("event_id string, source string, section string, row string, seat string, "
            "price double, fees double, total_price double, timestamp timestamp, "
            "listing_id string, listing_url string, quantity int")
    return spark.createDataFrame(rows, cols)


def test_history_rejects_and_totals(spark):
    t = datetime(2025, 1, 1)
    rows = [
        ("ev1", "mock", "A" * 50, "1", "1", 10.0, 0.0, None, t, "l1", None, None),
        ("ev1", "mock", "A" * 51, "1", "1", 10.0, None, None, t, "l2", None, None),
        ("ev1", "mock", "A", "1", "1", 100000000.0, None, None, t, "l3", None, None),
        (None, "mock", "A", "1", "1", 10.0, None, None, t, "l4", None, None),
        ("ev1", None, "A", "1", "1", -5.0, 2.0, 12.0, t, None, "u", 2),
    ]
    df = price_events(spark, rows)
    good, rejects = history.ingest(df, ingest_time=F.lit(t))
    assert good.count() + rejects.count() == df.count()
    reasons = {r.listing_id: r.reject_reason for r in rejects.collect()}
    assert reasons == {"l2": "too_long_section", "l3": "out_of_range_price", "l4": "null_event_id"}
    g = {r.listing_id: r for r in good.collect()}
    assert g["l1"].fees is None and float(g["l1"].total_price) == 10.0
    last = g[""]
    assert (last.source, float(last.price), float(last.fees), last.quantity, last.listing_url) == \
        ("unknown", -5.0, 2.0, 2, "u")


def test_foreign_key_split(spark):
    t = datetime(2025, 1, 1)
    df = price_events(spark, [("ev1", "m", None, None, None, 1.0, None, None, t, "a", None, None),
                              ("ev2", "m", None, None, None, 1.0, None, None, t, "b", None, None)])
    dim = spark.createDataFrame([("ev1",)], "event_id string")
    good, rejects = history.ingest(df, dimension=dim)
    assert [r.listing_id for r in good.collect()] == ["a"]
    assert [(r.listing_id, r.reject_reason) for r in rejects.collect()] == [("b", "unknown_event")]


def test_dimension_first_name_wins_and_merge(spark):
    cols = "event_id string, event_name string, venue string, event_date timestamp, " \
           "timestamp timestamp, listing_id string"
    d = datetime(2025, 5, 1)
    b1 = spark.createDataFrame([("e1", "First", "V", d, datetime(2025, 1, 1, 10), "a"),
                                ("e1", "Renamed", "V", d, datetime(2025, 1, 1, 11), "b")], cols)
    dim1 = history.event_dimension(b1)
    r = dim1.first()
    assert (r.event_name, r.created_at, r.last_updated) == \
        ("First", datetime(2025, 1, 1, 10), datetime(2025, 1, 1, 11))
    b2 = spark.createDataFrame([("e1", "Other", "W", d, datetime(2025, 1, 2), "c"),
                                ("e2", "New", "X", d, datetime(2025, 1, 2), "d")], cols)
    merged = {r.event_id: r for r in history.merge_dimension(dim1, history.event_dimension(b2)).collect()}
    assert merged["e1"].event_name == "First" and merged["e1"].venue == "V"
    assert merged["e1"].last_updated == datetime(2025, 1, 2)
    assert merged["e1"].created_at == datetime(2025, 1, 1, 10)
    assert merged["e2"].event_name == "New"
    new = history.new_events(b2, dim1)
    assert [r.event_id for r in new.collect()] == ["e2"]


def test_dedup(spark):
    t = datetime(2025, 1, 1)
    df = price_events(spark, [("e", "m", None, None, None, 1.0, None, None, t, "a", None, None)] * 3)
    assert validate.dedup(df).count() == 1


def test_wire_roundtrip_and_malformed(spark):
    t = datetime(2025, 1, 1, 9, 30)
    df = price_events(spark, [("e1", "m", "A", "1", "2", 12.5, None, 12.5, t, "x", None, 1)])
    wire = normalize.to_wire(df)
    text = wire.first().value
    assert '"fees":null' in text and '"timestamp":"2025-01-01T09:30:00"' in text
    junk = spark.createDataFrame([("not json",), ('{"event_id": null}',),
                                  ('{"event_id": "e2", "price": "7.25"}',)], "value string")
    good, rejects = normalize.from_wire(wire.select("value").unionByName(junk))
    back = {r.event_id: r for r in good.collect()}
    assert back["e1"].price == 12.5 and back["e1"].timestamp == t
    assert back["e2"].price == 7.25
    assert sorted(r.reject_reason for r in rejects.collect()) == ["malformed_json", "null_event_id"]


def test_junk_numbers_are_rejects_not_zeros(spark):
    from pricewatch.operators import history, normalize
    good = '"event_id":"e","source":"s","timestamp":"2025-01-01T00:00:00Z"'
    wire = spark.createDataFrame([
        ('{%s,"price":"abc"}' % good,), ('{%s,"price":"5","fees":"x"}' % good,),
        ('{%s,"price":"5","quantity":"many"}' % good,), ('{%s,"price":"5","quantity":"2.7"}' % good,),
        ('{%s,"price":"5","quantity":"1e12"}' % good,), ('{%s}' % good,)], "value string")
    events, _ = normalize.from_wire(wire)
    stored, rejects = history.ingest(events)
    assert sorted((float(r.price), r.quantity) for r in stored.collect()) == [(0.0, 1), (5.0, 2)]
    assert [r.reject_reason for r in rejects.collect()] == ["bad_number"] * 4


def test_thresholds_ignore_invalid_prices(spark):
    from pricewatch.operators import thresholds
    cols = "event_id string, price double, source string, section string, row string, seat string, " \
           "listing_id string, listing_url string, timestamp string"
    prices = spark.createDataFrame([("e", p, "s", "A", "1", "1", str(p), "", "t") for p in (0.0, -5.0, 40.0)], cols)
    rules = spark.createDataFrame([(1, "e", 50.0, None, None, True)],
                                  "id int, event_id string, target_price double, section string, max_row int, active boolean")
    assert [float(r.price) for r in thresholds.match_thresholds(prices, rules).collect()] == [40.0]
    assert [float(r.price) for r in thresholds.best_offers(prices, rules).collect()] == [40.0]


def test_missing_time_is_the_ingest_time(spark):
    lines = ['{"event_id":"e1","price":10,"timestamp":"2024-01-01T00:00:00"}',
             '{"event_id":"e2","price":10,"timestamp":"soon"}', '{"event_id":"e3","price":10}']
    events, _ = normalize.from_wire(spark.createDataFrame([(x,) for x in lines], "value string"))
    at = F.lit("2024-05-05 05:00:00").cast("timestamp")
    good, rejects = history.ingest(events, ingest_time=at)
    got = {r.event_id: r.t for r in good.select("event_id", F.col("timestamp").cast("string").alias("t")).collect()}
    assert got == {"e1": "2024-01-01 00:00:00", "e2": "2024-05-05 05:00:00", "e3": "2024-05-05 05:00:00"}
    assert rejects.count() == 0
