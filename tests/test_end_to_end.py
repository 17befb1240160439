"""Landed responses -> normalizer -> price-event JSON -> detector and storage
(independent queries) -> alerts -> alert store, checked against a state
machine over the same listings."""

import json
import os

from pyspark.sql import functions as F

from pricewatch.schemas import TRACKED_EVENT
from pricewatch.sources.feeds import read_price_events
from pricewatch.streaming import jobs

TRACKED = [("ev_a", "Alpha Tour", "North Stadium", "2025-05-15T19:00:00Z"),
           ("ev_b", "Beta Tour", "South Arena", "2025-06-20T20:00:00Z")]

# three polls: (event, listing id, section, row, seat, price)
POLLS = [
    [("ev_a", 1, "101", 5, 1, 100), ("ev_a", 2, "102", "A", 3, 80), ("ev_b", 3, "1", 1, 1, 50)],
    [("ev_a", 1, "101", 5, 1, 90), ("ev_a", 2, "102", "A", 3, 85), ("ev_b", 3, "1", 1, 1, 50),
     ("ev_b", 4, "2", 2, 2, 40)],
    [("ev_a", 1, "101", 5, 1, 95), ("ev_a", 2, "102", "A", 3, 70), ("ev_b", 3, "1", 1, 1, 0),
     ("ev_b", 4, "2", 2, 2, 30)],
]


def machine():
    cache, drops = {}, []
    for poll in POLLS:
        for ev, lid, sec, row, seat, price in poll:
            key = (ev, sec, str(row), str(seat))
            if price <= 0:
                continue
            if key in cache and price < cache[key]:
                drops.append((f"seatgeek_{lid}", cache[key], float(price)))
                continue
            cache[key] = max(cache.get(key, price), price)
    return drops


def test_end_to_end(spark, scratch):
    responses = os.path.join(scratch, "responses")
    os.makedirs(responses)
    tracked = spark.createDataFrame(TRACKED, TRACKED_EVENT)
    wire, ckpts = f"{scratch}/wire", f"{scratch}/ckpt"
    for i, poll in enumerate(POLLS):
        by_event = {}
        for ev, lid, sec, row, seat, price in poll:
            by_event.setdefault(ev, []).append(
                {"id": lid, "section": sec, "row": row, "seat_number": seat, "price": price})
        with open(os.path.join(responses, f"poll{i}.json"), "w") as fh:
            for ev, listings in by_event.items():
                fh.write(json.dumps({"event_id": ev, "listings": listings}) + "\n")
        # one poll per run: scrape times follow the polls
        jobs.start_normalizer(spark, responses, tracked, "seatgeek", wire, f"{scratch}/bad",
                              f"{ckpts}/normalizer").awaitTermination()

    def events():
        return read_price_events(spark, wire, stream=True)[0]

    jobs.start_detector(events(), f"{scratch}/processed", f"{scratch}/alerts",
                        f"{ckpts}/detector").awaitTermination()
    jobs.start_storage(events(), f"{scratch}/history", f"{scratch}/rejects",
                       f"{scratch}/dimension", f"{ckpts}/storage").awaitTermination()
    alerts_static = spark.read.parquet(f"{scratch}/alerts")
    alerts = spark.readStream.schema(alerts_static.schema).parquet(f"{scratch}/alerts")
    jobs.start_alert_store(alerts, f"{scratch}/stored", f"{scratch}/rejected",
                           f"{scratch}/outbox", f"{ckpts}/alerts",
                           dimension_path=f"{scratch}/dimension").awaitTermination()

    n_prices = sum(len(p) for p in POLLS)
    assert spark.read.parquet(f"{scratch}/history").count() == n_prices
    assert spark.read.parquet(f"{scratch}/processed").count() == n_prices
    got = sorted((r.listing_id, r.old_price, r.new_price) for r in alerts_static.collect())
    assert got == sorted(machine())
    stored = spark.read.parquet(f"{scratch}/stored")
    assert stored.count() == len(got)
    dim = {r.event_id: r.event_name for r in jobs.read_dimension(spark, f"{scratch}/dimension").collect()}
    assert dim == {"ev_a": "Alpha Tour", "ev_b": "Beta Tour"}
    assert spark.read.parquet(f"{scratch}/outbox").where(F.col("payload").contains("Alpha Tour")).count() > 0
