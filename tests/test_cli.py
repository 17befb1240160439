"""The command line runs the processes in order on landed files."""

import json
import os

from pricewatch.__main__ import main


def test_cli_flow(spark, scratch):
    responses = os.path.join(scratch, "responses")
    os.makedirs(responses)
    with open(os.path.join(responses, "poll0.json"), "w") as fh:
        fh.write(json.dumps({"event_id": "ev_a", "listings": [
            {"id": 1, "section": "101", "row": 5, "seat_number": 1, "price": 100},
            {"id": 2, "section": "102", "row": 1, "seat_number": 2, "price": "abc"}]}) + "\n")
    with open(os.path.join(responses, "poll1.json"), "w") as fh:
        fh.write(json.dumps({"event_id": "ev_a", "listings": [
            {"id": 1, "section": "101", "row": 5, "seat_number": 1, "price": 80}]}) + "\n")
    tracked = os.path.join(scratch, "tracked.json")
    with open(tracked, "w") as fh:
        fh.write(json.dumps({"event_id": "ev_a", "name": "Alpha", "venue": "North",
                             "date": "2025-05-15T19:00:00Z"}) + "\n")
    out = os.path.join(scratch, "out")
    assert main(["normalize", "--responses", responses, "--tracked", tracked, "--out", out,
                 "--max-files", "1"]) == 0
    events = f"{out}/price_events"
    assert main(["detect", "--events", events, "--out", out, "--state-table"]) == 0
    assert main(["store", "--events", events, "--out", out]) == 0
    assert main(["alerts", "--alerts", f"{out}/price_alerts", "--dimension", f"{out}/events",
                 "--out", out]) == 0
    assert main(["compact", "--out", out]) == 0
    alerts = spark.read.parquet(f"{out}/price_drop_alerts").collect()
    assert [(r.listing_id, float(r.old_price), float(r.new_price)) for r in alerts] == \
        [("seatgeek_1", 100.0, 80.0)]
    assert spark.read.parquet(f"{out}/listing_rejects").count() == 1
    assert spark.read.parquet(f"{out}/price_history").count() == 2
    assert spark.read.parquet(f"{out}/notification_outbox").count() == 1

    assert main(["report", "--store", out, "--out", f"{scratch}/report", "--event", "Alpha",
                 "--as-of", "2100-01-01 00:00:00", "--hours", "1000000"]) == 0
    stats = spark.read.json(f"{scratch}/report/status").collect()
    assert {r.table_name: r.row_count for r in stats} == \
        {"tracked_events": 1, "price_history": 2, "price_drop_alerts": 1}
    shown = spark.read.json(f"{scratch}/report/recent_alerts").collect()
    assert [(r["Old Price"], r["New Price"], r["Drop (%)"]) for r in shown] == \
        [("$100.00", "$80.00", "20.0%")]
    assert spark.read.json(f"{scratch}/report/recent_prices").count() == 2
