"""Property tests: random price sequences against a row-by-row state machine."""

import math
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pricewatch.operators import changes
from pricewatch.streaming.detector import classify_rows

PRICES = st.one_of(st.sampled_from([0.0, -5.0, float("nan"), 10.0, 20.0]),
                   st.floats(min_value=0.01, max_value=500, allow_nan=False).map(lambda x: round(x, 2)),
                   st.none())
ROWS = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 40), PRICES), min_size=1, max_size=40)


def machine(rows):
    """rows: (listing, tie, price) in time order -> {tie: (kind, old)}."""
    cache, out = {}, {}
    for key, rid, price in rows:
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
    return out


def _events(draw_rows):
    t0 = datetime(2024, 1, 1)
    rows = []
    for i, (listing, minute, price) in enumerate(draw_rows):
        rows.append((f"L{listing}", t0 + timedelta(minutes=minute), i, price))
    return rows


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS, st.sampled_from([10 ** 9, 0]))
def test_batch_detector_matches_machine(spark, drawn, hot_rows):
    rows = _events(drawn)
    ordered = sorted(rows, key=lambda r: (r[1], r[2]))
    want = machine([(r[0], r[2], r[3]) for r in ordered])
    df = spark.createDataFrame(rows, "listing string, ts timestamp, rid long, price double")
    got = changes.classify_changes(df, ["listing"], "price", ["ts", "rid"], hot_rows=hot_rows,
                                   probe_fraction=1.0 if hot_rows == 0 else 0.01)
    assert {r.rid: (r.change_type, r.old_price) for r in got.collect()} == want


@settings(max_examples=300, deadline=None)
@given(st.lists(PRICES, min_size=1, max_size=60), st.integers(0, 60))
def test_stream_kernel_split_anywhere(prices, cut):
    """The numpy kernel over two micro-batches (state carried) equals the
    state machine over the whole sequence."""
    want = machine([("k", i, p) for i, p in enumerate(prices)])
    cut = min(cut, len(prices))
    got, baseline = {}, None
    for lo, hi in ((0, cut), (cut, len(prices))):
        if lo == hi:
            continue
        pdf = pd.DataFrame({"price": pd.array(prices[lo:hi], dtype="Float64")})
        old, kind, new = classify_rows(pdf, "price", baseline)
        baseline = new if new is not None else baseline
        for j in range(hi - lo):
            o = old[j]
            got[lo + j] = (kind[j], None if np.isnan(o) else float(o))
    assert got == want


def ewma_loop(values, alpha=0.1):
    m = 0.0
    for x in values:
        m = x if m == 0 else (1 - alpha) * m + alpha * x
    return m


EWMA_ROWS = st.lists(st.tuples(st.integers(0, 1), st.integers(0, 300),
                               st.one_of(st.just(0.0), st.floats(0.01, 1000, allow_nan=False))),
                     min_size=1, max_size=50)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(EWMA_ROWS)
def test_ewma_matches_loop(spark, drawn):
    from pricewatch.operators import metrics
    t0 = datetime(2024, 1, 1)
    rows = [(f"s{g}", t0 + timedelta(seconds=20 * sec), i, x) for i, (g, sec, x) in enumerate(drawn)]
    want = {}
    for g in {r[0] for r in rows}:
        series = [r[3] for r in sorted(rows, key=lambda r: (r[1], r[2])) if r[0] == g]
        want[g] = ewma_loop(series)
    df = spark.createDataFrame(rows, "source string, t timestamp, i long, x double")
    got = {r.source: r.ewma for r in metrics.ewma(df, ["source"], ["t", "i"], "x").collect()}
    assert got.keys() == want.keys()
    for g in want:
        assert math.isclose(got[g], want[g], rel_tol=1e-9, abs_tol=1e-9)


PRICE_ROWS = st.lists(st.tuples(st.sampled_from(["e1", "e2"]), st.sampled_from(["101", "102", None]),
                                st.sampled_from(["1", "5", "12", "A", None]),
                                st.floats(1, 200, allow_nan=False).map(lambda x: round(x, 2))),
                      min_size=1, max_size=25)
RULES = st.lists(st.tuples(st.sampled_from(["e1", "e2"]), st.floats(1, 200, allow_nan=False)
                           .map(lambda x: round(x, 2)), st.sampled_from(["101", "102", None]),
                           st.sampled_from([None, 3, 10]), st.booleans()), min_size=1, max_size=6)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(PRICE_ROWS, RULES)
def test_best_offers_equal_cheapest_match(spark, prices, rules):
    from pricewatch.operators import thresholds
    t0 = datetime(2024, 1, 1)
    p = spark.createDataFrame(
        [(e, price, "m", sec, row, "1", f"l{i:03d}", None, t0) for i, (e, sec, row, price) in enumerate(prices)],
        "event_id string, price double, source string, section string, row string, seat string, "
        "listing_id string, listing_url string, timestamp timestamp")
    r = spark.createDataFrame([(i, e, t, s, m, a) for i, (e, t, s, m, a) in enumerate(rules)],
                              "id long, event_id string, target_price double, section string, "
                              "max_row int, active boolean")
    pairs = thresholds.match_thresholds(p, r).collect()
    want = {}
    for row in pairs:
        cand = (float(row.price), row.listing_id)
        if row.alert_id not in want or cand < want[row.alert_id]:
            want[row.alert_id] = cand
    got = {row.alert_id: (float(row.price), row.listing_id)
           for row in thresholds.best_offers(p, r).collect()}
    assert got == want
