"""The drop detector as a stateful Structured Streaming query.

State is the baseline (the highest valid price seen so far) of every
listing. A running ``max().over()`` is not allowed on a stream, hence the
state. Within a micro-batch a listing's rows are sorted by (time, tie) and
scanned with numpy; across micro-batches arrival order stands, so a late
record is compared with the baseline it finds. The classification equals the
batch form in ``operators.changes`` when records arrive in time order.

By default the stream is grouped by listing: a group's state is one number
and its rows in a micro-batch are bounded by the trigger size
(``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``), and the Python calls,
one per touched listing per micro-batch, spread over all executors.

``buckets=n`` groups listings by a hash of their key instead, and one call
handles a whole bucket with vectorised pandas, which saves Python calls on
streams with few listings and many updates. The bucket state holds
(listing, baseline, last seen) arrays; listings are told apart by the exact
JSON of their key, so a hash collision only places two listings in one
bucket. A bucket's state grows with its listings, so use it with
``listing_ttl`` or a known listing population (about a thousand listings per
bucket), and keep ``n`` fixed for the life of a checkpoint.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pricewatch.operators.changes import EVENT_ORDER, LISTING_KEYS

# The state function runs in Python workers. Shipping this module by value
# means executors need numpy, pandas and pyspark only, not this package.
try:
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # older cloudpickle: ship the package instead
    pass

ADDED = [
    T.StructField("old_price", T.DoubleType()),
    T.StructField("change_type", T.StringType()),
    T.StructField("price_change", T.DoubleType()),
    T.StructField("change_percent", T.DoubleType()),
]
STATE = T.StructType([T.StructField("baseline", T.DoubleType())])
BUCKET_STATE = T.StructType([
    T.StructField("listings", T.ArrayType(T.StringType())),
    T.StructField("baselines", T.ArrayType(T.DoubleType())),
    T.StructField("last_seen", T.ArrayType(T.DoubleType())),
])
_LK, _BUCKET = "_pw_listing", "_pw_bucket"


def classify_rows(pdf: pd.DataFrame, price: str, baseline: float | None):
    """Classify time-ordered rows of one listing given the baseline before
    them. Returns (old_price, change_type, new baseline) as arrays."""
    p = pdf[price].to_numpy(dtype="float64", na_value=np.nan)
    valid = ~np.isnan(p) & (p > 0)
    vp = np.where(valid, p, -np.inf)
    start = -np.inf if baseline is None else baseline
    running = np.maximum.accumulate(np.concatenate(([start], vp)))
    before = running[:-1]
    kind, old = _kinds(p, valid, before)
    end = running[-1]
    return old, kind, (None if end == -np.inf else float(end))


def _kinds(p, valid, before):
    has_base = before > -np.inf
    kind = np.where(~valid, "invalid",
                    np.where(~has_base, "new",
                             np.where(p < before, "drop",
                                      np.where(p > before, "increase", "same"))))
    return kind, np.where(valid & has_base, before, np.nan)


def _finish(pdf, price, old, kind, raw_price):
    if raw_price is not None:
        raw = pdf[raw_price]
        number = pd.to_numeric(raw, errors="coerce").notna() | raw.astype(str).str.strip().str.lower().eq("nan")
        bad = (raw.notna() & ~number).to_numpy()
        kind = np.where(bad, "error", kind)
    changed = np.isin(kind, ["drop", "increase"])
    p = pdf[price].to_numpy(dtype="float64", na_value=np.nan)
    delta = np.where(changed, p - old, np.nan)
    pdf["old_price"] = old
    pdf["change_type"] = kind
    pdf["price_change"] = delta
    with np.errstate(divide="ignore", invalid="ignore"):
        pdf["change_percent"] = np.where(changed, delta / old * 100, np.nan)
    return pdf


def _listing_fn(price, order, out_cols, raw_price):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        pdf = pd.concat(list(pdfs), ignore_index=True)
        if pdf.empty:
            return
        pdf = pdf.sort_values(order, kind="mergesort", na_position="first").reset_index(drop=True)
        old, kind, new_base = classify_rows(pdf, price, state.get[0] if state.exists else None)
        if new_base is not None:
            state.update((new_base,))
        yield _finish(pdf, price, old, kind, raw_price)[out_cols]
    return fn


def _bucket_fn(price, order, out_cols, raw_price, ttl_seconds):
    ts = order[0]

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState):
        pdf = pd.concat(list(pdfs), ignore_index=True)
        if pdf.empty:
            return
        pdf = pdf.sort_values([_LK] + order, kind="mergesort",
                              na_position="first").reset_index(drop=True)
        if state.exists:
            names, bases, seen = state.get
            prior = pd.Series(bases, index=names, dtype="float64")
            last = pd.Series(seen, index=names, dtype="float64")
        else:
            prior = pd.Series(dtype="float64")
            last = pd.Series(dtype="float64")
        p = pdf[price].to_numpy(dtype="float64", na_value=np.nan)
        valid = ~np.isnan(p) & (p > 0)
        vp = pd.Series(np.where(valid, p, -np.inf))
        groups = pdf[_LK]
        # max of the earlier rows of the same listing in this batch ...
        earlier = vp.groupby(groups).cummax().groupby(groups).shift(1).fillna(-np.inf)
        # ... and the baseline the listing had before the batch
        start = groups.map(prior).fillna(-np.inf).to_numpy()
        before = np.maximum(start, earlier.to_numpy())
        kind, old = _kinds(p, valid, before)
        # new state: every listing's highest valid price, and when it was seen
        batch_max = vp.groupby(groups).max()
        merged = pd.concat([prior, batch_max], axis=1).max(axis=1)
        times = pd.to_datetime(pdf[ts]).astype("int64").to_numpy() / 1e9 \
            if ts in pdf else np.zeros(len(pdf))
        seen_now = pd.Series(times).groupby(groups).max()
        merged_seen = pd.concat([last, seen_now], axis=1).max(axis=1)
        keep = merged > -np.inf
        if ttl_seconds is not None and len(merged_seen):
            keep &= merged_seen >= merged_seen.max() - ttl_seconds
        merged, merged_seen = merged[keep], merged_seen[keep]
        if len(merged):
            state.update((list(merged.index), merged.tolist(), merged_seen.tolist()))
        elif state.exists:
            state.remove()
        yield _finish(pdf, price, old, kind, raw_price)[out_cols]
    return fn


try:
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor
except ImportError:  # Spark before 4.0
    StatefulProcessor = object


class ListingDetector(StatefulProcessor):
    """The detector for ``transformWithStateInPandas``: per listing, a value
    state holding the baseline (with an optional time-to-live)."""

    def __init__(self, price, order, out_cols, raw_price=None, ttl_ms=None, in_cols=None):
        self.price, self.order, self.out_cols = price, list(order), out_cols
        self.raw_price, self.ttl_ms, self.in_cols = raw_price, ttl_ms, in_cols

    def init(self, handle) -> None:
        self.base = handle.getValueState("baseline", STATE, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True)
        if pdf.empty:
            return
        if self.in_cols is not None and len(self.in_cols) == len(pdf.columns):
            pdf.columns = self.in_cols    # names with a leading "_" arrive positional
        pdf = pdf.sort_values(self.order, kind="mergesort",
                              na_position="first").reset_index(drop=True)
        baseline = self.base.get()[0] if self.base.exists() else None
        old, kind, new_base = classify_rows(pdf, self.price, baseline)
        if new_base is not None:
            self.base.update((new_base,))
        yield _finish(pdf, self.price, old, kind, self.raw_price)[self.out_cols]

    def close(self) -> None:
        pass


def detect_changes_stream(stream: DataFrame, keys: Sequence[str] = LISTING_KEYS,
                          price: str = "price", order: Sequence[str] = EVENT_ORDER,
                          buckets: int | None = None, listing_ttl: str | None = None,
                          raw_price: str | None = None,
                          engine: str = "pandas_state") -> DataFrame:
    """Classify every record of a price-event stream (append mode).
    ``engine="transform"`` runs the per-listing form on
    ``transformWithStateInPandas`` (RocksDB state store required).

    ``order`` sorts rows of one listing within a micro-batch: scrape time and
    listing id by default; for Kafka input (kafka_timestamp, partition,
    offset). ``raw_price`` names the price as received (``from_wire`` keeps it
    as ``_raw_price``): text that is not a number is classified ``error``.
    ``listing_ttl`` (e.g. ``"30 days"``) forgets listings not seen for that
    long; by default state is kept for ever, as the semantics require."""
    order = list(order)
    out_schema = T.StructType(list(stream.schema.fields) + ADDED)
    out_cols = out_schema.fieldNames()
    if engine == "transform":
        # transformWithStateInPandas: less per-group overhead; needs the
        # RocksDB state store provider on the session.
        ttl_ms = None if listing_ttl is None else int(_seconds(listing_ttl) * 1000)
        proc = ListingDetector(price, order, out_cols, raw_price, ttl_ms, stream.columns)
        return stream.groupBy(*keys).transformWithStateInPandas(
            proc, out_schema, "Append", "None" if ttl_ms is None else "ProcessingTime")
    if buckets is None:
        fn = _listing_fn(price, order, out_cols, raw_price)
        timeout = GroupStateTimeout.NoTimeout
        if listing_ttl is not None:
            inner, timeout = fn, GroupStateTimeout.ProcessingTimeTimeout

            def fn(key, pdfs, state):  # noqa: F811
                yield from inner(key, pdfs, state)
                if not state.hasTimedOut:
                    state.setTimeoutDuration(listing_ttl)
        return stream.groupBy(*keys).applyInPandasWithState(fn, out_schema, STATE, "append",
                                                            timeout)
    ttl = None if listing_ttl is None else _seconds(listing_ttl)
    keyed = (stream.withColumn(_LK, F.to_json(F.struct(*[F.col(k) for k in keys])))
             .withColumn(_BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets))))
    fn = _bucket_fn(price, order, out_cols, raw_price, ttl)
    return keyed.groupBy(_BUCKET).applyInPandasWithState(
        fn, out_schema, BUCKET_STATE, "append", GroupStateTimeout.NoTimeout)


def _seconds(text: str) -> float:
    n, unit = text.split()
    unit = unit.rstrip("s")
    return float(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit]
