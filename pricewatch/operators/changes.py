"""Per-listing price-change detection in batch.

The baseline of a row is the **running maximum of the earlier valid prices of
its listing**: a drop never becomes the baseline, so a listing that stays
below its peak is reported as a drop on every update. The previous-price
comparison (``baseline="previous"``) is offered as a second mode.

change_type: ``new`` (no baseline yet), ``same``, ``drop``, ``increase``,
``invalid`` (price missing, NaN or <= 0; never changes the baseline) and
``error`` (price text present but not a number; only when ``raw_price`` is
given).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewatch import fixed
from pricewatch.functions.columns import valid_price
from pricewatch.operators.scan import prior_scan

# Price-event defaults: a listing is (event, source, section, row, seat),
# ordered by scrape time with the listing id as tie-break.
LISTING_KEYS = ("event_id", "source", "section", "row", "seat")
EVENT_ORDER = ("timestamp", "listing_id")


def classify_changes(df: DataFrame, keys: Sequence[str] = LISTING_KEYS, price: str = "price",
                     order: Sequence[str] = EVENT_ORDER, baseline: str = "max",
                     raw_price: str | None = None, chunk: str | None = None,
                     hot_rows: int = 1_000_000, seed: DataFrame | None = None,
                     probe_fraction: float | None = None) -> DataFrame:
    """Add ``old_price``, ``change_type``, ``price_change``, ``change_percent``.
    Listings with more than ``hot_rows`` rows are scanned in time chunks
    (see ``operators/scan.py``). ``seed`` (keys + ``_pw_seed``) is each
    listing's baseline from before ``df``, e.g. from earlier micro-batches."""
    order = list(order)
    ts = order[0]
    how = {"max": "max", "previous": "last"}[baseline]
    valid = valid_price(price)
    scanned = prior_scan(df, keys, order, F.when(valid, F.col(price)), "_pw_base", ts,
                         how=how, chunk=chunk, hot_rows=hot_rows, seed=seed,
                         probe_fraction=probe_fraction)
    p, base = F.col(price), F.col("_pw_base")
    kind = (F.when(~valid, F.lit("invalid"))
            .when(base.isNull(), F.lit("new"))
            .when(p < base, F.lit("drop"))
            .when(p > base, F.lit("increase"))
            .otherwise(F.lit("same")))
    if raw_price is not None:
        bad_text = F.col(raw_price).isNotNull() & F.col(raw_price).try_cast("double").isNull()
        kind = F.when(bad_text, F.lit("error")).otherwise(kind)
    changed = F.col("change_type").isin("drop", "increase")
    delta = p - F.col("old_price")
    return (scanned
            .withColumn("change_type", kind)
            .withColumn("old_price", F.when(F.col("change_type").isin("new", "invalid", "error"),
                                            F.lit(None).cast("double")).otherwise(base))
            .withColumn("price_change", F.when(changed, delta))
            .withColumn("change_percent", F.when(changed, delta / F.col("old_price") * 100))
            .drop("_pw_base"))


def drop_alerts(classified: DataFrame, price: str = "price",
                alert_time: Column | None = None) -> DataFrame:
    """Rows whose price fell below the baseline, enriched the way an alert is:
    every input column plus old/new price, drop amount and percent, alert
    time (processing time unless given) and type."""
    return (classified.where(F.col("change_type") == "drop")
            .withColumns({
                "new_price": F.col(price),
                "drop_amount": F.col("old_price") - F.col(price),
                "drop_percent": F.abs(F.col("change_percent")),
                "alert_timestamp": alert_time if alert_time is not None else F.current_timestamp(),
                "alert_type": F.lit(fixed.ALERT_TYPE),
            }))


def price_changes(classified: DataFrame) -> DataFrame:
    """Only the rows whose price differs from the baseline."""
    return classified.where(F.col("change_type").isin("drop", "increase"))


def new_listings(classified: DataFrame) -> DataFrame:
    """First valid sighting of each listing."""
    return classified.where(F.col("change_type") == "new")


def change_metrics(classified: DataFrame) -> DataFrame:
    """The detector's counters as one row (batch form of its metrics)."""
    t = F.col("change_type")
    return classified.agg(
        F.count(F.lit(1)).alias("events_processed"),
        F.count_if(t.isin("drop", "increase")).alias("price_changes"),
        F.count_if(t == "drop").alias("price_drops"),
        F.count_if(t == "increase").alias("price_increases"),
        F.count_if(t == "same").alias("unchanged"),
        F.count_if(t == "new").alias("new_listings"),
        F.count_if(t == "invalid").alias("invalid_prices"),
        F.count_if(t == "error").alias("errors"),
    )


def listing_baselines(df: DataFrame, keys: Sequence[str] = LISTING_KEYS, price: str = "price",
                      order: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """What the detector holds per listing after all rows: the baseline price
    and the time and id of the last row that set or refreshed it.

    A row refreshes the baseline when its price is >= every earlier valid
    price, so the last such row is the latest row carrying the listing's
    maximum price. That is one ``max(struct(price, order...))`` per key, an
    aggregation that combines map-side, so no window and no skew."""
    order = list(order)
    best = F.max(F.struct(F.col(price).alias("p"), *[F.col(c) for c in order])).alias("_b")
    return (df.where(valid_price(price)).groupBy(*keys).agg(best)
            .select(*keys, F.col("_b.p").alias("baseline_price"),
                    *[F.col(f"_b.{c}").alias(f"baseline_{c}") for c in order]))
