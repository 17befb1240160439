"""The monitoring questions, as DataFrame operators over price history
(``event_id, source, price, timestamp, ...``), drop alerts and the event
dimension (``event_id, event_name, venue, event_date``).

Time windows take ``as_of`` (default: now) so results are reproducible; a
constant ``as_of`` folds into a literal and the filter is pushed into the
Parquet scan. Aggregates stay in Spark; nothing is pulled to the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewatch import fixed
from pricewatch.functions.columns import fmt_money, fmt_percent, fmt_time, trunc_time
from pricewatch.sources.dated import recent


def _for_event(df: DataFrame, event_id, key: str = "event_id") -> DataFrame:
    """Add the equality filter only when an event is chosen."""
    return df if event_id is None else df.where(F.col(key) == F.lit(event_id))


def recent_prices(history: DataFrame, events: DataFrame, hours: int = fixed.DEFAULT_HOURS,
                  as_of=None, event_id=None, limit: int = fixed.HISTORY_LIMIT,
                  cols: Sequence[str] = ("event_id", "section", "row", "seat", "price",
                                         "fees", "total_price", "source", "timestamp",
                                         "listing_id", "listing_url")) -> DataFrame:
    """Newest ``limit`` prices of the last ``hours`` joined to their event.
    The time filter is pushed down, the join keeps only matched events and
    the ordered limit runs as a top-k (no full sort)."""
    ph = _for_event(recent(history, "timestamp", hours, as_of), event_id)
    ev = events.select("event_id", "event_name", "venue")
    present = [c for c in cols if c in ph.columns]
    return (ph.select(*present).join(ev, "event_id", "inner")
            .orderBy(F.col("timestamp").desc(), F.col("listing_id").desc())
            .limit(limit))


def price_stats(history: DataFrame, hours: int = fixed.DEFAULT_HOURS, as_of=None,
                event_id=None) -> DataFrame:
    """Count, mean, min, max price and number of sources; empty input gives
    zeros, not nulls."""
    ph = _for_event(recent(history, "timestamp", hours, as_of), event_id)
    return ph.agg(
        F.count(F.lit(1)).alias("total_listings"),
        F.coalesce(F.avg("price"), F.lit(0.0)).alias("avg_price"),
        F.coalesce(F.min("price"), F.lit(0.0)).alias("min_price"),
        F.coalesce(F.max("price"), F.lit(0.0)).alias("max_price"),
        F.count_distinct("source").alias("num_sources"))


def recent_alerts(alerts: DataFrame, events: DataFrame, limit: int = fixed.ALERTS_LIMIT,
                  event_id=None) -> DataFrame:
    """Newest ``limit`` alerts with their event; an event filter applies to
    those ``limit`` rows, after the limit, as the dashboard does."""
    ev = events.select("event_id", "event_name", "venue")
    top = (alerts.join(ev, "event_id", "inner")
           .orderBy(F.col("alert_timestamp").desc(), F.col("listing_id").desc())
           .limit(limit))
    return _for_event(top, event_id)


def list_events(events: DataFrame) -> DataFrame:
    """Distinct events, newest event date first."""
    return (events.select("event_id", "event_name", "venue", "event_date").distinct()
            .orderBy(F.col("event_date").desc(), F.col("event_id")))


def event_lookup(events: DataFrame, event_id) -> DataFrame:
    return events.where(F.col("event_id") == F.lit(event_id))


def event_by_name(events: DataFrame, name: str) -> DataFrame:
    """The event chosen by name: the first match in newest-date order."""
    return (events.where(F.col("event_name") == F.lit(name))
            .orderBy(F.col("event_date").desc(), F.col("event_id")).limit(1))


def avg_price_by_time_source(history: DataFrame, unit: str | None = None) -> DataFrame:
    """Mean price per (time, source), ascending time. ``unit`` (e.g. ``hour``,
    ``day``) truncates the time first; None groups on the exact timestamp."""
    t = F.col("timestamp") if unit is None else trunc_time(history, unit, "timestamp")
    return (history.groupBy(t.alias("timestamp"), "source")
            .agg(F.avg("price").alias("avg_price"), F.count(F.lit(1)).alias("n"))
            .orderBy("timestamp", "source"))


def source_summary(history: DataFrame) -> DataFrame:
    return (history.groupBy("source")
            .agg(F.avg("price").alias("avg_price"), F.min("price").alias("min_price"),
                 F.max("price").alias("max_price")))


def price_histogram(history: DataFrame, bins: int = fixed.HISTOGRAM_BINS, by: str = "source",
                    top_k: bool = False) -> DataFrame:
    """``bins`` equal-width bins between the overall min and max price, counted
    per ``by``; the maximum falls in the last bin, empty bins are omitted.

    Both bounds come from one scalar subquery (a single small aggregation,
    no join, no collect). It is projected once as a column, so the table is
    read once for the bounds and once for the counts. ``top_k`` says that the
    input is the result of an ordered limit, in one task anyway: the bounds are
    taken there, and its plan runs once."""
    both = F.struct(F.min("price").alias("lo"), F.max("price").alias("hi"))
    if top_k:
        whole = Window.partitionBy()
        bounds = F.struct(F.min("price").over(whole).alias("lo"), F.max("price").over(whole).alias("hi"))
    else:
        bounds = history.select(both.alias("b")).scalar()
    lo, hi = F.col("_b.lo"), F.col("_b.hi")
    pos = F.try_divide(F.col("price") - lo, hi - lo) * bins
    b = F.least(F.coalesce(F.floor(pos) + 1, F.lit(1)), F.lit(bins)).cast("long")
    counted = (history.where(F.col("price").isNotNull())
               .select(by, "price", bounds.alias("_b"))
               .groupBy(F.col(by), b.alias("bin"), F.col("_b"))
               .agg(F.count(F.lit(1)).alias("n")))
    width = (hi - lo) / bins
    return counted.select(by, "bin", (lo + (F.col("bin") - 1) * width).alias("bin_start"),
                          (lo + F.col("bin") * width).alias("bin_end"), "n")


def alerts_per_hour(alerts: DataFrame, ts: str = "alert_timestamp",
                    limit: int | None = None) -> DataFrame:
    """Alerts per hour. With ``limit``, only the newest ``limit`` alerts are
    counted (the dashboard charts the 20 it lists)."""
    if limit is not None:
        alerts = alerts.orderBy(F.col(ts).desc(), F.col("listing_id").desc()).limit(limit)
    return (alerts.groupBy(trunc_time(alerts, "hour", ts).alias("hour"))
            .agg(F.count(F.lit(1)).alias("alerts")).orderBy("hour"))


def top_events_by_prices(history: DataFrame, events: DataFrame, k: int = fixed.TOP_EVENTS) -> DataFrame:
    """Events with the most stored prices: count, min and max price. The
    aggregation runs before the join, so the join sees one row per event."""
    per_event = history.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("price_count"), F.min("price").alias("min_price"),
        F.max("price").alias("max_price"))
    named = per_event.join(events.select("event_id", "event_name"), "event_id")
    per_name = named.groupBy("event_name").agg(
        F.sum("price_count").alias("price_count"), F.min("min_price").alias("min_price"),
        F.max("max_price").alias("max_price"))
    return per_name.orderBy(F.col("price_count").desc(), F.col("event_name")).limit(k)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, one row each."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def latest_update(history: DataFrame) -> DataFrame:
    return history.agg(F.max("timestamp").alias("latest_update"))


def cheapest_per_event(history: DataFrame, k: int = fixed.CHEAPEST_PER_EVENT, key: str = "event_id",
                       tie: str = "listing_id") -> DataFrame:
    """The ``k`` cheapest listings of every event. Spark inserts a partial
    window-group limit before the shuffle, so each map task forwards at most
    ``k`` rows per event and a hot event is cut down early."""
    w = Window.partitionBy(key).orderBy(F.col("price").asc(), F.col(tie).asc())
    return (history.where(F.col("price").isNotNull())
            .withColumn("price_rank", F.row_number().over(w))
            .where(F.col("price_rank") <= k))


def alerts_display(alerts: DataFrame) -> DataFrame:
    """Alerts as the dashboard shows them: chosen columns, money as
    ``$x.xx``, percent as ``x.x%``, time as text."""
    return alerts.select(
        F.col("event_name").alias("Event"), F.col("venue").alias("Venue"),
        F.col("section").alias("Section"), F.col("row").alias("Row"),
        F.col("seat").alias("Seat"),
        fmt_money("old_price").alias("Old Price"), fmt_money("new_price").alias("New Price"),
        fmt_money("drop_amount").alias("Drop ($)"), fmt_percent("drop_percent").alias("Drop (%)"),
        F.col("source").alias("Source"), fmt_time("alert_timestamp").alias("Time"))
