"""Ingest of price events into typed history, and the event dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewatch import fixed
from pricewatch.functions.columns import try_money
from pricewatch.operators import validate
from pricewatch.schemas import TEXT_LIMITS


def typed_history(events: DataFrame, ingest_time: Column | None = None,
                  keep_raw: bool = False, keep: Sequence[Column] = ()) -> DataFrame:
    """Price events to price-history rows, with the columns of ``keep``.

    Missing source is ``unknown``, missing ids and url are empty text, a
    missing or zero fee is null, a missing total is the price, a missing
    quantity is 1, a missing or unreadable time is the ingest time. Money is quantised to DECIMAL(10,2); a value that does not
    fit becomes null, which the range check turns into a reject. Prices <= 0
    are stored as they are: history keeps every observation."""
    created = ingest_time if ingest_time is not None else F.current_timestamp()
    price = F.coalesce(F.col("price"), F.lit(0.0))
    fees = F.when(F.col("fees").isNotNull() & (F.col("fees") != 0), F.col("fees"))
    total = F.coalesce(F.col("total_price"), price)
    out = events.select(
        F.col("event_id"),
        F.coalesce(F.col("source"), F.lit(fixed.UNKNOWN_SOURCE)).alias("source"),
        "section", "row", "seat",
        try_money(price).alias("price"),
        try_money(fees).alias("fees"),
        try_money(total).alias("total_price"),
        F.coalesce("timestamp", created.cast(events.schema["timestamp"].dataType)).alias("timestamp"),
        F.coalesce(F.col("listing_id").cast("string"), F.lit("")).alias("listing_id"),
        F.coalesce(F.col("listing_url"), F.lit("")).alias("listing_url"),
        F.coalesce(F.col("quantity"), F.lit(1)).cast("int").alias("quantity"),
        created.alias("created_at"),
        price.alias("_raw_price"), fees.alias("_raw_fees"), total.alias("_raw_total_price"),
        (F.col("_bad_number") if "_bad_number" in events.columns else F.lit(False)).alias("_bad_number"),
        *keep,
    )
    return out if keep_raw else out.drop(*RAW)


# Columns that the checks read and the store doesn't keep.
RAW = ("_raw_price", "_raw_fees", "_raw_total_price", "_bad_number")


# Attributes of an event that its price records carry.
EVENT_ATTRS = ("event_name", "venue", "event_date")


def tag_events(events: DataFrame, ingest_time: Column | None = None, also: Sequence[str] = ()) -> DataFrame:
    """Price records as typed history rows that also carry their event's
    attributes and the columns ``also``, with ``reject_reasons`` (all broken constraints, of the history
    and of the event) and ``reject_reason`` (the first).

    A missing name or venue is empty text, a missing event date the ingest
    time: the event is stored with these. Text too long for the events table
    rejects the record, as the event can't be stored. Records of
    ``normalize.tagged_wire`` bring their own reason, which comes first, and
    their text (``_raw``, null for good rows)."""
    from pricewatch.operators.normalize import WIRE_REASON
    created = ingest_time if ingest_time is not None else F.current_timestamp()
    wire = F.col(WIRE_REASON) if WIRE_REASON in events.columns else F.lit(None).cast("string")
    raw = F.col("_raw") if "_raw" in events.columns else F.lit(None).cast("string")
    attrs = {"event_name": F.coalesce("event_name", F.lit("")), "venue": F.coalesce("venue", F.lit("")),
             "event_date": F.coalesce(F.col("event_date").cast("timestamp"), created)}
    keep = [*(v.alias(k) for k, v in attrs.items()), wire.alias("_wire"), raw.alias("_raw"),
            *map(F.col, also)]
    rows = typed_history(events, created, keep_raw=True, keep=keep)
    checks = validate.history_checks(rows.columns)
    limits = {c: n for c, n in TEXT_LIMITS["events"].items() if c in EVENT_ATTRS}
    checks += validate.length_checks(limits, rows.columns)
    found = validate.reasons_column(checks)
    reasons = F.when(F.col("_wire").isNull(), found).otherwise(F.array("_wire"))
    tagged = rows.withColumn(validate.REASONS, reasons) \
        .withColumn(validate.REASON, F.get(validate.REASONS, F.lit(0)))
    return tagged.withColumn("_raw", F.when(F.col(validate.REASON).isNotNull(), F.col("_raw"))) \
        .drop(*RAW, "_wire")


def tag_history(events: DataFrame, ingest_time: Column | None = None) -> DataFrame:
    """Typed history rows, each with ``reject_reason`` (null when the row
    meets every constraint)."""
    typed = typed_history(events, ingest_time, keep_raw=True)
    tagged = typed.withColumn(validate.REASON,
                              validate.reason_column(validate.history_checks(typed.columns)))
    return tagged.drop(*RAW)


def ingest(events: DataFrame, dimension: DataFrame | None = None,
           ingest_time: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(history rows, rejects). Rejects keep the typed columns and a reason:
    constraint failures first, then events unknown to ``dimension``."""
    typed = typed_history(events, ingest_time, keep_raw=True)
    checks = validate.history_checks(typed.columns)
    if dimension is not None:
        typed = validate.with_known_flag(typed, dimension, ["event_id"])
        checks.append(validate.known_check())
    good, rejects = validate.split(typed, checks)
    extra = [*RAW, validate.KNOWN]
    return (good.drop(*[c for c in extra if c in good.columns]),
            rejects.drop(*[c for c in extra if c in rejects.columns]))


def event_dimension(events: DataFrame, key: str = "event_id",
                    attrs: Sequence[str] = ("event_name", "venue", "event_date"),
                    order: Sequence[str] = ("timestamp", "listing_id")) -> DataFrame:
    """One row per event: attributes of its first sighting (later names never
    overwrite), first and last sighting time. Aggregations only, so a hot
    event is combined map-side."""
    order = list(order)
    seen = "timestamp" if "timestamp" in events.columns else order[0]
    first = F.min_by(F.struct(*[F.col(a) for a in attrs]), F.struct(*[F.col(c) for c in order]))
    return (events.groupBy(key)
            .agg(first.alias("_first"), F.min(seen).alias("created_at"), F.max(seen).alias("last_updated"))
            .select(key, *[F.col(f"_first.{a}").alias(a) for a in attrs],
                    "created_at", "last_updated"))


def merge_dimension(current: DataFrame, batch_dim: DataFrame, key: str = "event_id",
                    attrs: Sequence[str] = ("event_name", "venue", "event_date")) -> DataFrame:
    """Upsert a batch's dimension rows into the current dimension: stored
    attributes win, new events are added, ``last_updated`` moves forward."""
    o, n = current.alias("o"), batch_dim.alias("n")
    return (o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
            .select(F.coalesce(F.col(f"o.{key}"), F.col(f"n.{key}")).alias(key),
                    *[F.coalesce(F.col(f"o.{a}"), F.col(f"n.{a}")).alias(a) for a in attrs],
                    F.coalesce(F.col("o.created_at"), F.col("n.created_at")).alias("created_at"),
                    F.greatest(F.col("o.last_updated"), F.col("n.last_updated")).alias("last_updated")))


def new_events(batch: DataFrame, known: DataFrame, key: str = "event_id",
               ts: str = "timestamp") -> DataFrame:
    """Events of ``batch`` not yet in ``known``, with their first sighting."""
    firsts = batch.groupBy(key).agg(F.min(ts).alias("first_seen"))
    return firsts.join(known.select(key), key, "left_anti")


def typed_alerts(alerts: DataFrame, stored_at: Column | None = None) -> DataFrame:
    """Drop alerts in the stored layout: money as DECIMAL(10,2), percent as
    DECIMAL(5,2) (null when it does not fit, which the range check rejects)."""
    created = stored_at if stored_at is not None else F.current_timestamp()
    return alerts.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.coalesce(F.col("alert_type"), F.lit(fixed.ALERT_TYPE)).alias("alert_type"),
        F.coalesce(F.col("alert_timestamp"), created).alias("alert_timestamp"),
        try_money("old_price").alias("old_price"), try_money("new_price").alias("new_price"),
        try_money("drop_amount").alias("drop_amount"),
        F.col("drop_percent").try_cast("decimal(5,2)").alias("drop_percent"),
        "section", "row", "seat", "source",
        F.col("listing_id").cast("string").alias("listing_id"), "listing_url",
        created.alias("created_at"),
        *[F.col(c).alias(f"_raw_{c}") for c in ("old_price", "new_price", "drop_amount",
                                                "drop_percent")])


def store_alerts(alerts: DataFrame, dimension: DataFrame | None = None,
                 stored_at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(stored alerts, rejects). The alert path does not create events: an
    alert for an event the store does not know is a reject
    (``unknown_event``) and can be joined again once the event exists."""
    typed = typed_alerts(alerts, stored_at)
    raw = [c for c in typed.columns if c.startswith("_raw_")]
    checks = validate.not_null_checks(["event_id", "source"])
    checks += [(f"null_{c}", F.col(f"_raw_{c}").isNotNull()) for c in ("old_price", "new_price")]
    checks += validate.range_checks({c[len("_raw_"):]: c for c in raw})
    checks += validate.length_checks(TEXT_LIMITS["price_drop_alerts"], typed.columns)
    if dimension is not None:
        typed = validate.with_known_flag(typed, dimension.select(
            F.col("event_id").cast("string").alias("event_id")), ["event_id"])
        checks.append(validate.known_check())
        raw.append(validate.KNOWN)
    good, rejects = validate.split(typed, checks)
    return good.drop(*raw), rejects.drop(*raw)
