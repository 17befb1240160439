"""Raw listings from each ticket source -> price events.

A source adapter is a function ``(listings, tracked_events) -> DataFrame`` in
``ADAPTERS``. ``listings`` has one row per raw listing with the event id it
was fetched for; ``tracked_events`` has ``event_id, name, venue, date``.
Adapters differ only in their source tag, default delivery method and the
event date used when the descriptor's date does not parse.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewatch import fixed
from pricewatch.functions.columns import iso_text
from pricewatch.operators import validate
from pricewatch.schemas import PRICE_EVENT, PRICE_EVENT_WIRE

UNKNOWN, DEFAULT_QUANTITY = fixed.UNKNOWN, fixed.DEFAULT_QUANTITY


def explode_listings(responses: DataFrame) -> DataFrame:
    """Landed API responses ``{event_id, listings: [...]}`` -> one row per
    listing (``event_id`` plus the listing's fields)."""
    return (responses.select("event_id", F.explode_outer("listings").alias("l"))
            .where(F.col("l").isNotNull())
            .select("event_id", "l.*"))


def _number(c: Column, default) -> tuple[Column, Column]:
    """(value, parse_ok): missing -> default, junk -> not ok."""
    v = c.try_cast("double")
    return F.coalesce(v, F.lit(float(default))), c.isNull() | v.isNotNull()


def parse_listings(listings: DataFrame, tracked: DataFrame, source: str,
                   default_delivery: str, date_fallback_days: int = 0,
                   scrape_time: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(price events, rejects). A listing whose price, fee, total or
    quantity text is not a number is rejected (``bad_number``); the rest of
    the batch goes on."""
    scraped = scrape_time if scrape_time is not None else F.current_timestamp()
    price, price_ok = _number(F.col("price"), 0.0)
    fees, fees_ok = _number(F.col("fees.total"), 0.0)
    total_raw = F.col("total_price").try_cast("double")
    total_ok = F.col("total_price").isNull() | total_raw.isNotNull()
    qty = F.col("quantity").try_cast("double").try_cast("int")      # truncated; null when too large
    qty_ok = F.col("quantity").isNull() | qty.isNotNull()
    fallback = F.current_timestamp() + F.make_dt_interval(days=F.lit(date_fallback_days))

    ev = (tracked.dropDuplicates(["event_id"])
          .select("event_id", F.col("name").alias("event_name"), "venue",
                  F.coalesce(F.try_to_timestamp("date"), fallback).alias("event_date"),
                  F.lit(True).alias("_tracked")))
    joined = listings.join(ev, "event_id", "left")
    shaped = joined.select(
        "event_id", "event_name", "venue", "event_date",
        F.lit(source).alias("source"),
        F.coalesce("section", F.lit(UNKNOWN)).alias("section"),
        F.coalesce(F.col("row").cast("string"), F.lit(UNKNOWN)).alias("row"),
        F.coalesce(F.col("seat_number").cast("string"), F.lit(UNKNOWN)).alias("seat"),
        price.alias("price"),
        F.when(fees > 0, fees).alias("fees"),
        F.coalesce(total_raw, price + fees).alias("total_price"),
        scraped.alias("timestamp"),
        F.concat(F.lit(f"{source}_"), F.coalesce(F.col("id").cast("string"), F.lit(""))).alias("listing_id"),
        F.coalesce("url", F.lit("")).alias("listing_url"),
        F.coalesce(qty, F.lit(DEFAULT_QUANTITY)).alias("quantity"),
        F.coalesce("delivery_method", F.lit(default_delivery)).alias("delivery_method"),
        F.lit(None).cast("string").alias("seller_notes"),
        (price_ok & fees_ok & total_ok & qty_ok).alias("_numbers_ok"),
        F.coalesce(F.col("_tracked"), F.lit(False)).alias("_tracked"),
    )
    good, rejects = validate.split(shaped, [("bad_number", F.col("_numbers_ok")),
                                            ("untracked_event", F.col("_tracked"))])
    return good.drop("_numbers_ok", "_tracked"), rejects.drop("_numbers_ok", "_tracked")


# Per-source adapters; they differ in delivery default and date fallback.
ADAPTERS = {
    src: partial(parse_listings, source=src, default_delivery=fixed.DELIVERY_DEFAULT[src],
                 date_fallback_days=fixed.DATE_FALLBACK_DAYS[src])
    for src in fixed.DELIVERY_DEFAULT
}


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """All sources into one stream of price events."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def to_wire(events: DataFrame, key: Column | None = None) -> DataFrame:
    """Price events -> ``(key, value)`` JSON records. Nulls are written as
    ``null`` rather than left out; times are ISO-8601 text."""
    cols = []
    for f in PRICE_EVENT.fields:
        c = F.col(f.name)
        if f.name in ("event_date", "timestamp"):
            c = iso_text(c)
        cols.append(c.alias(f.name) if f.name in events.columns else F.lit(None).alias(f.name))
    value = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    out = events.select((key if key is not None else F.lit(None).cast("string")).alias("key"),
                        value.alias("value"))
    return out


NUMBERS = ("price", "fees", "total_price", "quantity")


def _field(f: T.StructField) -> Column:
    """A field of the parsed record ``e``, typed; null where it doesn't parse."""
    c = F.col(f"e.{f.name}")
    if f.name in ("event_date", "timestamp"):
        return F.try_to_timestamp(c)
    return c.try_cast("double").try_cast("int") if f.name == "quantity" else c.try_cast(f.dataType)


WIRE_REASON = "_wire_reason"


def tagged_wire(records: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON records -> typed price events, one row a record, with the text
    (``_raw``) and ``_wire_reason``: ``malformed_json`` for text that is no JSON
    object, ``null_event_id`` without an event id, else null. Numbers may be
    quoted; times are ISO-8601 with ``Z`` or an offset; other fields that don't
    parse become null. ``_raw_price`` keeps the price's text and
    ``_bad_number`` says that a price, fee, total or quantity is there but is
    no number, which the history rejects. A fractional quantity is truncated.

    The parsed record is the output of a generator (an array of one), which
    the optimiser doesn't copy into the expressions above it: a record is
    parsed once, however many fields are read."""
    schema = T.StructType(PRICE_EVENT_WIRE.fields + [T.StructField("_corrupt", T.StringType())])
    text = F.col(value).cast("string")
    record = F.from_json(text, schema, {"columnNameOfCorruptRecord": "_corrupt"})
    parsed = records.select(*keep, text.alias("_raw"), F.explode(F.array(record)).alias("e"))
    is_object = F.col("e").isNotNull() & F.col("e._corrupt").isNull()
    return parsed.select(
        *keep, "_raw",
        *[_field(f).alias(f.name) for f in PRICE_EVENT.fields],
        F.col("e.price").alias("_raw_price"),
        reduce(lambda a, b: a | b, [F.col(f"e.{f.name}").isNotNull() & _field(f).isNull()
                                    for f in PRICE_EVENT.fields if f.name in NUMBERS]).alias("_bad_number"),
        validate.reason_column([("malformed_json", is_object),
                                ("null_event_id", F.col("e.event_id").isNotNull())]).alias(WIRE_REASON))


def good_events(tagged: DataFrame) -> DataFrame:
    """The readable records of ``tagged_wire``."""
    return tagged.where(F.col(WIRE_REASON).isNull()).drop("_raw", WIRE_REASON)


def from_wire(records: DataFrame, value: str = "value",
              keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(typed price events, rejects) of ``tagged_wire``; rejects keep the text
    and have the reason as ``reject_reason``. Both read the records: a job that
    needs both persists the tagged frame and splits that."""
    tagged = tagged_wire(records, value, keep)
    return (good_events(tagged),
            tagged.where(F.col(WIRE_REASON).isNotNull()).withColumnRenamed(WIRE_REASON, validate.REASON))
