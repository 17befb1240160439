"""Explicit schemas. Nothing is inferred from data."""

from pyspark.sql import types as T

# A raw listing as a ticket API returns it. Price-like fields are text: a
# quoted number must still parse, and junk must be told apart from missing.
RAW_LISTING = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("section", T.StringType()),
    T.StructField("row", T.StringType()),
    T.StructField("seat_number", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("fees", T.StructType([T.StructField("total", T.StringType())])),
    T.StructField("total_price", T.StringType()),
    T.StructField("quantity", T.StringType()),
    T.StructField("delivery_method", T.StringType()),
    T.StructField("url", T.StringType()),
])

# One landed API response: the tracked event it was asked for, and its listings.
RAW_RESPONSE = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("listings", T.ArrayType(RAW_LISTING)),
])

# Tracked-event descriptor (what a poller is told to watch).
TRACKED_EVENT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("venue", T.StringType()),
    T.StructField("date", T.StringType()),
])

# The normalised price event: one record per listing per poll.
PRICE_EVENT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("venue", T.StringType()),
    T.StructField("event_date", T.TimestampType()),
    T.StructField("source", T.StringType()),
    T.StructField("section", T.StringType()),
    T.StructField("row", T.StringType()),
    T.StructField("seat", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("fees", T.DoubleType()),
    T.StructField("total_price", T.DoubleType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("listing_id", T.StringType()),
    T.StructField("listing_url", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("delivery_method", T.StringType()),
    T.StructField("seller_notes", T.StringType()),
])

# The same record as it travels as JSON text: numbers and times are read as
# strings and cast with try_* functions, so "12.5" parses and "abc" is caught.
PRICE_EVENT_WIRE = T.StructType([
    T.StructField(f.name, T.StringType() if f.name in {
        "event_date", "price", "fees", "total_price", "timestamp", "quantity"} else f.dataType)
    for f in PRICE_EVENT.fields
])

MONEY = T.DecimalType(10, 2)
PERCENT = T.DecimalType(5, 2)
METRIC = T.DecimalType(15, 2)

# Stored tables.
EVENTS_TABLE = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("event_name", T.StringType(), False),
    T.StructField("venue", T.StringType(), False),
    T.StructField("event_date", T.TimestampType(), False),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("last_updated", T.TimestampType()),
])

PRICE_HISTORY = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("section", T.StringType()),
    T.StructField("row", T.StringType()),
    T.StructField("seat", T.StringType()),
    T.StructField("price", MONEY, False),
    T.StructField("fees", MONEY),
    T.StructField("total_price", MONEY, False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("listing_id", T.StringType()),
    T.StructField("listing_url", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("created_at", T.TimestampType()),
])

PRICE_DROP_ALERTS = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("alert_type", T.StringType()),
    T.StructField("alert_timestamp", T.TimestampType(), False),
    T.StructField("old_price", MONEY, False),
    T.StructField("new_price", MONEY, False),
    T.StructField("drop_amount", MONEY, False),
    T.StructField("drop_percent", PERCENT, False),
    T.StructField("section", T.StringType()),
    T.StructField("row", T.StringType()),
    T.StructField("seat", T.StringType()),
    T.StructField("source", T.StringType(), False),
    T.StructField("listing_id", T.StringType()),
    T.StructField("listing_url", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

THRESHOLD_RULES = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("user_id", T.StringType()),
    T.StructField("event_id", T.StringType(), False),
    T.StructField("target_price", MONEY, False),
    T.StructField("section", T.StringType()),
    T.StructField("max_row", T.IntegerType()),
    T.StructField("notification_method", T.StringType()),
    T.StructField("notification_target", T.StringType()),
    T.StructField("active", T.BooleanType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("last_triggered", T.TimestampType()),
])

ALERT_TRIGGERS = T.StructType([
    T.StructField("alert_id", T.LongType(), False),
    T.StructField("price", MONEY, False),
    T.StructField("source", T.StringType(), False),
    T.StructField("section", T.StringType()),
    T.StructField("row", T.StringType()),
    T.StructField("seat", T.StringType()),
    T.StructField("listing_url", T.StringType()),
    T.StructField("triggered_at", T.TimestampType()),
])

SYSTEM_METRICS = T.StructType([
    T.StructField("metric_name", T.StringType(), False),
    T.StructField("metric_value", METRIC, False),
    T.StructField("timestamp", T.TimestampType()),
])

POLL_LOG = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("poll_time", T.TimestampType()),
    T.StructField("latency_ms", T.DoubleType()),
])

# Text limits of the stored tables, in characters.
TEXT_LIMITS = {
    "events": {"event_id": 255, "event_name": 255, "venue": 255, "city": 100, "state": 50},
    "price_history": {"event_id": 255, "source": 50, "section": 50, "row": 10, "seat": 10, "listing_id": 255},
    "alerts": {"user_id": 255, "event_id": 255, "section": 50, "notification_method": 50,
               "notification_target": 255},
    "alert_triggers": {"source": 50, "section": 50, "row": 10, "seat": 10},
    "price_drop_alerts": {"event_id": 255, "alert_type": 50, "section": 50, "row": 10, "seat": 10, "source": 50,
                          "listing_id": 255},
    "system_metrics": {"metric_name": 100},
}

TABLES = {
    "events": EVENTS_TABLE,
    "price_history": PRICE_HISTORY,
    "alerts": THRESHOLD_RULES,
    "alert_triggers": ALERT_TRIGGERS,
    "price_drop_alerts": PRICE_DROP_ALERTS,
    "system_metrics": SYSTEM_METRICS,
}

# Keys of which a table has one row, and columns whose value another table's
# column must have.
UNIQUE = {"events": "event_id", "alerts": "id"}
REFERENCES = {
    "price_history": ("event_id", "events", "event_id"),
    "alerts": ("event_id", "events", "event_id"),
    "alert_triggers": ("alert_id", "alerts", "id"),
    "price_drop_alerts": ("event_id", "events", "event_id"),
}

# Values for columns that are missing, where a table has them.
DEFAULTS = {
    "price_history": {"quantity": 1},
    "alerts": {"user_id": "default_user", "notification_method": "discord", "active": True},
    "price_drop_alerts": {"alert_type": "price_drop"},
}
