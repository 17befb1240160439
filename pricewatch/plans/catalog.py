"""Registered queries over the driver's tables, and their SQL twins.

Every entry reads whole tables; limits appear only where a top-k is the
feature (newest N, top 5, cheapest 100 per event). The SQL strings are plain
SQL that DuckDB runs over the same Parquet files; they are the oracle.
Computed doubles that are sums or means are rounded to 6 places on both
sides, since the two engines add in different orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewatch.functions.columns import listing_key, since, valid_price
from pricewatch.operators import (changes, constraints, dashboard, history, metrics, normalize, notify,
                                  thresholds, validate)
from pricewatch.plans.driver import (ALERT_EVENT, AS_OF, AS_OF_SQL, KEYS, ONE_EVENT,
                                     ONE_EVENT_NAME, ORDER, PRICE, table)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# -- driver tables in the price model (see plans/driver.py) --------------------

def _events(spark, sf):
    return table(spark, sf, "events")


def _history(spark, sf):
    """``events`` as price history."""
    return _events(spark, sf).select(
        F.col("user_id").alias("event_id"), F.col("event_type").alias("source"),
        F.col(PRICE).alias("price"), F.col("ts").alias("timestamp"),
        F.col("event_id").alias("listing_id"))


_PH = ("(SELECT user_id AS event_id, event_type AS source, value AS price, "
       "ts AS timestamp, event_id AS listing_id FROM events)")


def _price_events(spark, sf):
    """``events`` as full price events (text ids, absent fields null)."""
    null_s, null_d = F.lit(None).cast("string"), F.lit(None).cast("double")
    return _events(spark, sf).select(
        F.col("user_id").cast("string").alias("event_id"), F.col("event_type").alias("source"),
        null_s.alias("section"), null_s.alias("row"), null_s.alias("seat"),
        F.col(PRICE).alias("price"), null_d.alias("fees"), null_d.alias("total_price"),
        F.col("ts").alias("timestamp"), F.col("event_id").cast("string").alias("listing_id"),
        null_s.alias("listing_url"), F.lit(None).cast("int").alias("quantity"))


def _dimension(spark, sf):
    """Event dimension: customer joined to nation."""
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("event_id"), F.col("c_name").alias("event_name"),
        F.col("n_name").alias("venue"))


_DIM = ("(SELECT c_custkey AS event_id, c_name AS event_name, n_name AS venue "
        "FROM customer JOIN nation ON c_nationkey = n_nationkey)")


def _tracked(spark, sf):
    """Events already known to the store: customers in good standing."""
    return (table(spark, sf, "customer").where(F.col("c_acctbal") >= 0)
            .select(F.col("c_custkey").alias("event_id")))


_TRACKED = "(SELECT c_custkey AS event_id FROM customer WHERE c_acctbal >= 0)"


def _dated_events(spark, sf):
    """Dated event dimension: orders with their customer's name and nation."""
    o, c, n = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
            .select(F.col("o_orderkey").alias("event_id"), F.col("c_name").alias("event_name"),
                    F.col("n_name").alias("venue"), F.col("o_orderdate").alias("event_date")))


_DATED = ("(SELECT o_orderkey AS event_id, c_name AS event_name, n_name AS venue, "
          "o_orderdate AS event_date FROM orders JOIN customer ON o_custkey = c_custkey "
          "JOIN nation ON c_nationkey = n_nationkey)")


def _classified(spark, sf, price=None, baseline="max"):
    ev = _events(spark, sf)
    if price is not None:
        ev = ev.withColumn(PRICE, price)
    return changes.classify_changes(ev, KEYS, PRICE, ORDER, baseline=baseline)


def _alerts(spark, sf):
    """Drop alerts in the stored alert layout; the alert time is the time of
    the price that dropped (processing time is not reproducible)."""
    a = changes.drop_alerts(_classified(spark, sf), PRICE, alert_time=F.col("ts"))
    return a.select(F.col("user_id").alias("event_id"), F.col("event_type").alias("source"),
                    "old_price", "new_price", "drop_amount", "drop_percent",
                    "alert_timestamp", F.col("event_id").alias("listing_id"))


# -- SQL building blocks ---------------------------------------------------------

def _valid(v="value"):
    return f"coalesce({v} > 0 AND NOT isnan({v}), false)"


def _base(src="events"):
    return f"""
  SELECT event_id, user_id, event_type, ts, value,
         max(CASE WHEN {_valid()} THEN value END) OVER (
             PARTITION BY user_id, event_type ORDER BY ts, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS base
  FROM {src}"""


_KIND = (f"CASE WHEN NOT {_valid()} THEN 'invalid' WHEN base IS NULL THEN 'new' "
         "WHEN value < base THEN 'drop' WHEN value > base THEN 'increase' ELSE 'same' END")

_ALERTS = f"""(
  SELECT user_id AS event_id, event_type AS source, base AS old_price, value AS new_price,
         base - value AS drop_amount, abs((value - base) / base * 100) AS drop_percent,
         ts AS alert_timestamp, event_id AS listing_id
  FROM ({_base()}) b WHERE {_valid()} AND value < base)"""

_SHIFTED = "(SELECT event_id, user_id, event_type, ts, value - 10 AS value FROM events)"


def _metrics_sql(src):
    return f"""
WITH c AS (SELECT {_KIND} AS t FROM ({_base(src)}) b)
SELECT count(*) AS events_processed,
       CAST(count_if(t IN ('drop', 'increase')) AS BIGINT) AS price_changes,
       CAST(count_if(t = 'drop') AS BIGINT) AS price_drops,
       CAST(count_if(t = 'increase') AS BIGINT) AS price_increases,
       CAST(count_if(t = 'same') AS BIGINT) AS unchanged,
       CAST(count_if(t = 'new') AS BIGINT) AS new_listings,
       CAST(count_if(t = 'invalid') AS BIGINT) AS invalid_prices,
       CAST(count_if(false) AS BIGINT) AS errors
FROM c"""


# == change detection ==============================================================

@register("price_drop_alerts", f"""
WITH b AS ({_base()})
SELECT event_id, user_id, event_type, ts,
       base AS old_price, value AS new_price,
       base - value AS drop_amount,
       abs((value - base) / base * 100) AS drop_percent,
       'price_drop' AS alert_type
FROM b WHERE {_valid()} AND value < base""")
def price_drop_alerts(spark, sf):
    alerts = changes.drop_alerts(_classified(spark, sf), PRICE)
    return alerts.select("event_id", "user_id", "event_type", "ts", "old_price", "new_price",
                         "drop_amount", "drop_percent", "alert_type")


@register("price_changes", f"""
WITH b AS ({_base()})
SELECT event_id, user_id, event_type, ts, base AS old_price, value AS new_price,
       value - base AS price_change, (value - base) / base * 100 AS change_percent,
       CASE WHEN value < base THEN 'drop' ELSE 'increase' END AS change_type
FROM b WHERE {_valid()} AND base IS NOT NULL AND value <> base""")
def price_changes(spark, sf):
    return changes.price_changes(_classified(spark, sf)).select(
        "event_id", "user_id", "event_type", "ts", "old_price",
        F.col(PRICE).alias("new_price"), "price_change", "change_percent", "change_type")


@register("price_events_classified", f"""
WITH b AS ({_base()})
SELECT event_id, user_id, event_type, ts, value,
       CASE WHEN {_valid()} AND base IS NOT NULL THEN base END AS old_price,
       {_KIND} AS change_type
FROM b""")
def price_events_classified(spark, sf):
    """Every event passes through, classified (the processed-events output)."""
    return _classified(spark, sf).select("event_id", "user_id", "event_type", "ts", PRICE,
                                         "old_price", "change_type")


@register("new_listings", f"""
WITH b AS ({_base()})
SELECT event_id, user_id, event_type, ts, value AS price
FROM b WHERE {_valid()} AND base IS NULL""")
def new_listings(spark, sf):
    return changes.new_listings(_classified(spark, sf)).select(
        "event_id", "user_id", "event_type", "ts", F.col(PRICE).alias("price"))


@register("change_metrics", _metrics_sql("events"))
def change_metrics(spark, sf):
    return changes.change_metrics(_classified(spark, sf))


@register("change_metrics_shifted", _metrics_sql(_SHIFTED))
def change_metrics_shifted(spark, sf):
    """Same counters with every price lowered by 10, so that invalid prices
    (<= 0) occur and must be skipped by the baseline."""
    return changes.change_metrics(_classified(spark, sf, price=F.col(PRICE) - 10))


@register("price_drop_alerts_shifted", f"""
WITH b AS ({_base(_SHIFTED)})
SELECT event_id, user_id, event_type, ts, base AS old_price, value AS new_price
FROM b WHERE {_valid()} AND value < base""")
def price_drop_alerts_shifted(spark, sf):
    a = changes.drop_alerts(_classified(spark, sf, price=F.col(PRICE) - 10), PRICE)
    return a.select("event_id", "user_id", "event_type", "ts", "old_price", "new_price")


@register("source_drop_alerts", f"""
WITH b AS (
  SELECT event_id, event_type, ts, value,
         max(CASE WHEN {_valid()} THEN value END) OVER (
             PARTITION BY event_type ORDER BY ts, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS base
  FROM events)
SELECT event_id, event_type, ts, base AS old_price, value AS new_price,
       base - value AS drop_amount, abs((value - base) / base * 100) AS drop_percent
FROM b WHERE {_valid()} AND value < base""")
def source_drop_alerts(spark, sf):
    """Drops against a whole source's running peak: the same detector keyed
    by source only, so each key holds about a fifth of all rows (the hot-key
    case of the two-level scan)."""
    c = changes.classify_changes(_events(spark, sf), ["event_type"], PRICE, ORDER)
    return changes.drop_alerts(c, PRICE).select("event_id", "event_type", "ts", "old_price",
                                                "new_price", "drop_amount", "drop_percent")


@register("source_drop_alerts_split", ORACLE["source_drop_alerts"])
def source_drop_alerts_split(spark, sf):
    """The same with every source cut into chunks, whatever its size."""
    c = changes.classify_changes(_events(spark, sf), ["event_type"], PRICE, ORDER, hot_rows=20)
    return changes.drop_alerts(c, PRICE).select("event_id", "event_type", "ts", "old_price",
                                                "new_price", "drop_amount", "drop_percent")


@register("source_changes_split", f"""
SELECT event_id, event_type, last_value(CASE WHEN {_valid("value")} THEN value END IGNORE NULLS) OVER (
  PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS old_price
FROM {_SHIFTED} s""")
def source_changes_split(spark, sf):
    """The previous valid price of the row's source, all sources cut."""
    from pricewatch.operators.scan import prior_scan
    e = _events(spark, sf).withColumn(PRICE, F.col(PRICE) - 10)
    return prior_scan(e, ["event_type"], ORDER, F.when(valid_price(PRICE), F.col(PRICE)), "old_price", "ts",
                      how="last", hot_rows=20).select("event_id", "event_type", "old_price")


@register("change_metrics_errors", f"""
WITH e AS (SELECT event_id, user_id, event_type, ts, event_id % 13 = 0 AS junk,
                  CASE WHEN event_id % 13 = 0 OR event_id % 17 = 0 THEN NULL ELSE value END AS value FROM events),
b AS (SELECT e.junk, x.* FROM ({_base("(SELECT event_id, user_id, event_type, ts, value FROM e)")}) x
      JOIN e USING (event_id)),
k AS (SELECT CASE WHEN junk THEN 'error' ELSE {_KIND} END AS kind FROM b)
SELECT count(*) AS events_processed, count(*) FILTER (kind IN ('drop', 'increase')) AS price_changes,
  count(*) FILTER (kind = 'drop') AS price_drops, count(*) FILTER (kind = 'increase') AS price_increases,
  count(*) FILTER (kind = 'same') AS unchanged, count(*) FILTER (kind = 'new') AS new_listings,
  count(*) FILTER (kind = 'invalid') AS invalid_prices, count(*) FILTER (kind = 'error') AS errors
FROM k""")
def change_metrics_errors(spark, sf):
    """Counters over price texts of which some are missing or no number."""
    n = F.col("event_id")
    e = _events(spark, sf).withColumn("raw", F.when(n % 13 == 0, F.lit("n/a")).when(n % 17 != 0, F.col(PRICE)
                                                                                   .cast("string")))
    e = e.withColumn(PRICE, F.col("raw").try_cast("double"))
    return changes.change_metrics(changes.classify_changes(e, KEYS, PRICE, ORDER, raw_price="raw"))


@register("incremental_drop_alerts", f"""
WITH b AS ({_base()})
SELECT event_id, user_id, event_type, ts, base AS old_price, value AS new_price,
       base - value AS drop_amount, abs((value - base) / base * 100) AS drop_percent
FROM b WHERE {_valid()} AND value < base AND ts >= {AS_OF_SQL} - INTERVAL 7 DAYS""")
def incremental_drop_alerts(spark, sf):
    """Drops of the last week, found incrementally: only the new week is
    scanned row by row; the stored history contributes one baseline per
    listing (an aggregation), used as the seed. Equals the full-history
    answer for that week."""
    from pricewatch.functions.columns import valid_price
    from pricewatch.operators.scan import SEED
    ev = _events(spark, sf)
    new = since("ts", 7 * 24, AS_OF)
    seed = (ev.where(~new & valid_price(PRICE)).groupBy(*KEYS)
            .agg(F.max(PRICE).alias(SEED)))
    c = changes.classify_changes(ev.where(new), KEYS, PRICE, ORDER, seed=seed)
    return changes.drop_alerts(c, PRICE).select(
        "event_id", "user_id", "event_type", "ts", "old_price", "new_price", "drop_amount",
        "drop_percent")


@register("listing_baselines", f"""
SELECT user_id, event_type, value AS baseline_price, ts AS baseline_ts,
       event_id AS baseline_event_id
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                                   ORDER BY value DESC, ts DESC, event_id DESC) AS rn
      FROM events WHERE {_valid()}) WHERE rn = 1""")
def listing_baselines(spark, sf):
    return changes.listing_baselines(_events(spark, sf), KEYS, PRICE, ORDER)


@register("price_drops_vs_previous", f"""
WITH v AS (SELECT event_id, user_id, event_type, ts, value,
                  lag(value) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS prev
           FROM events WHERE {_valid()})
SELECT event_id, user_id, event_type, ts, prev AS old_price, value AS new_price,
       prev - value AS drop_amount, abs((value - prev) / prev * 100) AS drop_percent
FROM v WHERE value < prev""")
def price_drops_vs_previous(spark, sf):
    a = changes.drop_alerts(_classified(spark, sf, baseline="previous"), PRICE)
    return a.select("event_id", "user_id", "event_type", "ts", "old_price", "new_price",
                    "drop_amount", "drop_percent")


# == validation and ingest ==========================================================

@register("valid_prices", f"""
SELECT event_id, user_id, event_type, ts, value - 10 AS price
FROM events WHERE {_valid('value - 10')}""")
def valid_prices(spark, sf):
    ev = _events(spark, sf).select("event_id", "user_id", "event_type", "ts",
                                   (F.col(PRICE) - 10).alias("price"))
    return validate.valid_prices(ev, "price")


@register("listing_key", """
SELECT DISTINCT CAST(user_id AS VARCHAR) || '_' || event_type || '___' AS listing_key
FROM events""")
def distinct_listing_keys(spark, sf):
    none = F.lit(None).cast("string")
    return (_events(spark, sf)
            .select(listing_key("user_id", "event_type", none, none, none).alias("listing_key"))
            .distinct())


@register("price_history_typed", """
SELECT CAST(user_id AS VARCHAR) AS event_id, event_type AS source,
       CAST(NULL AS VARCHAR) AS section, CAST(NULL AS VARCHAR) AS "row",
       CAST(NULL AS VARCHAR) AS seat, CAST(CAST(value AS DECIMAL(10,2)) AS DOUBLE) AS price,
       CAST(NULL AS DOUBLE) AS fees, CAST(CAST(value AS DECIMAL(10,2)) AS DOUBLE) AS total_price,
       ts AS timestamp, CAST(event_id AS VARCHAR) AS listing_id, '' AS listing_url,
       CAST(1 AS INTEGER) AS quantity
FROM events""")
def price_history_typed(spark, sf):
    """Typed history rows. Money is quantised to DECIMAL(10,2) by the ingest
    and shown here as double, so both engines print the same text."""
    good, _ = history.ingest(_price_events(spark, sf))
    return _money_as_double(good.drop("created_at"), ["price", "fees", "total_price"])


def _money_as_double(df, cols):
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


@register("reject_reasons", f"""
WITH a AS (SELECT *, CAST(event_id AS VARCHAR) AS eid, CAST(listing_id AS VARCHAR) AS lid
           FROM {_ALERTS}),
r AS (
  SELECT CASE
    WHEN eid IS NULL THEN 'null_event_id'
    WHEN source IS NULL THEN 'null_source'
    WHEN old_price IS NULL THEN 'null_old_price'
    WHEN new_price IS NULL THEN 'null_new_price'
    WHEN TRY_CAST(old_price AS DECIMAL(10,2)) IS NULL THEN 'out_of_range_old_price'
    WHEN TRY_CAST(new_price AS DECIMAL(10,2)) IS NULL THEN 'out_of_range_new_price'
    WHEN drop_amount IS NOT NULL AND TRY_CAST(drop_amount AS DECIMAL(10,2)) IS NULL
      THEN 'out_of_range_drop_amount'
    WHEN drop_percent IS NOT NULL AND TRY_CAST(drop_percent AS DECIMAL(5,2)) IS NULL
      THEN 'out_of_range_drop_percent'
    WHEN length(eid) > 255 THEN 'too_long_event_id'
    WHEN length(source) > 50 THEN 'too_long_source'
    WHEN length(lid) > 255 THEN 'too_long_listing_id'
    WHEN NOT EXISTS (SELECT 1 FROM {_TRACKED} t WHERE t.event_id = a.event_id)
      THEN 'unknown_event'
  END AS reject_reason
  FROM a)
SELECT reject_reason, count(*) AS n FROM r WHERE reject_reason IS NOT NULL
GROUP BY reject_reason""")
def reject_reasons(spark, sf):
    """Storing drop alerts: constraint failures first, then alerts of events
    the store does not know (the alert path does not create events)."""
    none = F.lit(None).cast("string")
    alerts = _alerts(spark, sf).withColumns(
        {"section": none, "row": none, "seat": none, "listing_url": none,
         "alert_type": F.lit("price_drop")})
    _, rejects = history.store_alerts(alerts, _tracked(spark, sf),
                                      stored_at=F.lit(AS_OF).cast("timestamp"))
    return validate.reject_counts(rejects)


def _faulty_prices(spark, sf):
    """``events`` as price records, some of which break constraints."""
    n, text = F.col("event_id"), (lambda c: F.col(c).cast("string"))
    return _events(spark, sf).select(
        F.when(n % 11 != 0, text("user_id")).alias("event_id"),
        F.when(n % 13 == 0, F.repeat(F.lit("s"), 51)).otherwise(F.col("event_type")).alias("source"),
        F.when(n % 17 == 0, F.repeat(F.lit("x"), 51)).alias("section"),
        F.when(n % 19 == 0, F.repeat(F.lit("r"), 11)).alias("row"),
        F.when(n % 7 == 0, F.col("value") * 1e8).otherwise(F.col("value")).alias("price"),
        F.when(n % 5 != 0, F.col("value")).alias("total_price"),
        F.when(n % 23 != 0, F.col("ts").cast("timestamp")).alias("timestamp"), text("event_id").alias("listing_id"))


@register("ingest_rejects", f"""
WITH r AS (
  SELECT CAST(event_id AS VARCHAR) AS listing_id, list_filter([
    CASE WHEN event_id % 11 = 0 THEN 'null_event_id' END,
    CASE WHEN event_id % 5 = 0 OR value IS NULL THEN 'null_total_price' END,
    CASE WHEN event_id % 23 = 0 THEN 'null_timestamp' END,
    CASE WHEN event_id % 7 = 0 AND value * 1e8 >= 99999999.995 THEN 'out_of_range_price' END,
    CASE WHEN event_id % 13 = 0 THEN 'too_long_source' END,
    CASE WHEN event_id % 17 = 0 THEN 'too_long_section' END,
    CASE WHEN event_id % 19 = 0 THEN 'too_long_row' END,
    CASE WHEN event_id % 11 <> 0 AND NOT EXISTS (SELECT 1 FROM {_TRACKED} t WHERE t.event_id = user_id)
      THEN 'unknown_event' END], lambda x: x IS NOT NULL) AS reasons
  FROM events)
SELECT listing_id, reasons[1] AS reject_reason, array_to_string(reasons, ',') AS reject_reasons
FROM r WHERE len(reasons) > 0""")
def ingest_rejects(spark, sf):
    """All constraints that each rejected record breaks."""
    rows = constraints.check(_faulty_prices(spark, sf), "price_history", _tracked(spark, sf))
    return rows.where(F.col(validate.REASON).isNotNull()).select(
        "listing_id", validate.REASON, F.array_join(validate.REASONS, ",").alias(validate.REASONS))


@register("event_rejects", """
WITH e AS (
  SELECT CAST(o_custkey AS VARCHAR) AS event_id, CAST(o_orderkey AS VARCHAR) AS event_name, o_orderdate AS event_date,
    CASE WHEN o_orderkey % 9 = 0 THEN 'null_venue' WHEN o_orderkey % 10 = 0 THEN 'too_long_venue' END AS reason
  FROM orders
), firsts AS (SELECT *, row_number() OVER (PARTITION BY event_id, reason ORDER BY event_date, event_name) AS n FROM e)
SELECT event_id, event_name, event_date, coalesce(reason, CASE WHEN n > 1 THEN 'duplicate_event_id' END, '')
  AS reject_reasons FROM firsts""")
def event_rejects(spark, sf):
    """Events of which one a key can be stored: the first that breaks no rule."""
    n = F.col("o_orderkey")
    rows = constraints.check(table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("event_id"), n.cast("string").alias("event_name"),
        F.when(n % 9 == 0, F.lit(None)).when(n % 10 == 0, F.repeat(F.lit("v"), 256)).otherwise(F.lit("v")).alias("venue"),
        F.col("o_orderdate").alias("event_date")), "events", order=["event_date"])
    return rows.select("event_id", "event_name", F.col("event_date").cast("timestamp_ntz").alias("event_date"),
                       F.array_join(validate.REASONS, ",").alias(validate.REASONS))


@register("fk_valid", f"""
SELECT * FROM {_PH} p WHERE EXISTS (SELECT 1 FROM {_TRACKED} t WHERE t.event_id = p.event_id)""")
def fk_valid(spark, sf):
    return validate.with_known_keys(_history(spark, sf), _tracked(spark, sf), ["event_id"],
                                    "left_semi")


@register("fk_orphans", f"""
SELECT * FROM {_PH} p WHERE NOT EXISTS (SELECT 1 FROM {_TRACKED} t WHERE t.event_id = p.event_id)""")
def fk_orphans(spark, sf):
    return validate.with_known_keys(_history(spark, sf), _tracked(spark, sf), ["event_id"],
                                    "left_anti")


@register("dedup_prices", f"""
SELECT DISTINCT * FROM (SELECT * FROM {_PH} UNION ALL SELECT * FROM {_PH})""")
def dedup_prices(spark, sf):
    """A replayed feed (every price delivered twice) stored once."""
    h = _history(spark, sf)
    return validate.dedup(h.unionByName(h), ["listing_id", "timestamp"])


@register("event_dimension", """
SELECT event_id, event_name, created_at, last_updated FROM (
  SELECT user_id AS event_id, event_type AS event_name,
         min(ts) OVER (PARTITION BY user_id) AS created_at,
         max(ts) OVER (PARTITION BY user_id) AS last_updated,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events) WHERE rn = 1""")
def event_dimension(spark, sf):
    """Per event: the name of its first sighting (stand-in: the first event
    type), first and last sighting."""
    ev = _events(spark, sf).select(F.col("user_id").alias("event_id"),
                                   F.col("event_type").alias("event_name"),
                                   F.col("ts").alias("timestamp"),
                                   F.col("event_id").alias("listing_id"))
    return history.event_dimension(ev, "event_id", ("event_name",))


@register("new_events", f"""
SELECT event_id, min(timestamp) AS first_seen FROM {_PH} p
WHERE NOT EXISTS (SELECT 1 FROM {_TRACKED} t WHERE t.event_id = p.event_id)
GROUP BY event_id""")
def new_events(spark, sf):
    return history.new_events(_history(spark, sf), _tracked(spark, sf))


@register("ingest_metrics", f"""
SELECT 'messages_received' AS metric_name, count(*) AS metric_value FROM events
UNION ALL SELECT 'prices_stored', count(*) FROM events
UNION ALL SELECT 'errors', CAST(0 AS BIGINT)
UNION ALL SELECT 'events_created', count(DISTINCT event_id) FROM {_PH} p
  WHERE NOT EXISTS (SELECT 1 FROM {_TRACKED} t WHERE t.event_id = p.event_id)""")
def ingest_metrics(spark, sf):
    """Storage counters for ingesting all events against the tracked events:
    unknown events are created (not rejected) before their prices are
    stored."""
    events = _price_events(spark, sf)
    known = _tracked(spark, sf).select(F.col("event_id").cast("string").alias("event_id"))
    created = history.new_events(events, known)
    return metrics.ingest_metrics(history.tag_history(events), created)


@register("ingest_metrics_errors", """
WITH e AS (SELECT *, event_id % 11 = 0 OR event_id % 13 = 0 OR event_id % 17 = 0 OR event_id % 19 = 0
                     OR (event_id % 7 = 0 AND value * 1e8 >= 99999999.995) AS bad FROM events)
SELECT 'messages_received' AS metric_name, count(*) AS metric_value FROM e
UNION ALL SELECT 'prices_stored', count(*) FROM e WHERE NOT bad
UNION ALL SELECT 'errors', count(*) FROM e WHERE bad
UNION ALL SELECT 'events_created', count(DISTINCT user_id) FROM e WHERE NOT bad
  AND user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""")
def ingest_metrics_errors(spark, sf):
    """Storage counters where some records break constraints: these are
    errors, and create no events."""
    none = F.lit(None).cast("string")
    records = _faulty_prices(spark, sf).withColumns(
        {c: none for c in ("seat", "listing_url", "event_name", "venue", "event_date")}).withColumns(
        {"fees": F.lit(None).cast("double"), "quantity": F.lit(None).cast("int")})
    tagged = history.tag_events(records, F.lit(AS_OF).cast("timestamp"))
    known = _tracked(spark, sf).select(F.col("event_id").cast("string").alias("event_id"))
    return metrics.ingest_metrics(tagged, history.new_events(tagged.where(F.col(validate.REASON).isNull()), known))


@register("wire_rejects", """
SELECT CASE WHEN event_id % 9 = 0 THEN 'malformed_json' WHEN event_id % 10 = 0 THEN 'null_event_id'
            ELSE 'none' END AS reason,
  event_id % 9 <> 0 AND event_id % 11 = 0 AS bad_number, count(*) AS n
FROM events GROUP BY ALL""")
def wire_rejects(spark, sf):
    """JSON records of which some can't be read, lack their event or have a
    price that is no number."""
    n, text = F.col("event_id"), F.col("event_id").cast("string")
    line = F.when(n % 9 == 0, F.concat(F.lit('{"event_id": "'), text)).otherwise(F.to_json(F.struct(
        F.when(n % 10 != 0, text).alias("event_id"),
        F.when(n % 11 == 0, F.lit("soon")).otherwise(F.col(PRICE).cast("string")).alias("price"))))
    tagged = normalize.tagged_wire(_events(spark, sf).select(line.alias("value")))
    return tagged.groupBy(F.coalesce(normalize.WIRE_REASON, F.lit("none")).alias("reason"),
                          F.coalesce("_bad_number", F.lit(False)).alias("bad_number")).agg(F.count(F.lit(1)).alias("n"))


@register("retention_filter", f"""
SELECT * FROM {_PH} p WHERE timestamp >= {AS_OF_SQL} - INTERVAL 7 DAYS""")
def retention_filter(spark, sf):
    return _history(spark, sf).where(since("timestamp", 7 * 24, AS_OF))


@register("latest_per_key", """
SELECT user_id, value, ts, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""")
def latest_per_key(spark, sf):
    return metrics.latest_per_key(_events(spark, sf), ["user_id"], ORDER,
                                  [PRICE, "ts", "event_type"])


# == dashboard ======================================================================

@register("price_history_recent", f"""
SELECT p.event_id, p.price, p.source, p.timestamp, p.listing_id, d.event_name, d.venue
FROM {_PH} p JOIN {_DIM} d ON p.event_id = d.event_id
WHERE p.timestamp >= {AS_OF_SQL} - INTERVAL 48 HOURS
ORDER BY p.timestamp DESC, p.listing_id DESC LIMIT 10000""")
def price_history_recent(spark, sf):
    return dashboard.recent_prices(_history(spark, sf), _dimension(spark, sf), hours=48,
                                   as_of=AS_OF)


@register("price_history_newest", f"""
SELECT p.event_id, p.price, p.source, p.timestamp, p.listing_id, d.event_name, d.venue
FROM {_PH} p JOIN {_DIM} d ON p.event_id = d.event_id
WHERE p.timestamp >= {AS_OF_SQL} - INTERVAL 720 HOURS
ORDER BY p.timestamp DESC, p.listing_id DESC LIMIT 50""")
def price_history_newest(spark, sf):
    """The newest 50 of a month: the limit binds."""
    return dashboard.recent_prices(_history(spark, sf), _dimension(spark, sf), hours=720, as_of=AS_OF, limit=50)


@register("price_history_recent_event", f"""
SELECT p.event_id, p.price, p.source, p.timestamp, p.listing_id, d.event_name, d.venue
FROM {_PH} p JOIN {_DIM} d ON p.event_id = d.event_id
WHERE p.timestamp >= {AS_OF_SQL} - INTERVAL 168 HOURS AND p.event_id = {ONE_EVENT}
ORDER BY p.timestamp DESC, p.listing_id DESC LIMIT 10000""")
def price_history_recent_event(spark, sf):
    return dashboard.recent_prices(_history(spark, sf), _dimension(spark, sf), hours=168,
                                   as_of=AS_OF, event_id=ONE_EVENT)


def _stats_sql(where=""):
    return f"""
SELECT count(*) AS total_listings, round(coalesce(avg(price), 0), 6) AS avg_price,
       coalesce(min(price), 0) AS min_price, coalesce(max(price), 0) AS max_price,
       count(DISTINCT source) AS num_sources
FROM {_PH} p WHERE timestamp >= {AS_OF_SQL} - INTERVAL 48 HOURS {where}"""


def _round_avg(df, col="avg_price"):
    return df.withColumn(col, F.round(col, 6))


@register("price_stats", _stats_sql())
def price_stats(spark, sf):
    return _round_avg(dashboard.price_stats(_history(spark, sf), 48, AS_OF))


@register("price_stats_empty", _stats_sql().replace(AS_OF_SQL, "TIMESTAMP '2030-01-01 00:00:00'"))
def price_stats_empty(spark, sf):
    """No prices in the window: zeros, not nulls."""
    return _round_avg(dashboard.price_stats(_history(spark, sf), 48, "2030-01-01 00:00:00"))


@register("price_stats_event", _stats_sql(f"AND event_id = {ONE_EVENT}"))
def price_stats_event(spark, sf):
    return _round_avg(dashboard.price_stats(_history(spark, sf), 48, AS_OF, ONE_EVENT))


_RECENT_ALERTS = f"""
SELECT a.event_id, d.event_name, d.venue, a.old_price, a.new_price, a.drop_amount,
       a.drop_percent, a.source, a.alert_timestamp, a.listing_id
FROM {_ALERTS} a JOIN {_DIM} d ON a.event_id = d.event_id
ORDER BY a.alert_timestamp DESC, a.listing_id DESC LIMIT 20"""


@register("recent_alerts", _RECENT_ALERTS)
def recent_alerts(spark, sf):
    return dashboard.recent_alerts(_alerts(spark, sf), _dimension(spark, sf), 20)


@register("recent_alerts_event", f"""
SELECT * FROM ({_RECENT_ALERTS}) r WHERE event_id = {ALERT_EVENT}""")
def recent_alerts_event(spark, sf):
    """The event filter runs after the top 20, as on the dashboard."""
    return dashboard.recent_alerts(_alerts(spark, sf), _dimension(spark, sf), 20,
                                   event_id=ALERT_EVENT)


@register("list_events", f"""
SELECT DISTINCT event_id, event_name, venue, event_date FROM {_DATED} e""")
def list_events(spark, sf):
    return dashboard.list_events(_dated_events(spark, sf))


@register("event_lookup", f"SELECT * FROM {_DIM} d WHERE event_id = {ONE_EVENT}")
def event_lookup(spark, sf):
    return dashboard.event_lookup(_dimension(spark, sf), ONE_EVENT)


@register("event_by_name", f"""
SELECT * FROM {_DATED} e WHERE event_name = '{ONE_EVENT_NAME}'
ORDER BY event_date DESC, event_id LIMIT 1""")
def event_by_name(spark, sf):
    return dashboard.event_by_name(_dated_events(spark, sf), ONE_EVENT_NAME)


@register("avg_price_by_time_source", f"""
SELECT date_trunc('day', timestamp) AS timestamp, source,
       round(avg(price), 6) AS avg_price, count(*) AS n
FROM {_PH} p GROUP BY 1, 2""")
def avg_price_by_time_source(spark, sf):
    return _round_avg(dashboard.avg_price_by_time_source(_history(spark, sf), unit="day"))


_RECENT_48H = f"""(
  SELECT p.event_id, p.price, p.source, p.timestamp, p.listing_id
  FROM {_PH} p JOIN {_DIM} d ON p.event_id = d.event_id
  WHERE p.timestamp >= {AS_OF_SQL} - INTERVAL 48 HOURS
  ORDER BY p.timestamp DESC, p.listing_id DESC LIMIT 10000)"""


def _recent_48h(spark, sf):
    return dashboard.recent_prices(_history(spark, sf), _dimension(spark, sf), hours=48,
                                   as_of=AS_OF)


@register("dashboard_price_series", f"""
SELECT timestamp, source, round(avg(price), 6) AS avg_price, count(*) AS n
FROM {_RECENT_48H} r GROUP BY timestamp, source""")
def dashboard_price_series(spark, sf):
    """The dashboard chart: mean price per exact (timestamp, source) over the
    prices it shows (newest 10,000 of the last 48 hours)."""
    return _round_avg(dashboard.avg_price_by_time_source(_recent_48h(spark, sf)))


@register("dashboard_source_table", f"""
SELECT source, round(avg(price), 6) AS avg_price, min(price) AS min_price,
       max(price) AS max_price
FROM {_RECENT_48H} r GROUP BY source""")
def dashboard_source_table(spark, sf):
    """The dashboard's per-source table over the prices it shows."""
    return _round_avg(dashboard.source_summary(_recent_48h(spark, sf)))


@register("dashboard_price_histogram", f"""
WITH r AS {_RECENT_48H},
     bounds AS (SELECT min(price) AS lo, max(price) AS hi FROM r),
     binned AS (SELECT source, lo, hi,
                       least(CAST(floor((price - lo) / (hi - lo) * 30) AS BIGINT) + 1, 30) AS bin
                FROM r, bounds WHERE price IS NOT NULL)
SELECT source, bin, lo + (bin - 1) * ((hi - lo) / 30) AS bin_start,
       lo + bin * ((hi - lo) / 30) AS bin_end, count(*) AS n
FROM binned GROUP BY source, bin, lo, hi""")
def dashboard_price_histogram(spark, sf):
    """The dashboard histogram: 30 bins over the prices it shows."""
    return dashboard.price_histogram(_recent_48h(spark, sf), 30, "source", top_k=True)


@register("dashboard_alerts_chart", f"""
SELECT date_trunc('hour', alert_timestamp) AS hour, count(*) AS alerts
FROM (SELECT a.alert_timestamp, a.listing_id FROM {_ALERTS} a JOIN {_DIM} d
      ON a.event_id = d.event_id
      ORDER BY a.alert_timestamp DESC, a.listing_id DESC LIMIT 20) t GROUP BY 1""")
def dashboard_alerts_chart(spark, sf):
    """The dashboard's alerts-per-hour chart, drawn from the 20 alerts it
    lists."""
    return dashboard.alerts_per_hour(
        dashboard.recent_alerts(_alerts(spark, sf), _dimension(spark, sf), 20))


@register("source_summary", f"""
SELECT source, round(avg(price), 6) AS avg_price, min(price) AS min_price,
       max(price) AS max_price
FROM {_PH} p GROUP BY source""")
def source_summary(spark, sf):
    return _round_avg(dashboard.source_summary(_history(spark, sf)))


@register("price_histogram", f"""
WITH bounds AS (SELECT min(price) AS lo, max(price) AS hi FROM {_PH} p),
     binned AS (SELECT source, lo, hi,
                       least(CAST(floor((price - lo) / (hi - lo) * 30) AS BIGINT) + 1, 30) AS bin
                FROM {_PH} p, bounds WHERE price IS NOT NULL)
SELECT source, bin, lo + (bin - 1) * ((hi - lo) / 30) AS bin_start,
       lo + bin * ((hi - lo) / 30) AS bin_end, count(*) AS n
FROM binned GROUP BY source, bin, lo, hi""")
def price_histogram(spark, sf):
    return dashboard.price_histogram(_history(spark, sf), 30, "source")


@register("alerts_per_hour", f"""
SELECT date_trunc('hour', alert_timestamp) AS hour, count(*) AS alerts
FROM {_ALERTS} a GROUP BY 1""")
def alerts_per_hour(spark, sf):
    return dashboard.alerts_per_hour(_alerts(spark, sf))


@register("top_events_by_prices", f"""
SELECT d.event_name, count(*) AS price_count, min(p.price) AS min_price,
       max(p.price) AS max_price
FROM {_PH} p JOIN {_DIM} d ON p.event_id = d.event_id
GROUP BY d.event_name ORDER BY price_count DESC, d.event_name LIMIT 5""")
def top_events_by_prices(spark, sf):
    return dashboard.top_events_by_prices(_history(spark, sf), _dimension(spark, sf), 5)


@register("table_counts", f"""
SELECT 'price_history' AS table_name, count(*) AS row_count FROM events
UNION ALL SELECT 'events', count(*) FROM {_DIM} d
UNION ALL SELECT 'price_drop_alerts', count(*) FROM {_ALERTS} a
UNION ALL SELECT 'tracked_events', count(*) FROM {_TRACKED} t""")
def table_counts(spark, sf):
    return dashboard.table_counts({
        "price_history": _history(spark, sf), "events": _dimension(spark, sf),
        "price_drop_alerts": _alerts(spark, sf), "tracked_events": _tracked(spark, sf)})


@register("latest_update", "SELECT max(ts) AS latest_update FROM events")
def latest_update(spark, sf):
    return dashboard.latest_update(_history(spark, sf))


@register("cheapest_per_event", f"""
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY event_id ORDER BY price, listing_id)
              AS INTEGER) AS price_rank
  FROM {_PH} p WHERE price IS NOT NULL) WHERE price_rank <= 100""")
def cheapest_per_event(spark, sf):
    return dashboard.cheapest_per_event(_history(spark, sf), 100)


@register("cheapest_3_per_event", f"""
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY event_id ORDER BY price, listing_id) AS INTEGER) AS price_rank
  FROM {_PH} p WHERE price IS NOT NULL) WHERE price_rank <= 3""")
def cheapest_3_per_event(spark, sf):
    return dashboard.cheapest_per_event(_history(spark, sf), 3)


@register("union_sources_missing", f"""
SELECT event_id, source, price, timestamp,
  CASE WHEN source IN ('click', 'view') THEN CAST(listing_id AS VARCHAR) END AS listing_id
FROM {_PH} p""")
def union_sources_missing(spark, sf):
    """A source without listing ids: the column is null for its rows."""
    h = _history(spark, sf).withColumn("listing_id", F.col("listing_id").cast("string"))
    web = F.col("source").isin("click", "view")
    return normalize.union_sources([h.where(web), h.where(~web | F.col("source").isNull()).drop("listing_id")])


@register("union_sources", f"SELECT * FROM {_PH} p")
def union_sources(spark, sf):
    """Sources arrive as separate feeds and are unioned into one stream.
    Stand-in: two feeds cut from ``events`` by source (the second with its
    columns in another order, matched by name)."""
    h = _history(spark, sf)
    web = F.col("source").isin("click", "view")
    feed_a = h.where(web)
    feed_b = h.where(~web | F.col("source").isNull()).select(*reversed(h.columns))
    return normalize.union_sources([feed_a, feed_b])


@register("alerts_display", f"""
SELECT d.event_name AS "Event", d.venue AS "Venue", CAST(NULL AS VARCHAR) AS "Section",
       CAST(NULL AS VARCHAR) AS "Row", CAST(NULL AS VARCHAR) AS "Seat",
       printf('$%.2f', a.old_price) AS "Old Price", printf('$%.2f', a.new_price) AS "New Price",
       printf('$%.2f', a.drop_amount) AS "Drop ($)", printf('%.1f%%', a.drop_percent) AS "Drop (%)",
       a.source AS "Source", strftime(a.alert_timestamp, '%Y-%m-%d %H:%M:%S') AS "Time"
FROM {_ALERTS} a JOIN {_DIM} d ON a.event_id = d.event_id""")
def alerts_display(spark, sf):
    none = F.lit(None).cast("string")
    a = (_alerts(spark, sf).join(_dimension(spark, sf), "event_id")
         .withColumns({"section": none, "row": none, "seat": none}))
    return dashboard.alerts_display(a)


@register("notification_text", f"""
SELECT a.listing_id, '**' || d.event_name || '**' AS msg_description, d.venue AS msg_venue,
       'Unknown Row N/A Seat N/A' AS msg_seat,
       printf('$%.2f → **$%.2f**', a.old_price, a.new_price) AS msg_price,
       printf('$%.2f (%.1f%%)', a.drop_amount, a.drop_percent) AS msg_drop,
       upper(a.source) AS msg_source
FROM {_ALERTS} a JOIN {_DIM} d ON a.event_id = d.event_id""")
def notification_text(spark, sf):
    a = _alerts(spark, sf).join(_dimension(spark, sf), "event_id")
    none = F.lit(None).cast("string")
    a = a.withColumns({"section": none, "row": none, "seat": none})
    return notify.message_texts(a).select("listing_id", "msg_description", "msg_venue",
                                          "msg_seat", "msg_price", "msg_drop", "msg_source")


# == thresholds and metrics =========================================================

def _rules(spark, sf):
    """One threshold rule per customer: target = whole dollars of
    |balance| / 20, any section and row, active for a non-negative balance."""
    c = table(spark, sf, "customer")
    return c.select(
        F.col("c_custkey").alias("id"), F.lit("default_user").alias("user_id"),
        F.col("c_custkey").alias("event_id"),
        F.floor(F.abs("c_acctbal") / 20).cast("decimal(10,2)").alias("target_price"),
        F.lit(None).cast("string").alias("section"), F.lit(None).cast("int").alias("max_row"),
        F.lit("webhook").alias("notification_method"),
        (F.col("c_acctbal") >= 0).alias("active"))


@register("threshold_triggers", """
SELECT c.c_custkey AS alert_id, e.user_id AS event_id,
       CAST(CAST(e.value AS DECIMAL(10,2)) AS DOUBLE) AS price,
       e.event_type AS source, e.event_id AS listing_id, e.ts AS triggered_at
FROM events e JOIN customer c ON e.user_id = c.c_custkey
WHERE c.c_acctbal >= 0 AND e.value <= CAST(floor(abs(c.c_acctbal) / 20) AS DECIMAL(10,2))""")
def threshold_triggers(spark, sf):
    h = _history(spark, sf).withColumns({
        "section": F.lit(None).cast("string"), "row": F.lit(None).cast("string"),
        "seat": F.lit(None).cast("string"), "listing_url": F.lit(None).cast("string")})
    t = thresholds.match_thresholds(h, _rules(spark, sf))
    t = t.select("alert_id", "event_id", "price", "source", "listing_id", "triggered_at")
    return _money_as_double(t, ["price"])


@register("threshold_best_offers", """
WITH cheapest AS (
  SELECT user_id, value, event_type, event_id, ts FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) AS rn
    FROM events WHERE value IS NOT NULL) WHERE rn = 1)
SELECT c.c_custkey AS alert_id, p.user_id AS event_id,
       CAST(CAST(p.value AS DECIMAL(10,2)) AS DOUBLE) AS price, p.event_type AS source,
       p.event_id AS listing_id, p.ts AS triggered_at
FROM cheapest p JOIN customer c ON p.user_id = c.c_custkey
WHERE c.c_acctbal >= 0 AND p.value <= CAST(floor(abs(c.c_acctbal) / 20) AS DECIMAL(10,2))""")
def threshold_best_offers(spark, sf):
    """One trigger per active rule with its cheapest qualifying listing."""
    h = _history(spark, sf).withColumns({
        "section": F.lit(None).cast("string"), "row": F.lit(None).cast("string"),
        "seat": F.lit(None).cast("string"), "listing_url": F.lit(None).cast("string")})
    t = thresholds.best_offers(h, _rules(spark, sf))
    t = t.select("alert_id", "event_id", "price", "source", "listing_id", "triggered_at")
    return _money_as_double(t, ["price"])


def _seated_history(spark, sf):
    """``events`` as price history with sections and rows, lettered ones too."""
    n = F.col("listing_id")
    return _history(spark, sf).withColumns({
        "section": F.when(n % 3 < 2, F.element_at(F.array(F.lit("A"), F.lit("B")), (n % 3 + 1).cast("int"))),
        "row": F.when(n % 5 == 0, F.lit("AA")).otherwise((n % 20).cast("string")),
        "seat": F.lit(None).cast("string"), "listing_url": F.lit(None).cast("string")})


_SEATED = """(SELECT user_id AS event_id, event_type AS source, value AS price, ts AS timestamp,
  event_id AS listing_id, CASE event_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' END AS section,
  CASE WHEN event_id % 5 = 0 THEN 'AA' ELSE CAST(event_id % 20 AS VARCHAR) END AS "row" FROM events)"""


def _many_rules(spark, sf):
    """Three rules a customer: any seat; section A up to row 10; section B."""
    c = table(spark, sf, "customer").withColumn("j", F.explode(F.array(*map(F.lit, range(3)))))
    return c.select(
        (F.col("c_custkey") * 3 + F.col("j")).alias("id"), F.col("c_custkey").alias("event_id"),
        (F.floor(F.abs("c_acctbal") / 20) * (F.col("j") + 1) / 2).cast("decimal(10,2)").alias("target_price"),
        F.when(F.col("j") == 1, F.lit("A")).when(F.col("j") == 2, F.lit("B")).alias("section"),
        F.when(F.col("j") == 1, F.lit(10)).alias("max_row"),
        ((F.col("c_acctbal") >= 0) | (F.col("j") == 0)).alias("active"))


_CROSSINGS = f"""
WITH h AS (
  SELECT *, last_value(CASE WHEN {_valid("price")} THEN price END IGNORE NULLS) OVER (
    PARTITION BY event_id, source ORDER BY timestamp, listing_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM {{prices}} p
), rules AS (
  SELECT c_custkey * 3 + j AS id, c_custkey AS event_id,
    CAST(floor(abs(c_acctbal) / 20) * (j + 1) / 2 AS DECIMAL(10,2)) AS target,
    CASE j WHEN 1 THEN 'A' WHEN 2 THEN 'B' END AS section, CASE j WHEN 1 THEN 10 END AS max_row
  FROM customer, (VALUES (0), (1), (2)) AS v(j) WHERE c_acctbal >= 0 OR j = 0
)
SELECT r.id AS alert_id, h.event_id, CAST(CAST(h.price AS DECIMAL(10,2)) AS DOUBLE) AS price, h.source, h.section,
  h."row", h.listing_id, h.timestamp AS triggered_at
FROM h JOIN rules r ON r.event_id = h.event_id
WHERE {_valid("h.price")} AND h.price <= r.target AND (before IS NULL OR before > r.target)
  AND (r.section IS NULL OR r.section = h.section)
  AND (r.max_row IS NULL OR TRY_CAST(h."row" AS INTEGER) <= r.max_row)"""


def _crossings(prices, spark, sf, **how):
    t = thresholds.threshold_crossings(prices, _many_rules(spark, sf), ("event_id", "source"), **how)
    t = t.select("alert_id", "event_id", "price", "source", "section", "row", "listing_id", "triggered_at")
    return _money_as_double(t, ["price"])


@register("threshold_crossings", _CROSSINGS.format(prices=_SEATED))
def threshold_crossings(spark, sf):
    """Prices that come down to a rule's target; several rules an event."""
    return _crossings(_seated_history(spark, sf), spark, sf)


@register("ewma_by_source", """
WITH r AS (SELECT event_type, value,
                  row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS i,
                  count(*) OVER (PARTITION BY event_type) AS n
           FROM events)
SELECT event_type,
       round(sum(CASE WHEN i = 1 THEN pow(0.9::DOUBLE, n - 1)
                      ELSE 0.1 * pow(0.9::DOUBLE, n - i) END * value), 6) AS ewma,
       max(n) AS n
FROM r GROUP BY event_type""")
def ewma_by_source(spark, sf):
    e = metrics.ewma(_events(spark, sf), ["event_type"], ORDER, PRICE, alpha=0.1)
    return e.withColumn("ewma", F.round("ewma", 6))


@register("throughput_5min", f"""
SELECT time_bucket(INTERVAL 5 minutes, timestamp) AS window_start, count(*) AS messages,
       count(*) / 5.0 AS per_minute
FROM {_PH} p GROUP BY 1""")
def throughput_5min(spark, sf):
    return metrics.throughput(_history(spark, sf), "timestamp", "5 minutes")


@register("wire_roundtrip", """
SELECT CAST(user_id AS VARCHAR) AS event_id, event_type AS source, value AS price,
       ts AS timestamp, CAST(event_id AS VARCHAR) AS listing_id
FROM events""")
def wire_roundtrip(spark, sf):
    """Price events written as JSON text and read back give the same values."""
    wire = normalize.to_wire(_price_events(spark, sf))
    back, _ = normalize.from_wire(wire)
    return back.select("event_id", "source", "price",
                       F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "listing_id")


@register("props_json", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def props_json(spark, sf):
    """Nested JSON field of a record, read with a declared schema."""
    e = _events(spark, sf)
    return e.select("event_id", F.from_json("props", "k INT").getField("k").alias("k"))
