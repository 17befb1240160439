"""User price thresholds: fire a trigger when a price reaches a rule.

A rule matches a price event when the rule is active, names the same event,
the price is at or below ``target_price``, its ``section`` is null (any
section) or equal, and its ``max_row`` is null or the row, read as a whole
number, is at or below it. A lettered row never satisfies ``max_row``. Prices
that are missing, no number, zero or below never fire.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewatch.functions.columns import money, valid_price
from pricewatch.operators.changes import EVENT_ORDER, LISTING_KEYS
from pricewatch.operators.scan import prior_scan

BAND = 1.25             # prices of a band differ by at most this factor


def match_thresholds(prices: DataFrame, rules: DataFrame) -> DataFrame:
    """One trigger row per (rule, matching price event).

    The equi key is ``event_id``; the rest are residual predicates evaluated
    in the join. The rules side is sized at run time by AQE (broadcast when
    small); a hot event is split by AQE's skew-join handling."""
    r = (rules.where(F.coalesce(F.col("active"), F.lit(False)))
         .select(F.col("id").alias("alert_id"), "event_id", "target_price",
                 F.col("section").alias("_rule_section"), F.col("max_row").alias("_max_row")))
    p = prices.where(valid_price("price")).alias("p")
    cond = ((F.col("p.event_id") == F.col("r.event_id"))
            & (F.col("p.price") <= F.col("r.target_price"))
            & (F.col("r._rule_section").isNull()
               | (F.col("p.section") == F.col("r._rule_section")))
            & (F.col("r._max_row").isNull()
               | (F.col("p.row").try_cast("int") <= F.col("r._max_row"))))
    return (p.join(r.alias("r"), cond, "inner")
            .select("r.alert_id", "p.event_id", money(F.col("p.price")).alias("price"),
                    "p.source", "p.section", "p.row", "p.seat", "p.listing_id",
                    "p.listing_url", F.col("p.timestamp").alias("triggered_at")))


def best_offers(prices: DataFrame, rules: DataFrame) -> DataFrame:
    """One trigger per active rule: its cheapest qualifying listing (ties:
    smallest listing id), when that price is at or below the target.

    Prices are first reduced to the cheapest listing per (event, section,
    row), an aggregation that combines map-side; rules are then matched
    against these offers, whose number per event is bounded by the seats of
    a venue, not by the number of price updates. No (price, rule) pairs are
    formed. Same match rules as ``match_thresholds``."""
    row_num = F.col("row").try_cast("int")
    offer = F.min_by(F.struct("price", "listing_id", "source", "seat", "listing_url", "timestamp"),
                     F.struct("price", "listing_id"))
    offers = (prices.where(valid_price("price"))
              .groupBy("event_id", "section", "row", row_num.alias("_row_num"))
              .agg(offer.alias("o"))
              .select("event_id", "section", "row", "_row_num", "o.*"))
    r = (rules.where(F.coalesce(F.col("active"), F.lit(False)))
         .select(F.col("id").alias("alert_id"), "event_id", "target_price",
                 F.col("section").alias("_rule_section"), F.col("max_row").alias("_max_row")))
    o = offers.alias("o")
    cond = ((F.col("o.event_id") == F.col("r.event_id"))
            & (F.col("o.price") <= F.col("r.target_price"))
            & (F.col("r._rule_section").isNull() | (F.col("o.section") == F.col("r._rule_section")))
            & (F.col("r._max_row").isNull() | (F.col("o._row_num") <= F.col("r._max_row"))))
    matched = o.join(r.alias("r"), cond, "inner")
    pick = F.min_by(F.struct("o.price", "o.listing_id", "o.source", "o.section", "o.row",
                             "o.seat", "o.listing_url", "o.timestamp"),
                    F.struct("o.price", "o.listing_id"))
    return (matched.groupBy("r.alert_id", "r.event_id").agg(pick.alias("b"))
            .select("alert_id", "event_id", money(F.col("b.price")).alias("price"),
                    F.col("b.source").alias("source"), F.col("b.section").alias("section"),
                    F.col("b.row").alias("row"), F.col("b.seat").alias("seat"),
                    F.col("b.listing_id").alias("listing_id"),
                    F.col("b.listing_url").alias("listing_url"),
                    F.col("b.timestamp").alias("triggered_at")))


def _band(x: Column) -> Column:
    """The band of a price above zero; bands never go down as prices go up."""
    return F.floor(F.log(x.cast("double")) / F.log(F.lit(BAND))).cast("int")


def threshold_crossings(prices: DataFrame, rules: DataFrame, keys: Sequence[str] = LISTING_KEYS,
                        order: Sequence[str] = EVENT_ORDER, seed: DataFrame | None = None,
                        hot_rows: int = 1_000_000, probe_fraction: float | None = None) -> DataFrame:
    """A trigger row where a listing's price comes down to a rule's target:
    it is at or below the target now, and the listing's price before was above
    it, or there was none. A listing that stays below fires once. Section, row,
    activity and validity as in ``match_thresholds``; invalid prices neither
    fire nor count as the price before. ``seed`` (``keys`` + ``_pw_seed``) is
    each listing's price from before ``prices``.

    Only rows whose price fell, or that are a listing's first, can fire. Rules
    and rows meet by event and price band: a row takes part in the bands from
    its price up to the price before (for a first one the event's highest
    target), which are few, so a hot event with many rules compares a row with
    little more than the rules it crosses, not with all of them."""
    order, keys = list(order), list(keys)
    r = (rules.where(F.coalesce(F.col("active"), F.lit(False)) & (F.col("target_price") > 0))
         .select(F.col("id").alias("alert_id"), F.col("event_id").alias("_rule_event"), "target_price",
                 F.col("section").alias("_rule_section"), F.col("max_row").alias("_max_row")))
    top = r.groupBy("_rule_event").agg(F.max("target_price").cast("double").alias("_top"))
    p = F.col("price")
    valid = valid_price("price")
    fell = prior_scan(prices, keys, order, F.when(valid, p), "_before", order[0], how="last", seed=seed,
                      hot_rows=hot_rows, probe_fraction=probe_fraction) \
        .where(valid & (F.col("_before").isNull() | (p < F.col("_before"))))
    banded = fell.join(top, F.col("event_id") == F.col("_rule_event")).drop("_rule_event") \
        .where(p <= F.col("_top")) \
        .withColumn("_band", F.explode(F.sequence(_band(p), _band(F.least("_before", "_top")))))
    ruled = r.withColumn("_rule_band", _band(F.col("target_price")))
    crossed = ((F.col("event_id") == F.col("_rule_event")) & (F.col("_band") == F.col("_rule_band"))
               & (p <= F.col("target_price"))
               & (F.col("_before").isNull() | (F.col("_before") > F.col("target_price")))
               & (F.col("_rule_section").isNull() | (F.col("section") == F.col("_rule_section")))
               & (F.col("_max_row").isNull() | (F.col("row").try_cast("int") <= F.col("_max_row"))))
    return banded.join(ruled, crossed).select(
        "alert_id", "event_id", money(p).alias("price"), "source", "section", "row", "seat", "listing_id",
        "listing_url", F.col("timestamp" if "timestamp" in prices.columns else order[0]).alias("triggered_at"))


def last_prices(prices: DataFrame, keys: Sequence[str] = LISTING_KEYS,
                order: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """Each listing's last valid price (``value``) and its place in the order
    (``last_order``): what a later batch needs as ``seed``."""
    last = F.struct(*[F.col(c) for c in order])
    return prices.where(valid_price("price")).groupBy(*keys).agg(
        F.max_by("price", last).alias("value"), F.max(last).alias("last_order"))


def move_last_triggered(rules: DataFrame, triggers: DataFrame) -> DataFrame:
    """The rules with ``last_triggered`` at their newest trigger, never moved
    back. Triggers are reduced to one row a rule before the join."""
    newest = triggers.groupBy(F.col("alert_id").alias("id")).agg(F.max("triggered_at").alias("_newest"))
    return rules.join(newest, "id", "left").withColumn(
        "last_triggered", F.greatest("last_triggered", "_newest")).select(rules.columns)
