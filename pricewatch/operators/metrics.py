"""Counters and rolling figures: exponentially weighted mean, latest value
per key, throughput per time window, ingest counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewatch import fixed


def ewma(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str,
         alpha: float = fixed.EWMA_ALPHA, chunk: str = "minute", out: str = "ewma") -> DataFrame:
    """Exponentially weighted mean of ``value`` per ``group`` in ``order``,
    seeded with the first value: ``m = x1``, then ``m = (1-a)*m + a*x``.

    While the mean is 0 the next value re-seeds it, so for non-negative input
    the leading zeros are skipped. Closed form with ``R_i`` = rows after row
    ``i``: ``m = sum(a*(1-a)^R_i * x_i) + (1-a)^(R_s+1) * x_s`` for the seed
    row ``s``. ``R_i`` is found in two levels, rows after ``i`` within its
    (group, time chunk) plus the rows of later chunks, so a group that holds
    a large share of the data is still spread over many tasks and nothing is
    collected into one list."""
    group, order = list(group), list(order)
    keep = F.lit(1.0 - alpha)
    c = F.date_trunc(chunk, F.col(order[0]))
    within = Window.partitionBy(*group, "_chunk").orderBy(*[F.col(o).desc() for o in order])
    rows = (df.select(*group, *order, value).withColumn("_chunk", c)
            .withColumn("_after", F.row_number().over(within) - 1))
    positive = F.col(value) > 0
    per_chunk = rows.groupBy(*group, "_chunk").agg(
        F.sum(F.lit(alpha) * F.pow(keep, F.col("_after")) * F.col(value)).alias("_s"),
        F.count(F.lit(1)).alias("_n"),
        # the seed candidate of the chunk: its first positive value
        F.min_by(F.struct(F.col(value).alias("x"), F.col("_after").alias("after")),
                 F.when(positive, F.struct(*[F.col(o) for o in order]))).alias("_seed"))
    later = Window.partitionBy(*group).orderBy(F.col("_chunk").desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    placed = per_chunk.withColumn("_later", F.coalesce(F.sum("_n").over(later), F.lit(0)))
    seed_rows_after = F.col("_seed.after") + F.col("_later")
    agg = placed.groupBy(*group).agg(
        F.sum(F.col("_s") * F.pow(keep, F.col("_later"))).alias("_sum"),
        F.min_by(F.struct(F.col("_seed.x").alias("x"), seed_rows_after.alias("after")),
                 F.when(F.col("_seed").isNotNull(), F.col("_chunk"))).alias("_first"),
        F.sum("_n").alias("n"))
    seed_term = F.coalesce(F.pow(keep, F.col("_first.after") + 1) * F.col("_first.x"), F.lit(0.0))
    return agg.select(*group, (F.col("_sum") + seed_term).alias(out), "n")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   cols: Sequence[str]) -> DataFrame:
    """Latest value of ``cols`` per key (a compacted topic's view): one
    ``max_by`` aggregation, combined map-side."""
    pick = F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(*[F.col(o) for o in order]))
    return (df.groupBy(*keys).agg(pick.alias("_last"))
            .select(*keys, *[F.col(f"_last.{c}").alias(c) for c in cols]))


def throughput(df: DataFrame, ts: str, every: str = fixed.THROUGHPUT_WINDOW) -> DataFrame:
    """Messages per tumbling window and per minute within it."""
    minutes = _minutes(every)
    return (df.groupBy(F.window(ts, every).start.alias("window_start"))
            .agg(F.count(F.lit(1)).alias("messages"))
            .withColumn("per_minute", F.col("messages") / F.lit(float(minutes))))


def _minutes(every: str) -> float:
    n, unit = every.split()
    n = float(n)
    unit = unit.rstrip("s")
    return {"second": n / 60, "minute": n, "hour": n * 60, "day": n * 1440}[unit]


def counters(parts: dict[str, DataFrame]) -> DataFrame:
    """Row counts of several frames as ``(metric_name, metric_value)`` rows,
    the shape of the system-metrics table."""
    out = None
    for name, d in parts.items():
        one = d.agg(F.count(F.lit(1)).alias("metric_value")).select(
            F.lit(name).alias("metric_name"), "metric_value")
        out = one if out is None else out.unionByName(one)
    return out


def tall(counted: DataFrame) -> DataFrame:
    """One row of counters as (metric_name, metric_value) rows."""
    return counted.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("metric_name"), F.col(n).alias("metric_value")) for n in counted.columns]))
        .alias("m")).select("m.*")


def ingest_metrics(tagged: DataFrame, created: DataFrame,
                   duplicates: DataFrame | None = None) -> DataFrame:
    """The storage side's counters: messages received, prices stored, errors
    (rejects), events created and, when deduplicating, duplicates skipped.
    ``tagged`` is the ingest frame with its ``reject_reason`` column, so the
    first three come from one pass."""
    reason = F.col("reject_reason")
    one_pass = tagged.agg(F.count(F.lit(1)).alias("messages_received"),
                          F.count_if(reason.isNull()).alias("prices_stored"),
                          F.count_if(reason.isNotNull()).alias("errors"))
    rows = tall(one_pass)
    parts = {"events_created": created}
    if duplicates is not None:
        parts["duplicates_skipped"] = duplicates
    return rows.unionByName(counters(parts))


def alert_metrics(alerts: DataFrame, stored: DataFrame, rejects: DataFrame) -> DataFrame:
    """The alert side's counters: alerts processed, stored, errors. Nothing is
    posted from Spark, so there is no "sent" counter."""
    return counters({"alerts_processed": alerts, "alerts_stored": stored, "errors": rejects})


def as_system_metrics(counts: DataFrame, at=None) -> DataFrame:
    """``(metric_name, metric_value)`` rows as system-metrics records: value
    as DECIMAL(15,2), stamped with ``at`` (default now)."""
    stamp = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    return counts.select("metric_name", F.col("metric_value").cast("decimal(15,2)").alias("metric_value"),
                         stamp.alias("timestamp"))


def latest_metrics(system_metrics: DataFrame) -> DataFrame:
    """The compacted view: the newest value of every metric."""
    return latest_per_key(system_metrics, ["metric_name"], ["timestamp"],
                          ["metric_value", "timestamp"])
