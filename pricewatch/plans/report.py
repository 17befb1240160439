"""The dashboard as a batch report over a store written by the streaming
jobs (``price_history``, ``events`` deltas, ``price_drop_alerts``).

Every entry is a DataFrame; nothing is pulled to the driver except the id of
the event chosen by name (one row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricewatch import fixed
from pricewatch.operators import dashboard
from pricewatch.streaming.jobs import read_dimension


def _dimension(spark: SparkSession, store: str) -> DataFrame:
    return read_dimension(spark, f"{store}/events", f"{store}/events_base")


def dashboard_report(spark: SparkSession, store: str, hours: int = fixed.DEFAULT_HOURS,
                     event_name: str | None = None, as_of=None) -> dict[str, DataFrame]:
    """The dashboard's queries in its order. ``hours`` is the chosen range;
    statistics keep their fixed 48 hours, the alert list is the newest 20 and
    the event filter applies to those 20, as on the dashboard."""
    store = store.rstrip("/")
    history = spark.read.parquet(f"{store}/price_history").drop("batch_id")     # keeps date, for pruning
    events = _dimension(spark, store)
    alerts = spark.read.parquet(f"{store}/price_drop_alerts").drop("batch_id", "date")
    event_id = None
    if event_name is not None:
        chosen = dashboard.event_by_name(events, event_name).select("event_id").first()
        event_id = chosen[0] if chosen else None
    recent = dashboard.recent_prices(history, events, hours=hours, as_of=as_of,
                                     event_id=event_id)
    shown_alerts = dashboard.recent_alerts(alerts, events, fixed.ALERTS_LIMIT, event_id=event_id)
    return {
        "events": dashboard.list_events(events),
        "stats": dashboard.price_stats(history, fixed.DEFAULT_HOURS, as_of, event_id),
        "recent_prices": recent,
        "price_series": dashboard.avg_price_by_time_source(recent),
        "source_table": dashboard.source_summary(recent),
        "price_histogram": dashboard.price_histogram(recent, top_k=True),
        "recent_alerts": dashboard.alerts_display(shown_alerts),
        "alerts_chart": dashboard.alerts_per_hour(
            dashboard.recent_alerts(alerts, events, fixed.ALERTS_LIMIT)),
        "status": dashboard.table_counts(
            {"tracked_events": events, "price_history": history, "price_drop_alerts": alerts}),
        "latest_update": dashboard.latest_update(history),
    }


def write_report(report: dict[str, DataFrame], out: str) -> None:
    """Each part as JSON lines under ``out/<name>``."""
    for name, df in report.items():
        df.write.mode("overwrite").json(f"{out.rstrip('/')}/{name}")
