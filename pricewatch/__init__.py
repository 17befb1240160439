"""pricewatch: price-change analytics on Spark.

Listing feeds are normalised into one price-event schema, checked and stored as
typed history; a per-listing detector classifies every update (new, same,
drop, increase, invalid) against the running maximum of earlier valid prices,
in batch (windows) and as a stateful Structured Streaming query. The dashboard
questions (recent prices and alerts, statistics, averages, histograms, alerts
per hour, throughput) are ordinary DataFrame operators.

Entry points: ``operators.changes`` (detector), ``operators.dashboard``,
``operators.history`` (ingest, dimension, alert store), ``operators.normalize``
(source adapters, JSON wire format), ``operators.thresholds``,
``operators.notify``, ``operators.metrics``, ``streaming.jobs`` (streaming
processes) and ``python -m pricewatch`` (command line).
"""

from pricewatch.session import checkpoint_dir, get_spark, sized_conf

__all__ = ["get_spark", "checkpoint_dir", "sized_conf"]
