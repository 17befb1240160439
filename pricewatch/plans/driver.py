"""How the driver's tables stand in for the price model.

- price events: ``events`` -- listing = (``user_id``, ``event_type``),
  source = ``event_type``, price = ``value``, time = ``ts``, listing id =
  ``event_id``; rows are ordered by (``ts``, ``event_id``).
- event dimension: ``customer`` joined to ``nation`` -- event id =
  ``c_custkey``, name = ``c_name``, venue = ``n_name``.
- dated dimension: ``orders`` (``o_orderdate`` is the event date).
- threshold rules: one per customer, derived from its balance and segment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Fixed values of the mapping.
KEYS = ("user_id", "event_type")
ORDER = ("ts", "event_id")
PRICE = "value"
AS_OF = "2024-01-31 00:00:00"
AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"
ONE_EVENT = 7                 # the event picked in single-event views
ONE_EVENT_NAME = "Customer#000000007"
ALERT_EVENT = 128             # an event among the newest alerts, for the filter-after-limit view


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
