"""The stored tables: typed, registered in the catalog, written in
partitions that time filters can prune."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewatch import fixed, schemas
from pricewatch.sources import dated, files

TABLES = schemas.TABLES

# Tables appended by time, and the time column their date partition comes from.
DATED = {"price_history": "timestamp", "price_drop_alerts": "alert_timestamp",
         "alert_triggers": "triggered_at", "system_metrics": "timestamp"}


def create_store(spark: SparkSession, root: str) -> list[str]:
    """Register the six tables as Parquet tables under ``root`` (idempotent;
    dated tables are partitioned by ``date`` and ``batch_id``, the layout that
    the streams write) and return the table names the catalog lists.
    Constraints are enforced by the ingest checks, not by the table."""
    for name, schema in TABLES.items():
        if spark.catalog.tableExists(name):
            continue
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        part = ""
        if name in DATED:
            cols += ", `date` date, `batch_id` int"
            part = " PARTITIONED BY (`date`, `batch_id`)"
        spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet{part} "
                  f"LOCATION '{root.rstrip('/')}/{name}'")
    return sorted(t.name for t in spark.catalog.listTables() if t.name in TABLES)


def append_dated(df: DataFrame, root: str, table: str, replace_days: bool = False, load: int = 0) -> None:
    """Write rows to a dated table, partitioned by day of its time column,
    so ``ts >= as_of - n hours`` reads only the recent partitions; the new
    partitions are then made known to the catalog table.

    ``load`` is the partition below the day (a stream's batch id, or the number
    of a batch load). ``replace_days=True`` replaces that load's days that are
    present in ``df`` (dynamic partition overwrite) and leaves others alone: a
    daily load that is run again, after a failure for instance, does not
    duplicate rows. Rows are dealt by day before they are written, very large
    days over several tasks, so that a load makes few files a day."""
    ts = DATED[table]
    path = f"{root.rstrip('/')}/{table}"
    rows = df.drop(dated.DAY, dated.BATCH).withColumn(dated.DAY, F.to_date(ts)).withColumn(dated.BATCH, F.lit(load))
    w = rows.hint("rebalance", dated.DAY).write.partitionBy(dated.DAY, dated.BATCH)
    if replace_days:
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = w.mode("append")
    w.parquet(path)
    add_partitions(df.sparkSession, root, table, load)


def add_partitions(spark: SparkSession, root: str, table: str, load: int) -> None:
    """Tell the catalog the partitions of one load, by name (nothing else is
    listed). Nothing to do for a table that isn't registered."""
    if not spark.catalog.tableExists(table):
        return
    path = f"{root.rstrip('/')}/{table}"
    spec = [f"PARTITION (`date` = '{d}', `batch_id` = {load})" for d in dated.days(spark, path)
            if files.exists(spark, f"{path}/date={d}/batch_id={load}")]
    if spec:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(spec)}")


def read_dated(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{table}")


def retain(df: DataFrame, ts: str, stream: str, as_of=None) -> DataFrame:
    """Rows still inside the retention period of ``stream`` (see
    ``fixed.RETENTION_DAYS``); on a dated table older days aren't read."""
    return dated.recent(df, ts, fixed.RETENTION_DAYS[stream] * 24, as_of)


def drop_expired(spark: SparkSession, root: str, name: str, stream: str, as_of: dt.datetime) -> list[str]:
    """Delete the days of the feed or dated table ``name`` that lie wholly
    outside the retention period of ``stream`` at ``as_of``; partitions of a
    registered table are dropped from the catalog, too. Returns the days."""
    before = (as_of - dt.timedelta(days=fixed.RETENTION_DAYS[stream])).date()
    gone = dated.drop_days(spark, f"{root.rstrip('/')}/{name}", before)
    if gone and name in TABLES and spark.catalog.tableExists(name):
        known = [dict(p.split("=") for p in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
        old = [f"PARTITION (`date` = '{k['date']}', `batch_id` = {k['batch_id']})" for k in known if k["date"] in gone]
        if old:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(old)}")
    return gone


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
                num_partitions: int | None = None) -> None:
    """Append to a database table through Spark's JDBC writer (the database's
    driver jar must be on the classpath; none is bundled here). Writers per
    partition are capped with ``num_partitions`` so the database sees a
    bounded number of connections."""
    out = df.coalesce(num_partitions) if num_partitions else df
    out.write.mode("append").jdbc(url, table, properties=properties or {})
