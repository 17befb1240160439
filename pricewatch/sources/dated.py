"""Feeds on storage: rows by day and batch, and a log of finished batches.

    <feed>/date=2024-01-31/batch_id=7/part-...    rows
    <feed>/_log/begun/batch_id=7/                 when the batch was first tried
    <feed>/_log/done/batch_id=7/                  its days with their row counts

A batch is written once. A replay finds it in the log and writes nothing; a
replay of a batch that was cut off writes only the days that aren't whole, and
stamps its rows with the time of the first try, so they are the same rows. The
files that a reader may have seen are therefore never replaced by others of
another name, and a stream behind this one sees each row once. ``Feed`` reads
by the log: batch after batch, only finished ones, without listing the feed.

Whole days go away by ``drop_days``. A filter on ``date`` prunes folders;
``recent`` adds one to a time filter.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewatch.functions.columns import as_of_col, since
from pricewatch.sources import files

DAY, BATCH = "date", "batch_id"
PINNED = T.StructType([T.StructField("value", T.StringType())])
DONE = T.StructType([T.StructField("day", T.StringType()), T.StructField("rows", T.LongType()),
                     T.StructField("schema", T.StringType()), T.StructField(BATCH, T.LongType())])


def _log(path: str, kind: str, batch_id: int | None = None) -> str:
    folder = f"{path.rstrip('/')}/_log/{kind}"
    return folder if batch_id is None else f"{folder}/{BATCH}={batch_id}"


def _folder(path: str, day: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/{DAY}={day}/{BATCH}={batch_id}"


def _entry(spark: SparkSession, folder: str, schema: T.StructType):
    """A log entry's rows; none before its file is there."""
    return spark.read.schema(schema).json(folder).collect() if files.exists(spark, folder) else []


def is_feed(spark: SparkSession, path: str) -> bool:
    return files.exists(spark, f"{path.rstrip('/')}/_log")


def pinned(spark: SparkSession, path: str, batch_id: int, name: str, make: Callable[[], str]) -> str:
    """The value that the first try of this batch made; replays get the same."""
    folder = _log(path, name, batch_id)
    found = _entry(spark, folder, PINNED)
    if found:
        return found[0].value
    value = make()
    spark.range(1, numPartitions=1).select(F.lit(value).alias("value")).write.mode("overwrite").json(folder)
    return value


def begin(spark: SparkSession, path: str, batch_id: int) -> dt.datetime:
    """The time at which this batch was first tried."""
    return dt.datetime.fromisoformat(pinned(
        spark, path, batch_id, "begun", lambda: dt.datetime.now(dt.timezone.utc).isoformat()))


def at(began: dt.datetime) -> Column:
    """The time of ``begin`` as a timestamp."""
    return F.lit(began.isoformat()).cast("timestamp")


def finished(spark: SparkSession, path: str, batch_id: int) -> bool:
    return bool(_entry(spark, _log(path, "done", batch_id), DONE))


def write(df: DataFrame, path: str, batch_id: int, ts: str | None = None,
          began: dt.datetime | None = None, fmt: str = "parquet") -> bool:
    """Write a batch under the days of its time column ``ts`` (rows without a
    time, or all without ``ts``: the day of the first try), then log it. False
    when it was finished before. ``df`` is read twice: persist it if costly."""
    spark = df.sparkSession
    if finished(spark, path, batch_id):
        return False
    began = began or begin(spark, path, batch_id)
    today = F.lit(began.date())
    rows = df.drop(DAY, BATCH)
    schema = rows.schema if ts is None or fmt != "text" else rows.drop(ts).schema
    rows = rows.withColumn(DAY, F.coalesce(F.to_date(ts), today) if ts else today)
    if fmt == "text" and ts:
        rows = rows.drop(ts)
    days = {str(r[DAY]): r["count"] for r in rows.groupBy(DAY).count().collect()}
    todo = [d for d, n in days.items() if not _whole(spark, _folder(path, d, batch_id), n, schema, fmt)]
    if not days:        # an empty file, so that the feed has a schema to read
        rows.drop(DAY).write.mode("overwrite").format(fmt).save(_folder(path, str(began.date()), batch_id))
    elif todo:
        if len(todo) < len(days):
            rows = rows.where(F.col(DAY).cast("string").isin(todo))
        (rows.withColumn(BATCH, F.lit(batch_id)).write.partitionBy(DAY, BATCH).mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").format(fmt).save(path))
    text = json.dumps(schema.jsonValue())
    entry = [(d, n, text) for d, n in sorted(days.items())] or [(None, 0, text)]
    spark.createDataFrame(entry, T.StructType(DONE.fields[:-1])).coalesce(1) \
        .write.mode("overwrite").json(_log(path, "done", batch_id))
    return True


def _whole(spark: SparkSession, folder: str, n: int, schema: T.StructType, fmt: str) -> bool:
    return files.exists(spark, folder) and spark.read.schema(schema).format(fmt).load(folder).count() == n


class Feed(NamedTuple):
    """A feed read by its log. ``parse`` is applied to the rows of each batch
    (JSON lines to price events, for instance)."""
    path: str
    fmt: str = "parquet"
    parse: Callable[[DataFrame], DataFrame] | None = None
    max_batches: int | None = None

    def entries(self, spark: SparkSession) -> DataFrame:
        """The log as a stream: a row for each day of each finished batch."""
        r = spark.readStream.schema(DONE)
        if self.max_batches:
            r = r.option("maxFilesPerTrigger", self.max_batches)
        return r.json(_log(self.path, "done"))

    def rows(self, entries: DataFrame, empty: bool = False) -> DataFrame | None:
        """The rows behind a micro-batch of log entries. Days that retention
        has dropped meanwhile have none. Without any entry the rows' columns
        aren't known, which is an error, or None with ``empty``."""
        spark = entries.sparkSession
        folders: dict[str, list[str]] = {}      # by schema, of which a feed has few
        for r in entries.collect():             # a row for each batch and day in it
            some = folders.setdefault(r.schema, [])
            folder = _folder(self.path, r.day, r[BATCH])
            if r.day and files.exists(spark, folder):
                some.append(folder)
        if not folders and empty:
            return None
        parts = [self._load(spark, T.StructType.fromJson(json.loads(s)), f) for s, f in sorted(folders.items())]
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        return self.parse(rows) if self.parse else rows

    def _load(self, spark: SparkSession, schema: T.StructType, folders: list[str]) -> DataFrame:
        if folders:
            return spark.read.schema(schema).option("basePath", self.path).format(self.fmt).load(folders)
        return spark.createDataFrame([], schema).withColumns(
            {DAY: F.lit(None).cast("date"), BATCH: F.lit(None).cast("int")})


def days(spark: SparkSession, path: str) -> list[str]:
    """The days that a feed or dated table has folders of."""
    return [n[len(DAY) + 1:] for n in files.children(spark, path) if n.startswith(f"{DAY}=")]


def drop_days(spark: SparkSession, path: str, before: dt.date) -> list[str]:
    """Delete the folders of all days before ``before``, and the log entries of
    batches of which nothing is left (never of the newest one). Returns the
    days that went."""
    gone = [d for d in days(spark, path) if d < before.isoformat()]
    for d in gone:
        files.delete(spark, f"{path.rstrip('/')}/{DAY}={d}")
    if files.exists(spark, _log(path, "done")):
        left = spark.read.schema(DONE).json(_log(path, "done")).groupBy(BATCH) \
            .agg(F.max("day").alias("day"))
        newest = left.agg(F.max(BATCH)).first()[0]
        for r in left.where((F.col("day") < before.isoformat()) & (F.col(BATCH) < newest)).toLocalIterator():
            for kind in files.children(spark, f"{path.rstrip('/')}/_log"):
                files.delete(spark, _log(path, kind, r[BATCH]))
    return gone


def recent(df: DataFrame, ts: str, hours: int, as_of=None) -> DataFrame:
    """Rows of the last ``hours``. On a dated table the bound holds for the
    day, too, so older folders aren't read; it is a day lower, so that a
    session in another time zone than the writer's loses nothing."""
    rows = df.where(since(ts, hours, as_of))
    if DAY not in df.columns or df.schema[DAY].dataType != T.DateType():
        return rows
    first = F.to_date(as_of_col(as_of) - F.make_dt_interval(hours=F.lit(int(hours)), days=F.lit(1)))
    return rows.where(F.col(DAY) >= first)
