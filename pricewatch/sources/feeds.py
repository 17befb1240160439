"""Readers and writers for price feeds: landed API responses, price-event
JSON (files or Kafka), and the stored tables.

Kafka is an option of the same readers; its connector is not bundled with
this package, so Kafka paths are only exercised on a cluster that has it.
File sources carry the same logic and are what the tests use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewatch.operators import normalize
from pricewatch.schemas import RAW_RESPONSE, THRESHOLD_RULES, TRACKED_EVENT
from pricewatch.sources.dated import Feed


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_tracked_events(spark: SparkSession, path: str) -> DataFrame:
    """Tracked-event descriptors ``{event_id, name, venue, date}`` (JSON lines)."""
    return spark.read.schema(TRACKED_EVENT).json(path)


def read_rules_text(spark: SparkSession, path: str) -> DataFrame:
    """Threshold rules (JSON lines), all fields as text; the constraint check
    casts them and says what doesn't fit."""
    return spark.read.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in THRESHOLD_RULES])) \
        .json(path)


def read_responses(spark: SparkSession, path: str, stream: bool = False,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed API responses ``{event_id, listings: [...]}``, one per line,
    exploded to one row per listing."""
    if stream:
        r = spark.readStream.schema(RAW_RESPONSE)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        df = r.json(path)
    else:
        df = spark.read.schema(RAW_RESPONSE).json(path)
    return normalize.explode_listings(df)


def _lines(spark: SparkSession, path: str, stream: bool, max_files_per_trigger: int | None) -> DataFrame:
    if not stream:
        return spark.read.text(path)
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def read_price_events(spark: SparkSession, path: str, stream: bool = False,
                      max_files_per_trigger: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Price-event JSON lines -> (typed events, rejects). Lines are read as
    text so that a malformed line becomes a reject instead of an error."""
    return normalize.from_wire(_lines(spark, path, stream, max_files_per_trigger), "value")


def read_tagged_events(spark: SparkSession, path: str, stream: bool = False,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Price-event JSON lines, parsed once, good and bad ones in one frame
    (``normalize.tagged_wire``): for jobs that write both sides."""
    return normalize.tagged_wire(_lines(spark, path, stream, max_files_per_trigger), "value")


def price_event_feed(path: str, max_batches: int | None = None) -> Feed:
    """The normalizer's feed, followed by its log."""
    return Feed(path, "text", normalize.tagged_wire, max_batches)


def log_records(raw: DataFrame) -> DataFrame:
    """Records of a message log (value, timestamp, partition, offset), as the
    Kafka source gives them, parsed and tagged; the log's place is kept as
    (kafka_timestamp, partition, offset), by which the jobs then order."""
    shaped = raw.select(F.col("value").cast("string").alias("value"),
                        F.col("timestamp").alias("kafka_timestamp"), "partition", "offset")
    return normalize.tagged_wire(shaped, "value", keep=("kafka_timestamp", "partition", "offset"))


def read_kafka(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
               max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Price events from a Kafka topic, tagged. ``starting`` is ``earliest``
    (the storage reader) or ``latest`` (detector, alerts); progress lives in
    the query's checkpoint, which replaces a consumer group."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return log_records(r.load())


def read_landed_log(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same from Parquet files of a topic (an archive of it), as a stream."""
    r = spark.readStream.schema("value string, timestamp timestamp, partition int, offset long")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return log_records(r.parquet(path))


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    """Options for ``writeStream.format("kafka")`` of ``to_wire`` output:
    every replica acknowledges, snappy batches."""
    return {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all",
            "kafka.compression.type": "snappy"}


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: list[str] | None = None,
                fmt: str = "parquet") -> None:
    """Write one micro-batch's state delta under ``batch_id=<n>``, replacing
    that folder. For outputs that others follow, see ``dated.write``."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.format(fmt).save(f"{path.rstrip('/')}/batch_id={batch_id}")
