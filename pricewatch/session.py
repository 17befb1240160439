"""Spark session with the settings every operator here assumes."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on. Shuffle partitions is only a default for
# local runs; on a cluster pass a value sized to the data (about 128-256 MB of
# shuffle input per partition) and let AQE coalesce small ones.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


# Streaming state kept in RocksDB (off-heap, spills to local disk, snapshots to
# the checkpoint) rather than in the executor heap: the detector holds one
# baseline per listing ever seen.
STREAMING_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "pricewatch", extra: dict | None = None,
              streaming: bool = False) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if streaming:
        conf.update(STREAMING_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is only read; there,
    an unset one is an error. In local mode (tests) a fresh scratch folder is
    created and set.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir is unset; on a cluster it must name shared storage")
        path = tempfile.mkdtemp(prefix="pricewatch-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediates."""
    return os.path.join(checkpoint_dir(spark), name)


def sized_conf(input_bytes: int, partition_bytes: int = 256 * 1024 * 1024,
               max_partitions: int = 50_000) -> dict[str, str]:
    """Shuffle settings for an input of ``input_bytes``: about one shuffle
    partition per ``partition_bytes`` of input, at most ``max_partitions``
    (every reducer fetches from every map task, and after column pruning a
    shuffle is far smaller than its input); AQE coalesces small partitions
    and splits skewed ones. File splits stay at most 256 MB. Pass the
    result as ``extra`` to ``get_spark`` or set it on a running session."""
    partitions = min(max_partitions, max(8, -(-int(input_bytes) // int(partition_bytes))))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(min(partition_bytes, 256 * 1024 * 1024)),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }
