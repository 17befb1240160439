"""Written intermediates in the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from pricewatch.session import scratch_path
from pricewatch.sources import files


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Spark deletes a query's shuffle files when the query ends, rather than when
# the driver's collector finds its plan unused.
FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settle(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir`` (or ``folder``) and read it
    back: its lineage ends there, a lost executor costs no recomputation, and a
    second reader doesn't run it again. Its shuffle files go."""
    spark = df.sparkSession
    path = f"{folder or scratch_path(spark, '').rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    was = spark.conf.get(FREE, "false")
    spark.conf.set(FREE, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FREE, was)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Written intermediates of one operator, which go once its result, too, is
    written and no longer reads them. After a failure they stay, as all others
    do, for the store to expire."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")

    def settle(self, df: DataFrame, name: str) -> DataFrame:
        return settle(df, name, self.folder)

    def release(self) -> None:
        files.delete(self.spark, self.folder)


def spare(df: DataFrame, name: str) -> str:
    """``name``, with underscores added while ``df`` has a column of it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
