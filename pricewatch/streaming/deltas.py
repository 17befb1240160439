"""State of a stream as a table: a delta a batch, folded now and then.

    <path>/batch_id=7/            what batch 7 changed
    <base>/through_batch=5/       all up to batch 5, folded

Readers take the newest base and the deltas after it, found by folder names, so
what a micro-batch lists and reads doesn't grow with the stream's age once
``compact`` runs from time to time. Versions are never rewritten: a failed
compaction leaves the one before current. A replay of the last batch reads what
its first try read, as a version that includes it isn't taken for it; therefore
the version before the newest, and the deltas after that, stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pricewatch.sources import files

DELTA, BASE = "batch_id=", "through_batch="


def _numbers(spark: SparkSession, path: str | None, prefix: str) -> list[int]:
    names = files.children(spark, path) if path else []
    return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix))


def newest_batch(spark: SparkSession, path: str, base_path: str | None = None) -> int:
    """The last batch whose delta, or whose version, is there; -1 for none."""
    return max([*_numbers(spark, path, DELTA), *_numbers(spark, base_path, BASE)], default=-1)


def rows(spark: SparkSession, path: str, base_path: str | None = None,
         before: int | None = None) -> DataFrame | None:
    """Rows of the newest version and of the deltas after it, of batches
    below ``before``; None when there are none."""
    def early(n):
        return before is None or n < before
    bases = [n for n in _numbers(spark, base_path, BASE) if early(n)]
    through = bases[-1] if bases else -1
    late = [f"{path.rstrip('/')}/{DELTA}{n}" for n in _numbers(spark, path, DELTA) if n > through and early(n)]
    deltas = spark.read.option("basePath", path).parquet(*late) if late else None
    base = spark.read.parquet(f"{base_path.rstrip('/')}/{BASE}{through}") if bases else None
    if base is None or deltas is None:
        return deltas if base is None else base
    return base.unionByName(deltas.select(base.columns))


def compact(spark: SparkSession, path: str, base_path: str,
            fold: Callable[[DataFrame], DataFrame]) -> int | None:
    """Fold what ``rows`` gives into a new version, then delete what neither
    it nor the version before needs. ``fold`` keeps ``batch_id``. Returns the
    batch that the newest version goes up to; None when nothing is there."""
    through = newest_batch(spark, path, base_path)
    if through < 0:
        return None
    versions = _numbers(spark, base_path, BASE)
    if not versions or versions[-1] < through:
        target = f"{base_path.rstrip('/')}/{BASE}{through}"
        fold(rows(spark, path, base_path)).write.mode("overwrite").parquet(target)
        versions.append(through)
    if len(versions) > 1:
        for n in versions[:-2]:
            files.delete(spark, f"{base_path.rstrip('/')}/{BASE}{n}")
        for n in _numbers(spark, path, DELTA):
            if n <= versions[-2]:
                files.delete(spark, f"{path.rstrip('/')}/{DELTA}{n}")
    return through
