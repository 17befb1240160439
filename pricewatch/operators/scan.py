"""Ordered per-key scans that stay parallel when one key is hot.

The detector needs, for every row, an aggregate over the *earlier* rows of
its key (the running maximum of valid prices, or the previous valid price).
A plain ``Window.partitionBy(key)`` sends every row of a key to one task, so a
listing that holds a third of the data would run on one core.

0. A sample (about ``SAMPLES`` rows of each ``hot_rows``) is counted by key and
   by time cells of each unit, with map-side combining. Keys likely to hold
   more than ``hot_rows`` rows are hot, and each gets the coarsest unit whose
   cells don't: days for a steadily busy listing, seconds or single points of
   time for one whose rows come in a burst. That table (a row a hot key, as
   many as there are) is checkpointed, so that all readers see the same one,
   and joined. It only decides *how* a key is scanned; both ways are exact, so
   a key that it misses or adds costs time, never correctness. Without hot keys
   (the usual case) the scan is one window, one shuffle.
1. Rows of hot keys are cut into chunks, the cells of their unit; a summary
   with one row per chunk (its max, or its last value) is built by an
   aggregation.
2. Each chunk's carry-in from the earlier chunks of its key comes from the
   summary, in two steps of the same kind: over minutes by key, then over
   chunks by minute, so that a key of very many chunks isn't one task either.
3. The carry-in rows are unioned into the data as a marker row that sorts
   first in its chunk, and one window partitioned by (key, chunk) finishes the
   scan. Other keys form a single chunk each and need no marker.

The data is shuffled once, on (key, chunk); a hot key is spread over as many
tasks as it has chunks. The result is exact: it equals the single window over
the whole key. Rows of a key at one point of time are never parted.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewatch.session import checkpoint_dir

UNITS = ("month", "day", "hour", "minute", "second", "microsecond")
SAMPLES = 64            # sampled rows that ``hot_rows`` rows are judged by
SEED = "_pw_seed"
_CHUNK, _V, _MARK, _UNIT, _MINUTE = "_pw_chunk", "_pw_v", "_pw_marker", "_pw_unit", "_pw_minute"


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on ``keys``, null equal to null; the left side's keys stay."""
    named = right.select(*[F.col(k).alias(f"_pw_r{i}") for i, k in enumerate(keys)],
                         *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(named[f"_pw_r{i}"]) for i, k in enumerate(keys)])
    return left.join(named, cond, how).drop(*[f"_pw_r{i}" for i in range(len(keys))])


def _cell(unit, ts: Column) -> Column:
    """A row's time cell; rows without a time share the earliest one."""
    first = F.lit("0001-01-01 00:00:00").cast("timestamp")
    if isinstance(unit, str):
        return F.coalesce(F.date_trunc(unit, ts.cast("timestamp")), first)
    by = F.when(F.lit(False), first)
    for u in UNITS:
        by = by.when(unit == u, F.date_trunc(u, ts.cast("timestamp")))
    return F.coalesce(by, first)


def hot_keys(df: DataFrame, keys: Sequence[str], ts: str, hot_rows: int = 1_000_000,
             fraction: float | None = None, unit: str | None = None, seed: int = 17) -> DataFrame:
    """``keys`` and ``_pw_unit`` of the keys likely to hold more than
    ``hot_rows`` rows, judged on a ``fraction`` sample with half the scaled
    count as margin; ``fraction=1`` counts exactly. ``unit`` is taken for all
    when given."""
    fraction = min(1.0, SAMPLES / max(1, hot_rows)) if fraction is None else fraction
    most = hot_rows * fraction / (1 if fraction >= 1 else 2)
    rows = df.select(*keys, F.col(ts).alias("_pw_ts"))
    if fraction < 1:
        rows = rows.sample(fraction=fraction, seed=seed)
    cells = rows.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(i).alias("u"), _cell(u, F.col("_pw_ts")).alias("c")) for i, u in enumerate(UNITS)]))
        .alias("_pw_u")).groupBy(*keys, "_pw_u").agg(F.count(F.lit(1)).alias("n"))
    levels = cells.groupBy(*keys, F.col("_pw_u.u").alias("u")).agg(F.sum("n").alias("all"), F.max("n").alias("most"))
    fits = F.min(F.when((F.col("most") <= most) | (F.col("u") == len(UNITS) - 1), F.col("u")))
    hot = levels.groupBy(*keys).agg(F.max("all").alias("all"), fits.alias("u")).where(F.col("all") > most)
    name = F.lit(unit) if unit else F.element_at(F.array(*map(F.lit, UNITS)), F.col("u") + 1)
    return hot.select(*keys, name.alias(_UNIT))


def _prior(rows: DataFrame, carry: DataFrame, group: Sequence[str], order: Sequence[str], agg: Column,
           out: str) -> DataFrame:
    """``out``: ``agg`` over the earlier rows of a group, of which the rows of
    ``carry`` come first and then go."""
    both = rows.withColumn(_MARK, F.lit(False)).unionByName(carry.withColumn(_MARK, F.lit(True)),
                                                            allowMissingColumns=True)
    w = (Window.partitionBy(*group).orderBy(F.col(_MARK).desc(), *[F.col(c).asc() for c in order])
         .rowsBetween(Window.unboundedPreceding, -1))
    return both.withColumn(out, agg.over(w)).where(~F.col(_MARK)).drop(_MARK)


def prior_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column,
               out: str, ts: str, how: str = "max", chunk: str | None = None,
               hot_rows: int = 1_000_000, seed: DataFrame | None = None,
               probe_fraction: float | None = None) -> DataFrame:
    """Add ``out``: over the earlier rows of the same ``keys`` (by ``order``,
    ascending), the ``max`` of ``value`` or the ``last`` non-null ``value``.
    Nulls in ``value`` are skipped. ``ts`` must be the first ``order`` column.
    ``hot_rows=0`` cuts every key that the sample sees; ``chunk`` is the unit
    for all hot keys instead of one of their own.

    ``seed`` (``keys`` + ``_pw_seed``) gives keys a value from before ``df``
    (a stream's earlier micro-batches); it counts as the earliest row."""
    if how not in ("max", "last"):
        raise ValueError(f"how must be 'max' or 'last', not {how!r}")
    keys, order = list(keys), list(order)
    agg = F.max(_V) if how == "max" else F.last(_V, ignorenulls=True)
    seeds = None if seed is None else seed.select(*keys, F.col(SEED).alias(_V)).where(F.col(_V).isNotNull())
    data = df.withColumn(_V, value)
    hot = hot_keys(df, keys, ts, hot_rows, probe_fraction, chunk)
    if hot.isEmpty():
        if seeds is not None:
            return _prior(data, seeds, keys, order, agg, out).drop(_V)
        w = (Window.partitionBy(*keys).orderBy(*[F.col(c).asc() for c in order])
             .rowsBetween(Window.unboundedPreceding, -1))
        return data.withColumn(out, agg.over(w)).drop(_V)

    checkpoint_dir(df.sparkSession)
    hot = hot.checkpoint()
    tagged = _null_safe(data, hot, keys, "left") \
        .withColumn(_CHUNK, F.when(F.col(_UNIT).isNotNull(), _cell(F.col(_UNIT), F.col(ts)))).drop(_UNIT)

    def fold(by: Column) -> Column:
        return (F.max(_V) if how == "max" else F.max_by(_V, F.when(F.col(_V).isNotNull(), by))).alias(_V)
    chunks = tagged.where(F.col(_CHUNK).isNotNull()).groupBy(*keys, _CHUNK) \
        .agg(fold(F.struct(*[F.col(c) for c in order]))).withColumn(_MINUTE, F.date_trunc("minute", _CHUNK))
    minutes = chunks.groupBy(*keys, _MINUTE).agg(fold(F.col(_CHUNK)))
    warm = chunks.limit(0).select(*keys, _V) if seeds is None else \
        _null_safe(seeds, hot.select(*keys), keys, "left_semi")
    into_minutes = _prior(minutes, warm, keys, [_MINUTE], agg, "_pw_carry") \
        .select(*keys, _MINUTE, F.col("_pw_carry").alias(_V)).where(F.col(_V).isNotNull())
    into_chunks = _prior(chunks, into_minutes, [*keys, _MINUTE], [_CHUNK], agg, "_pw_carry") \
        .select(*keys, _CHUNK, F.col("_pw_carry").alias(_V)).where(F.col(_V).isNotNull())
    if seeds is not None:
        cold = _null_safe(seeds, hot.select(*keys), keys, "left_anti")
        into_chunks = into_chunks.unionByName(cold, allowMissingColumns=True)
    return _prior(tagged, into_chunks, [*keys, _CHUNK], order, agg, out).drop(_CHUNK, _V)
