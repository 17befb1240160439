"""Validation and reject routing.

A bad record is never dropped silently and never stops the job: ``split``
returns the good rows and the rejects, each reject carrying the first reason
that failed. ``good + rejects = input`` always holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewatch.functions.columns import valid_price
from pricewatch.schemas import TEXT_LIMITS

REASON = "reject_reason"            # the first constraint that a row breaks
REASONS = "reject_reasons"          # all of them


def valid_prices(df: DataFrame, price: str = "price") -> DataFrame:
    """Rows the detector can use (price present, a number, above zero)."""
    return df.where(valid_price(price))


def reason_column(checks: Sequence[tuple[str, Column]]) -> Column:
    """First failing check's reason, or null. Each check is (reason, ok)."""
    expr = None
    for reason, ok in checks:
        failed = ~F.coalesce(ok, F.lit(False))
        expr = F.when(failed, F.lit(reason)) if expr is None else expr.when(failed, F.lit(reason))
    return expr.otherwise(F.lit(None).cast("string")) if expr is not None else F.lit(None).cast("string")


def reasons_column(checks: Sequence[tuple[str, Column]]) -> Column:
    """All failing checks' reasons, in the order of the checks."""
    failed = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(reason)) for reason, ok in checks]
    return F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")


def split(df: DataFrame, checks: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """(good, rejects). Both read ``df``; persist it first when it is costly
    and both are consumed (a streaming micro-batch is)."""
    tagged = df.withColumn(REASON, reason_column(checks))
    return (tagged.where(F.col(REASON).isNull()).drop(REASON),
            tagged.where(F.col(REASON).isNotNull()))


def not_null_checks(cols: Sequence[str]) -> list[tuple[str, Column]]:
    return [(f"null_{c}", F.col(c).isNotNull()) for c in cols]


def length_checks(limits: dict[str, int] | None = None,
                  present: Sequence[str] | None = None) -> list[tuple[str, Column]]:
    """Text longer than the stored column allows is rejected, not cut."""
    limits = TEXT_LIMITS["price_history"] if limits is None else limits
    return [(f"too_long_{c}", F.col(c).isNull() | (F.length(c) <= n))
            for c, n in limits.items() if present is None or c in present]


def range_checks(pairs: dict[str, str]) -> list[tuple[str, Column]]:
    """``{decimal_col: source_col}``: the decimal is null while the source
    is not, i.e. the value did not fit."""
    return [(f"out_of_range_{d}", F.col(d).isNotNull() | F.col(s).isNull())
            for d, s in pairs.items()]


def history_checks(present: Sequence[str]) -> list[tuple[str, Column]]:
    """Constraints of the price-history table, in the order they are tested."""
    checks = not_null_checks([c for c in ("event_id", "source", "timestamp") if c in present])
    if "_bad_number" in present:
        checks.append(("bad_number", ~F.col("_bad_number")))
    checks += range_checks({d: s for d, s in (("price", "_raw_price"), ("fees", "_raw_fees"),
                                              ("total_price", "_raw_total_price"))
                            if d in present and s in present})
    checks += length_checks(present=present)
    return checks


def with_known_keys(df: DataFrame, dim: DataFrame, on: Sequence[str],
                    how: str) -> DataFrame:
    """Foreign-key check as a join: ``left_semi`` keeps rows whose key exists
    in ``dim``, ``left_anti`` keeps the orphans. The dimension side is sized
    at run time by AQE: broadcast when small, shuffled otherwise."""
    if how not in ("left_semi", "left_anti"):
        raise ValueError(how)
    return df.join(dim.select(*on), list(on), how)


KNOWN = "_pw_known"


def with_known_flag(df: DataFrame, dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """Add ``_pw_known``: whether the row's key exists in ``dim``. One left
    join to the dimension's distinct keys, so rows are never duplicated and
    the known/unknown split needs no second pass."""
    keys = dim.select(*on).distinct().withColumn(KNOWN, F.lit(True))
    return df.join(keys, list(on), "left").withColumn(
        KNOWN, F.coalesce(F.col(KNOWN), F.lit(False)))


def known_check(reason: str = "unknown_event") -> tuple[str, Column]:
    """The check for rows tagged by ``with_known_flag``."""
    return reason, F.col(KNOWN)


def split_known(df: DataFrame, dim: DataFrame, on: Sequence[str],
                reason: str = "unknown_event") -> tuple[DataFrame, DataFrame]:
    """(rows whose key is in ``dim``, orphans with a reject reason)."""
    good, orphans = split(with_known_flag(df, dim, on), [known_check(reason)])
    return good.drop(KNOWN), orphans.drop(KNOWN)


def dedup(df: DataFrame, keys: Sequence[str] = ("listing_id", "timestamp")) -> DataFrame:
    """Optional duplicate skip on (listing, time). An aggregation that
    combines map-side, so a key with many copies shrinks before the shuffle."""
    return df.dropDuplicates(list(keys))


def reject_counts(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy(REASON).agg(F.count(F.lit(1)).alias("n"))
