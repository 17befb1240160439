"""The constraints of the stored tables, as declared in ``schemas``: values
that must be there, text lengths, number ranges, unique keys and references.

``check`` takes rows of outside data, casts them to a table's types and adds
``reject_reasons``, all constraints that a row breaks, and ``reject_reason``,
the first of them (an empty array and null for a good row). Nothing is
dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewatch import schemas
from pricewatch.operators import validate

RAW = "_pw_raw"
REFERENCE, FIRST, COPIES = "_pw_reference", "_pw_first", "_pw_copies"


def declared(table: str, present: Sequence[str], raw=None,
             reference: Column | None = None) -> list[tuple[str, Column]]:
    """(reason, ok) of each declared constraint on a row whose column is
    ``present``: not-null, range, length, and reference when its flag is given.
    ``raw(c)`` is the column before the cast; without it a null
    number can't be told from one out of range and only counts as missing."""
    kind = schemas.TABLES[table]
    numbers = [f.name for f in kind if isinstance(f.dataType, (T.DecimalType, T.IntegerType, T.LongType))]
    source = raw or F.col
    checks = [(f"null_{f.name}", source(f.name).isNotNull())
              for f in kind if not f.nullable and f.name in present]
    others = [f.name for f in kind if isinstance(f.dataType, (T.TimestampType, T.BooleanType))]
    if raw is not None:
        checks += [(f"unreadable_{c}", F.col(c).isNotNull() | raw(c).isNull()) for c in others if c in present]
        checks += [(f"out_of_range_{c}", F.col(c).isNotNull() | raw(c).isNull()) for c in numbers if c in present]
    checks += validate.length_checks(schemas.TEXT_LIMITS[table], present)
    if reference is not None:
        checks.append((f"unknown_{schemas.REFERENCES[table][0].removesuffix('_id')}", reference))
    return checks


def typed(df: DataFrame, table: str) -> DataFrame:
    """Rows in the table's columns and types: defaults for missing values, a
    missing column is null, a value that doesn't fit its type is null. The
    values before the cast are in the struct ``_pw_raw``."""
    defaults = schemas.DEFAULTS.get(table, {})
    kind = schemas.TABLES[table]

    def value(f):
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        return F.coalesce(c, F.lit(defaults[f.name])) if f.name in defaults else c
    return df.select(*[value(f).try_cast(f.dataType).alias(f.name) for f in kind],
                     F.struct(*[value(f).alias(f.name) for f in kind]).alias(RAW))


def check(df: DataFrame, table: str, parent: DataFrame | None = None, order: Sequence[str] = ()) -> DataFrame:
    """``df`` in the layout of ``table``, with reasons. ``parent`` is the table
    that the reference goes to. Of rows with one unique key that break no other
    constraint, the first in ``order`` (then by all columns) is good and the
    others are duplicates; equal rows are counted first, so a key with very
    many copies is combined before it is shuffled."""
    rows = typed(df, table)
    reference = None
    if parent is not None and table in schemas.REFERENCES:
        column, _, key = schemas.REFERENCES[table]
        known = parent.select(F.col(key).cast(schemas.TABLES[table][column].dataType).alias(column)).distinct() \
            .withColumn(REFERENCE, F.lit(True))
        rows = rows.join(known, column, "left")
        reference = F.coalesce(F.col(REFERENCE), F.lit(False)) | F.col(column).isNull()
    names = [f.name for f in schemas.TABLES[table]]
    rows = rows.withColumn(validate.REASONS, validate.reasons_column(
        declared(table, names, lambda c: F.col(RAW)[c], reference))).drop(RAW, REFERENCE)
    if table in schemas.UNIQUE:
        rows = _unique(rows, schemas.UNIQUE[table], order)
    return rows.withColumn(validate.REASON, F.get(validate.REASONS, F.lit(0))).select(
        *names, validate.REASON, validate.REASONS)


def _unique(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    rank = F.struct(*[F.col(c) for c in [*order, *[c for c in rows.columns if c not in order]]])
    copies = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).cast("int").alias(COPIES))
    good = F.size(validate.REASONS) == 0
    first = copies.where(good).groupBy(key).agg(F.min(rank).alias(FIRST))
    apart = copies.join(first, key, "left").withColumn(COPIES, F.explode(F.sequence(F.lit(1), F.col(COPIES))))
    again = good & ~((F.col(COPIES) == 1) & (rank == F.col(FIRST)))
    return apart.withColumn(validate.REASONS, F.when(again, F.array(F.lit(f"duplicate_{key}")))
                            .otherwise(F.col(validate.REASONS))).drop(FIRST, COPIES)
