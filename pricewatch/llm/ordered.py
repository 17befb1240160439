"""Positions in a total order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewatch.llm.settle import settle, spare


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with the column ``name``: 0, 1, ... in ``order``, written. Rows
    are dealt by range and sorted inside their part; a part's offset is the
    number of rows in the parts before it, of which there are as many as tasks.
    Rows that are equal in ``order`` lie in one part."""
    place = spare(df, "_place")
    # monotonically_increasing_id: the part's number, and 33 bits of the place in it
    placed = settle(df.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn(place, F.monotonically_increasing_id()), "order")
    part, before, offsets = F.shiftright(place, 33), 0, []
    for r in sorted(placed.groupBy(part.alias("part")).count().collect()):
        offsets += [F.lit(r.part), F.lit(before)]
        before += r["count"]
    if not offsets:
        return placed.withColumn(name, F.col(place)).drop(place)
    return placed.withColumn(name, F.element_at(F.create_map(*offsets), part)
                             + F.col(place).bitwiseAND((1 << 33) - 1)).drop(place)
