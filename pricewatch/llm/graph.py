"""Connected components of an edge table, by joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewatch.llm.settle import Scratch, settle


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long) to (id, component): every id of an edge, with the
    smallest id it is connected to.

    Each level points every node at its smallest neighbour, follows the
    pointers to the roots by doubling, and contracts the edges to the roots. A
    level at least halves the nodes that still have edges, and a star takes
    one. Neighbours are reduced by ``min`` before the shuffle, so a hub is no
    large group; the joins are plain equi-joins that AQE splits when skewed.
    Nulls, loops and repeated edges are dropped; no edges give no rows.
    """
    scratch = Scratch(edges.sparkSession, "graph")
    edges = scratch.settle(edges.select("a", "b").where("a <> b").distinct(), "edges")
    result = None
    while result is None or edges.take(1):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = scratch.settle(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("b"))
                            .select("id", F.least("id", "b").alias("up")), "parents")
        while True:
            over = up.select(F.col("id").alias("up"), F.col("up").alias("top"))
            nxt = scratch.settle(up.join(over, "up").select(
                "id", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")), "jump")
            up = nxt.select("id", "up")
            if not nxt.where("moved").take(1):
                break
        result = up.select("id", F.col("up").alias("component")) if result is None else (
            result.join(up.select(F.col("id").alias("component"), "up"), "component", "left")
            .select("id", F.coalesce("up", "component").alias("component")))
        ends = edges.join(up.select(F.col("id").alias("a"), F.col("up").alias("ra")), "a") \
            .join(up.select(F.col("id").alias("b"), F.col("up").alias("rb")), "b") \
            .where("ra <> rb")
        edges = scratch.settle(ends.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
                               .distinct(), "edges")
    result = settle(result, "components")
    scratch.release()
    return result
