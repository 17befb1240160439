"""Mixing sources to target weights by pivotal dependent rounding (operator 10).

Every document of a source has the same expected number of copies, the
source's target over its size. The whole part is given; the fractional parts
are rounded in pairs: two documents pass words from one to the other until one
of them is at 0 or 1, in the direction that keeps both expectations, so the
source's words stay the same and one fraction goes on to the next pair. Groups
of a source (a hash of doc_id deals it into groups of bounded size) are rounded
in parallel and hand up one residual each; residuals are combined in a tree of
a fixed fan-in until a source has one. Random numbers are hashes of the
doc_ids: reruns agree, however the input is dealt.

A source's last residual, often a large document, goes up with its own
probability, else down. The words that this adds or takes are given back by
smaller documents of the source, which move by one copy between the two numbers
that their expectation lies between: up and down balance over the random
numbers as the residual's own do. These come from a pool of ``POOL`` documents
a source, those of the least hashes, so a hot source is no large group.

Only ids, sources and sizes are shuffled; texts are joined to their copies at
the end, in ``mix``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewatch.llm.ordered import numbered
from pricewatch.llm.settle import settle, spare, table

WEIGHTS = (3, 1, 2)             # of the sources in code point order, repeating
SHARE = 1.5                     # words of the mix by words of all documents
MOST_COPIES = 2
GROUP = 1 << 16                 # documents in a first group, on average
FAN_IN = 16
WORD = "[^\\x20\\x09-\\x0D]+"
EVEN = 1e-9
POOL = 4096                     # documents of a source that can make up for its last residual


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """(source, size, target) from (source, size), one row a source.

    Targets are proportional to the weights and stop at ``most`` times the
    size; the excess is shared again. The level, words a unit of weight, rises
    from that of no source at its limit: sources below it are set to their
    limits, which gives the next level, until none is. That's a sum over the
    sources a round, and the rounds are few as limits are passed in bulk.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = numbered(sizes, [F.col("source").asc_nulls_first()], "nth")
    nulls = 1 if rows.where(F.col("source").isNull()).take(1) else 0      # null sorts first here, and counts last
    last = rows.count() - 1
    nth = F.when(F.col("source").isNull(), F.lit(last)).otherwise(F.col("nth") - nulls)
    rows = settle(rows.select("source", "size", F.get(cycle, (nth % len(weights)).cast("int")).alias("w"),
                              (F.col("size") * float(most)).alias("limit")), "weights")
    total = share * (rows.agg(F.sum("size")).first()[0] or 0)
    level = -1.0
    while True:
        full = F.col("limit") <= F.lit(level) * F.col("w")
        r = rows.agg(F.sum(F.when(full, F.col("limit")).otherwise(0.0)).alias("given"),
                     F.sum(F.when(~full, F.col("w"))).alias("w")).first()
        if not r.w:
            break
        higher = (total - (r.given or 0.0)) / r.w
        if higher <= level:
            break
        level = higher
    return rows.select("source", "size", F.least(F.col("limit"), F.lit(level) * F.col("w")).alias("target"))


def _unit(a: int, b: int) -> float:
    """A number in [0, 1) from two ids."""
    x = (a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F + 0x165667B19E3779F9) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
    return ((x ^ (x >> 31)) >> 11) * 2.0 ** -53


def transfer(fa: float, sa: float, fb: float, sb: float, u: float) -> tuple[float, float]:
    """Fractions of two documents of sizes ``sa``, ``sb`` after a transfer
    that leaves ``sa * fa + sb * fb`` and, over u, both expectations as they
    are; at least one comes out as 0 or 1."""
    up = min((1 - fa) * sa, fb * sb)            # words that a can gain from b
    down = min(fa * sa, (1 - fb) * sb)
    if u * (up + down) < down:
        fa, fb = fa + up / sa, fb - up / sb
    else:
        fa, fb = fa - down / sa, fb + down / sb
    return tuple(float(round(f)) if abs(f - round(f)) < EVEN else f for f in (fa, fb))


def _round(at: dict[str, int], last: bool):
    """Walks sorted groups of (id, size, group, copies, frac) and resolves all
    but one row of each. Columns are found by number."""
    def run(batches):
        held = None                             # the residual: (batch of one row, group, id, size, frac)

        def out(row, frac):
            copies = int(row.column(at["copies"])[0].as_py())
            if frac in (0.0, 1.0) or last:
                up = frac if frac in (0.0, 1.0) else _unit(row.column(at["id"])[0].as_py() or 0, -2) < frac
                return _with(row, at, [copies + int(up)], [0.0])
            return _with(row, at, [copies], [frac])

        for batch in batches:
            ids = [i or 0 for i in batch.column(at["id"]).to_pylist()]
            size = batch.column(at["size"]).to_pylist()
            group = batch.column(at["group"]).to_pylist()
            copies = batch.column(at["copies"]).to_pylist()
            frac = batch.column(at["frac"]).to_pylist()
            keep = np.ones(batch.num_rows, bool)
            now = None                          # the residual's place, None if it is the held row or there is none
            for i in range(batch.num_rows):
                here = now if now is not None else -1
                if held is not None and held[1] != group[i]:
                    yield out(held[0], held[4])
                    held = None
                if here >= 0 and group[here] != group[i]:
                    if last:
                        copies[here] += int(_unit(ids[here], -2) < frac[here])
                        frac[here] = 0.0
                    now = here = None
                if frac[i] in (0.0, 1.0):
                    copies[i] += int(frac[i])
                    frac[i] = 0.0
                elif size[i] <= 0:
                    copies[i] += _unit(ids[i], -1) < frac[i]
                    frac[i] = 0.0
                elif held is not None:
                    fa, fb = transfer(held[4], held[3], frac[i], size[i], _unit(held[2], ids[i]))
                    if fa in (0.0, 1.0):
                        yield out(held[0], fa)
                        held = None
                    else:
                        held = (*held[:4], fa)
                    frac[i] = fb
                    if fb in (0.0, 1.0):
                        copies[i] += int(fb)
                        frac[i] = 0.0
                    else:
                        now = i
                elif now is not None:
                    fa, fb = transfer(frac[now], size[now], frac[i], size[i], _unit(ids[now], ids[i]))
                    frac[now], frac[i] = fa, fb
                    place, now = now, None
                    for j in (place, i):
                        if frac[j] in (0.0, 1.0):
                            copies[j] += int(frac[j])
                            frac[j] = 0.0
                        else:
                            now = j
                else:
                    now = i
            if now is not None:
                held = (batch.slice(now, 1), group[now], ids[now], size[now], frac[now])
                keep[now] = False
            yield _with(batch, at, copies, frac).filter(pa.array(keep))
        if held is not None:
            yield out(held[0], held[4])
    return run


def _with(batch, at, copies, frac) -> pa.RecordBatch:
    cols = [pa.array([int(c) for c in copies], pa.int32()) if i == at["copies"]
            else pa.array([float(f) for f in frac], pa.float64()) if i == at["frac"] else c
            for i, c in enumerate(batch.columns)]
    return pa.RecordBatch.from_arrays(cols, schema=batch.schema)


def decided(rows: DataFrame) -> DataFrame:
    """(id, doc_id, of, size, total, target, copies) of (id, doc_id, of, size),
    of being the source; written."""
    sums = settle(rows.groupBy("of").agg(F.sum("size").alias("size"), F.count("*").alias("rows")), "sources")
    n = sums.agg(F.sum("rows")).first()[0] or 0
    goal = settle(targets(sums.select(F.col("of").alias("source"), "size")), "targets") \
        .select(F.col("source").alias("source"), F.col("size").alias("total"), "target")
    groups = -(-n // GROUP) or 1
    p = F.when(F.col("total") > 0, F.col("target") / F.col("total")).otherwise(F.lit(0.0))
    rows = rows.join(goal, F.col("of").eqNullSafe(F.col("source"))).select(
        "id", "doc_id", "of", "size", "total", "target", F.floor(p).cast("int").alias("copies"),
        (p - F.floor(p)).alias("frac"), F.pmod(F.xxhash64("doc_id"), F.lit(groups)).alias("group"))
    done = None
    while True:
        rows = settle(_level(rows, groups == 1), "level")
        whole = rows.where(F.col("frac") == 0)
        done = whole if done is None else done.union(whole)
        if groups == 1:
            break
        groups = -(-groups // FAN_IN)
        rows = rows.where(F.col("frac") > 0).withColumn("group", F.floor(F.col("group") / FAN_IN).cast("long"))
    return _evened(done.drop("frac", "group"))


def _level(rows: DataFrame, last: bool) -> DataFrame:
    key = F.struct("of", "group")
    dealt = rows.withColumn("key", key).repartition("of", "group") \
        .sortWithinPartitions("of", "group", F.col("size").desc(), "doc_id", "id")
    names = dealt.columns
    at = {"id": names.index("doc_id"), "size": names.index("size"), "group": names.index("key"),
          "copies": names.index("copies"), "frac": names.index("frac")}
    return dealt.mapInArrow(_round(at, last), dealt.schema).drop("key")


def _evened(rows: DataFrame) -> DataFrame:
    """``rows`` with the words of each source brought near its target by moving
    documents of its pool between the two numbers of copies next to their
    expectation."""
    off = rows.groupBy("of").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("goal")) \
        .select("of", (F.col("taken") - F.col("goal")).alias("off"))
    p = F.col("target") / F.col("total")
    least, most = F.floor(p), F.ceil(p)
    step = F.when((F.col("off") > 0) & (F.col("copies") > least), -1) \
        .when((F.col("off") < 0) & (F.col("copies") < most), 1)
    apart = F.col("of").eqNullSafe(F.col("source"))
    pool = rows.where("size > 0").join(off.withColumnRenamed("of", "source"), apart) \
        .withColumn("step", step).where(F.col("step").isNotNull() & (F.col("size") < 2 * F.abs("off")))
    nth = F.row_number().over(Window.partitionBy("of").orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id", "id"))
    pool = pool.withColumn("nth", nth).where(F.col("nth") <= POOL).select("id", "of", "size", "step", "off")
    moved = settle(pool.groupBy("of").applyInArrow(_moves, "id long, step int"), "moved")
    moved = moved.select(F.col("id").alias("moved"), "step")
    return settle(rows.join(moved, F.col("id") == F.col("moved"), "left").withColumn(
        "copies", F.col("copies") + F.coalesce("step", F.lit(0))).drop("moved", "step"), "copies")


def _moves(t: pa.Table) -> pa.Table:
    """Of a source's pool the documents that move: from the largest on, each
    that isn't too large for what is left, then the one nearest to the rest."""
    size, step = t.column("size").to_numpy(), t.column("step").to_numpy()
    left, take, rest = abs(t.column("off")[0].as_py()) if t.num_rows else 0.0, [], []
    for i in np.lexsort((t.column("id").to_numpy(), -size)):
        if size[i] <= left:
            take.append(i)
            left -= size[i]
        else:
            rest.append(i)
    if rest:
        nearest = min(rest, key=lambda i: abs(size[i] - left))
        if abs(size[nearest] - left) < left:
            take.append(nearest)
    take = np.array(take, np.int64)
    return pa.table({"id": t.column("id").to_numpy()[take], "step": pa.array(step[take], pa.int32())})


def _sized(docs: DataFrame, id: str, size: str) -> DataFrame:
    words = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.withColumns({id: F.monotonically_increasing_id(), size: words})


def _slim(rows: DataFrame, id: str, size: str) -> DataFrame:
    return rows.select(F.col(id).alias("id"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("source").cast("string").alias("of"), F.col(size).alias("size"))


def mixed(docs: DataFrame, name: str = "_mix") -> DataFrame:
    """``docs`` with its columns and the struct ``name``: size (words),
    source_size, target (both of the source) and copies.

    A null source is a source of its own, the last in order; null, empty and
    wordless texts have size 0. Repeated rows are documents of their own; a
    row without doc_id counts as id 0. A source of size 0 has target 0. No
    rows give no rows.
    """
    docs = docs.drop(name)          # a column of that name is replaced
    id, size = spare(docs, "_id"), spare(docs, "_size")
    rows = settle(_sized(docs, id, size), "numbered")       # ids must not change between the readers
    found = decided(_slim(rows, id, size)).select(F.col("id").alias(id), F.struct(
        "size", F.col("total").alias("source_size"), "target", "copies").alias(name))
    return rows.join(found, id).select(*docs.columns, name)


def mix(docs: DataFrame) -> DataFrame:
    """``docs`` with each row as often as the mix takes it."""
    name = spare(docs, "_mix")
    rows = mixed(docs, name)
    again = F.explode(F.array_repeat(F.lit(0), F.col(name)["copies"])).alias(spare(docs, "_again"))
    return rows.select(*docs.columns, again).select(docs.columns)


def op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    rows = settle(_slim(_sized(docs, "id", "size"), "id", "size"), "numbered")
    return decided(rows).select(
        "doc_id", "size", F.col("total").alias("source_size"), "target",
        (F.col("copies") * F.col("size")).alias("taken"), "copies")
