"""Near-duplicate documents by SetSketch registers (operator 4).

A SetSketch (Ertl, VLDB 2021) of a set holds m registers. Register i is
``clip(floor(1 - log_b h_i), 0, q + 1)`` where ``h_i`` is the smallest of
Exp(a) hash values, one for each element: exponentially spaced, truncated
minima. Registers of a union are the larger of the two, so sketches merge;
for a base near 1 two registers agree about as often as the sets' Jaccard
similarity, so bands of registers make candidates. The similarity of a pair is
then estimated jointly, by the likelihood of how many registers are larger,
smaller and equal given both set sizes, and what remains is verified on the
full sets.

The elements' hash values come from Poisson processes: an element throws
marks at times of rate m, each at a random register, so the first mark at any
register is exponential and independent of the others. Time is cut into
windows of doubling length that are the same for all sets, and a set is done
once all its registers are hit. That takes about m ln m marks for a set of
any size instead of m for each element.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricewatch.llm import textscan as ts
from pricewatch.llm.neardup import near_components
from pricewatch.llm.settle import Scratch, settle, spare, table

M = 256                 # registers
BASE = 1.001
RATE = 20.0
TOP = 65535             # q + 1, fits two bytes
ROWS = 4                # registers in a band: 64 bands, a pair at 0.8 is missed with 2e-15
FIRST = 2.0 ** -10      # length of the first window
SLACK = 0.15            # six standard deviations of the estimate at 0.8


def _counts(mean: float) -> np.ndarray:
    """Cumulative Poisson probabilities up to where nothing is left."""
    k = np.arange(int(mean + 12 * np.sqrt(mean) + 30))
    log = k * np.log(mean) - mean - np.concatenate([[0.0], np.cumsum(np.log(k[1:]))])
    return np.cumsum(np.exp(log))


def sketch(sets: np.ndarray, off: np.ndarray, m: int = M) -> np.ndarray:
    """Registers (rows x m, uint16) of the sets ``sets[off[i]:off[i + 1]]``;
    an empty set's are 0."""
    rows = len(off) - 1
    low = np.full(rows * m, np.inf)
    shift = np.uint64(64 - int(m).bit_length() + 1)
    begin, length, window = 0.0, FIRST, 0
    todo = np.flatnonzero(np.diff(off))
    while len(todo):
        size = off[todo + 1] - off[todo]
        at = np.repeat(off[todo] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        x, row = sets[at], np.repeat(todo, size)
        with np.errstate(over="ignore"):
            seed = ts.mix(x + np.uint64(2 * window + 1) * np.uint64(0x9E3779B97F4A7C15))
            n = np.searchsorted(_counts(m * length), (seed >> np.uint64(11)) * 2.0 ** -53)
            some = np.flatnonzero(n)
            n = n[some]
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            mark = ts.mix(np.repeat(seed[some], n) + nth.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
                          + np.uint64(1))
            when = begin + (mark & np.uint64((1 << 48) - 1)) * (length * 2.0 ** -48)
            np.minimum.at(low, np.repeat(row[some], n) * m + (mark >> shift).astype(np.int64), when)
        todo = todo[np.isinf(low.reshape(rows, m)[todo]).any(axis=1)]
        begin, length, window = begin + length, begin + length, window + 1
    with np.errstate(divide="ignore"):
        level = np.floor(1 - np.log(low / RATE) / np.log(BASE))
    return np.clip(level, 0, TOP).astype(np.uint16).reshape(rows, m)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(a, b)


def joint_similarity(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity of each pair of sketches, the most likely given the
    set sizes and the numbers of larger, smaller and equal registers."""
    n_a, n_b = n_a.astype(float), n_b.astype(float)
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - more - less
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)

    def p(x):
        return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)

    def slope(j):
        eps = 1e-9
        up, down = np.maximum(u - v * j, eps), np.maximum(v - u * j, eps)
        scale = (BASE - 1) / BASE / np.log(BASE)
        dp_up, dp_down = -v * scale / (1 - up * (BASE - 1) / BASE), -u * scale / (1 - down * (BASE - 1) / BASE)
        pu, pd = np.maximum(p(up), eps), np.maximum(p(down), eps)
        rest = np.maximum(1 - pu - pd, eps)
        return more * dp_up / pu + less * dp_down / pd - same * (dp_up + dp_down) / rest

    # the log-likelihood is concave in j: bisect its slope
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(30):
        mid = (low + high) / 2
        rising = slope(mid) > 0
        low, high = np.where(rising, mid, low), np.where(rising, high, mid)
    return (low + high) / 2


def sketches(docs: DataFrame, k: int, rule: ts.WordRule = ts.SPACED) -> DataFrame:
    """(doc_id, n, id, sig) of each row: set size, hash of the set, registers
    of two bytes. Null and empty texts have n = 0 and null elsewhere."""
    def run(batches):
        for piece in ts.slices(batches, budget=1 << 20):
            buf, off = ts.text_buffer(piece.column("text"))
            sets, edge = ts.shingle_sets(ts.words(buf, off, rule), k)
            ident, _ = ts.set_hash(sets, edge)
            size = np.diff(edge)
            none = size == 0
            regs = sketch(sets, edge)
            sig = pa.array([None if e else r.tobytes() for r, e in zip(regs, none)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(size), pa.array(ts.signed(ident), mask=none), sig],
                ["doc_id", "n", "id", "sig"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, n long, id long, sig binary")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text, ...): doc_id,
    n_shingles, component_id, kept.

    Documents are linked when ``100 * |A & B| >= percent * |A | B|`` on their
    sets of distinct ``k``-word shingles (a shorter text's whole sequence is
    its one shingle). component_id is the smallest doc_id reachable over
    links, kept says that it is the row's own. Null, empty and wordless texts
    have the empty set and link with nothing; repeated rows are copies, and
    rows that share a doc_id are judged by their own texts. A row without
    doc_id gets component_id null and is kept. An empty table gives no rows;
    other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    scratch = Scratch(docs.sparkSession, "sketches")
    drawn = scratch.settle(sketches(docs, k), "sketches")
    rows = settle(drawn.drop("sig"), "sets")            # the registers go before the result is read
    nodes = rows.where("n > 0")

    def content(ids):
        first = nodes.join(ids, "id", "left_semi").groupBy("id").agg(F.min("doc_id").alias("doc_id"))
        found = docs.join(first, "doc_id").select("id", "doc_id", "text")
        return found.mapInArrow(_own(k), "id long, text string")

    comp = near_components(drawn.where("n > 0").select("id", "n", "sig"), content, M // ROWS, 2 * ROWS, k, ts.SPACED,
                           joint_similarity, percent / 100 - SLACK, percent)
    scratch.release()
    named = nodes.groupBy("id").agg(F.min("doc_id").alias("doc_id")) \
        .join(comp, "id", "left").withColumn("component", F.coalesce("component", "id"))
    head = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.select("id", "component").join(head, "component").select("id", "component_id")
    out = rows.select("doc_id", F.col("n").alias("n_shingles"), "id").join(named, "id", "left")
    alone = F.col("id").isNull() | F.col("doc_id").isNull()
    return out.select(
        "doc_id", "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _own(k: int):
    """Drops a row whose text isn't the set it stands for (a doc_id may come
    with several texts)."""
    def run(batches):
        for piece in ts.slices(batches):
            buf, off = ts.text_buffer(piece.column("text"))
            ident, _ = ts.set_hash(*ts.shingle_sets(ts.words(buf, off, ts.SPACED), k))
            keep = pa.array(ts.signed(ident) == piece.column("id").to_numpy())
            yield pa.RecordBatch.from_arrays([piece.column("id").filter(keep), piece.column("text").filter(keep)],
                                             ["id", "text"])
    return run


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the near-duplicates: of each component the row of the
    smallest doc_id stays, of repeated rows one. A doc_id goes when any of its
    rows repeats a smaller document. Rows without doc_id stay."""
    gone = near_duplicates(docs, k, percent).where("not kept").select("doc_id").distinct()
    named = docs.where(F.col("doc_id").isNotNull()).join(gone, "doc_id", "left_anti")
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64(*docs.columns))
    nth = spare(docs, "_nth")
    return named.withColumn(nth, F.row_number().over(first)).where(F.col(nth) == 1) \
        .select(docs.columns).union(docs.where(F.col("doc_id").isNull()))


def op4(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), k=4)
