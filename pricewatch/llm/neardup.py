"""Near-duplicate classes of texts from signatures: candidates by bands,
verified links, components.

A node is a distinct shingle set. Nodes that agree on the bytes of a band
collide; no bucket is capped and no bucket is expanded into all its pairs:

1. Buckets with one node vanish.
2. Each remaining bucket proposes its members to one centre, the member with
   the fullest buckets, which is the text most others resemble. Verified
   links are joined to components. Further rounds take other centres and
   leave out what already is in the centre's component.
3. The exact rest: in buckets that still hold several components, a pair is
   tried unless a bound rules it out. Shingles that only one open node has
   can't be common to two, so a pair's intersection is at most the smaller
   count of its shared shingles; and it is at most the size less the bits of
   a bitmap of shingles that the other bitmap lacks. Both bounds are part of
   the join's condition, so a group of copies with edits of their own yields
   hardly a pair that is no link.

Links are verified on the full shingle sets.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewatch.llm import textscan as ts
from pricewatch.llm.graph import connected_components
from pricewatch.llm.settle import Scratch

LARGE = 20_000              # rows of a large bucket
SAMPLE = 32                 # of these rows that are looked at
BITS = tuple(f"bits{i}" for i in range(16))
Estimate = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def band_keys(sig, bands: range, width: int):
    """Column: one 64-bit key for each of the bands, of ``width`` bytes of ``sig`` each."""
    return F.array(*[F.xxhash64(F.lit(i), F.substring(sig, i * width + 1, width)) for i in bands])


def open_buckets(nodes: DataFrame, bands: int, width: int, turns: int, settle) -> DataFrame:
    """(key, id) of the buckets with several nodes. The bands are dealt into
    ``turns`` groups that are shuffled one after another, so only one group's
    members fill the disks at a time. Nearly all buckets have one node: a window
    over the bucket tells, in one shuffle. The few that a sample shows to be
    large are told by an aggregation instead, which combines before the shuffle
    and leaves no bucket to one task."""
    parts = []
    for turn in range(turns):
        members = nodes.select(F.explode(band_keys(F.col("sig"), range(turn, bands, turns), width)).alias("key"),
                               "id")
        sampled = nodes.sample(SAMPLE / LARGE, 5).select(
            F.explode(band_keys(F.col("sig"), range(turn, bands, turns), width)).alias("key"))
        large = settle(sampled.groupBy("key").count().where(F.col("count") > SAMPLE / 2).select("key"), "large")
        bucket = Window.partitionBy("key")
        small = members
        if not large.isEmpty():
            small = members.join(large, "key", "left_anti")
            parts.append(settle(members.join(large, "key").distinct(), "buckets"))
        parts.append(settle(small.withColumn("lo", F.min("id").over(bucket)).withColumn("hi", F.max("id").over(bucket))
                            .where("lo < hi").select("key", "id").distinct(), "buckets"))
    return functools.reduce(DataFrame.union, parts)


def near_components(nodes: DataFrame, content: Callable[[DataFrame], DataFrame], bands: int,
                    width: int, k: int, rule: ts.WordRule, estimate: Estimate, least: float,
                    percent: int = 80, rounds: int = 1, turns: int = 4) -> DataFrame:
    """Components of the nodes whose shingle sets have
    ``100 * intersection >= percent * union``.

    ``nodes``: (id, n, sig), the id a hash of the set, rows may repeat.
    ``content(ids)``: (id, text) of the asked ids, or (id, n, sig, text); the
    nodes aren't read again then. ``estimate(sig_a, sig_b,
    n_a, n_b)`` gives similarities; pairs below ``least`` are not verified.
    Returns (id, component) of the nodes that have a link, written; the other
    intermediates are gone by then.
    """
    scratch = Scratch(nodes.sparkSession, "neardup")
    settle = scratch.settle
    open_ = open_buckets(nodes, bands, width, turns, settle)
    ids = open_.select("id").distinct()
    texts = content(ids)
    if "sig" not in texts.columns:
        texts = ids.join(nodes.select("id", "n", "sig").dropDuplicates(["id"]), "id").join(texts, "id")
    cand = settle(texts, "candidates")
    open_ = settle(open_.join(cand.select("id", "n"), "id"), "open")

    def check(pairs):
        return settle(_verify(pairs, cand, k, rule, estimate, least, percent), "links")

    links, label = None, None
    for turn in range(rounds):
        here = _labelled(open_, label)
        if turn == 0:
            size = open_.groupBy("key").count()
            weight = open_.join(size, "key").groupBy("id").agg(F.sum("count").alias("w"))
            here = here.join(weight, "id")
        else:
            here = here.withColumn("w", F.xxhash64("id", F.lit(turn)))
        centre = here.groupBy("key").agg(
            F.max(F.struct("w", "id", "n", "comp")).alias("top"),
            F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key", "top")
        pairs = here.join(centre, "key").where("comp <> top.comp") \
            .where(_sizes(F.col("n"), F.col("top.n"), percent)) \
            .select(F.col("top.id").alias("a"), F.col("id").alias("b")).distinct()
        links = check(pairs) if links is None else links.union(check(pairs))
        label = connected_components(links)
    more = check(_rest(_labelled(open_, label), cand, k, rule, percent, settle))
    if more.take(1):
        label = connected_components(links.union(more))
    scratch.release()
    return label


def _labelled(open_: DataFrame, label: DataFrame | None) -> DataFrame:
    if label is None:
        return open_.withColumn("comp", F.col("id"))
    return open_.join(label.withColumnRenamed("component", "comp"), "id", "left") \
        .withColumn("comp", F.coalesce("comp", "id"))


def _sizes(a, b, percent: int):
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _rest(here: DataFrame, cand: DataFrame, k: int, rule: ts.WordRule, percent: int, settle) -> DataFrame:
    """The pairs of different components in one bucket that no bound excludes."""
    several = here.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                      F.min("n").alias("least_n")) \
        .where("lo < hi").select("key", "least_n")
    here = settle(here.join(several, "key"), "open")
    todo = cand.join(here.select("id").distinct(), "id", "left_semi").select("id", "text")
    grams = settle(todo.mapInArrow(_grams(k, rule), "id long, gram long"), "grams")
    common = grams.groupBy("gram").agg(F.count("*").alias("c")).where("c > 1").select("gram")
    shared = grams.join(common, "gram", "left_semi").groupBy("id").agg(F.count("*").alias("shared"))
    # intersection >= percent / (100 + percent) * (n_a + n_b), and the other set
    # has at least percent % of this one's size
    bits = todo.mapInArrow(_bitmaps(k, rule), "id long, " + ", ".join(f"{c} long" for c in BITS))
    pool = settle(
        here.join(shared.join(bits, "id"), "id").where(
            F.col("shared") * (100 + percent)
            >= percent * (F.col("n") + F.greatest("least_n", F.ceil(F.col("n") * percent / 100)))),
        "pool")
    a, b = pool.alias("a"), pool.alias("b")

    def most(x, y):
        """What the bitmaps leave of x in y, at most."""
        lacks = [F.bit_count(F.col(f"{x}.{c}").bitwiseAND(F.bitwise_not(f"{y}.{c}"))) for c in BITS]
        return F.col(f"{x}.n") - functools.reduce(operator.add, lacks)

    return a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.comp") < F.col("b.comp"))
                  & _sizes(F.col("a.n"), F.col("b.n"), percent)
                  & (F.least("a.shared", "b.shared") * (100 + percent)
                     >= percent * (F.col("a.n") + F.col("b.n")))
                  & (F.least(most("a", "b"), most("b", "a")) * (100 + percent)
                     >= percent * (F.col("a.n") + F.col("b.n")))) \
        .select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()


def _grams(k: int, rule: ts.WordRule):
    def run(batches):
        for piece in ts.slices(batches):
            buf, off = ts.text_buffer(piece.column("text"))
            sets, edge = ts.shingle_sets(ts.words(buf, off, rule), k)
            ids = np.repeat(piece.column("id").to_numpy(), np.diff(edge))
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ts.signed(sets))], ["id", "gram"])
    return run


def _bitmaps(k: int, rule: ts.WordRule):
    """(id, longs): which of 64 * len(BITS) residues of the shingles occur."""
    def run(batches):
        for piece in ts.slices(batches):
            buf, off = ts.text_buffer(piece.column("text"))
            sets, edge = ts.shingle_sets(ts.words(buf, off, rule), k)
            bits = np.zeros((piece.num_rows, len(BITS)), np.uint64)
            row = np.repeat(np.arange(piece.num_rows), np.diff(edge))
            np.bitwise_or.at(bits, (row, (sets >> np.uint64(6)).astype(np.int64) % len(BITS)),
                             np.uint64(1) << (sets & np.uint64(63)))
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), *(pa.array(np.ascontiguousarray(c).view(np.int64)) for c in bits.T)],
                ["id", *BITS])
    return run


def _verify(pairs: DataFrame, cand: DataFrame, k: int, rule: ts.WordRule, estimate: Estimate,
            least: float, percent: int) -> DataFrame:
    def side(s):
        return cand.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"),
                           F.col("sig").alias(f"sig_{s}"), F.col("text").alias(f"text_{s}"))

    def run(batches):
        for batch in batches:
            for piece in ts.slices([batch], "text_a"):
                for part in ts.slices([piece], "text_b"):
                    yield _confirmed(part, k, rule, estimate, least, percent)

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long")


def signatures(col: pa.Array) -> np.ndarray:
    """Rows of uint16 registers from a column of equally long binaries."""
    buf, off = ts.text_buffer(col)
    return np.frombuffer(buf.tobytes(), np.uint16).reshape(len(off) - 1, -1)


def _confirmed(part, k, rule, estimate, least, percent) -> pa.RecordBatch:
    col = {name: part.column(i) for i, name in enumerate(part.schema.names)}
    guess = estimate(signatures(col["sig_a"]), signatures(col["sig_b"]),
                     col["n_a"].to_numpy(), col["n_b"].to_numpy())
    part = part.take(pa.array(np.flatnonzero(guess >= least)))
    col = {name: part.column(i) for i, name in enumerate(part.schema.names)}
    sets = []
    for s in "ab":
        # a centre's text comes many times in a row: tokenise each text once
        ids, where = np.unique(col[s].to_numpy(), return_inverse=True)
        one = np.full(len(ids), -1)
        one[where[::-1]] = np.arange(len(where))[::-1]
        buf, off = ts.text_buffer(col[f"text_{s}"].take(pa.array(one)))
        grams, edge = ts.shingle_sets(ts.words(buf, off, rule), k)
        sets.append((grams, edge, where))
    good = []
    for i in range(part.num_rows):
        x, y = (g[e[w[i]]:e[w[i] + 1]] for g, e, w in sets)
        both = len(np.intersect1d(x, y, assume_unique=True))
        good.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
    keep = pa.array(good, pa.bool_())
    return pa.RecordBatch.from_arrays([col["a"].filter(keep), col["b"].filter(keep)], ["a", "b"])
