"""Centroid clustering over subvector dictionaries (operator 13).

Vectors become integers (``floor(scale * x)``) and are dictionary-encoded in
shards of up to ``SHARD`` rows, without loss: each component starts as a block
with the list of its distinct values and a code per row, and neighbouring
blocks are joined into wider ones while their distinct subvectors are few
beside the shard's rows. Copies thus end as a single block of whole vectors,
unlike vectors as blocks of single components. A round computes the distance
from each distinct subvector to each centroid's part once, and a row's distance
is the sum of its codes' entries. New centroids come from code counts. The
encoded shards are written once; a round reads them, and what is shuffled are
``k * components`` sums a task. All arithmetic is on integers, exact.
"""

from __future__ import annotations

import hashlib
from math import isqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewatch.llm.settle import Scratch, spare, table

SHARD = 8192                # rows that share dictionaries
FILL = 0.5                  # blocks are joined while they have at most this many subvectors a row
LIMB = 40                   # bits of a part of a sum that a long can't hold
COUNT, INERTIA = -1, -2     # what else is summed by cluster, beside components 0, 1, ...
SHARDS = "n long, first array<int>, width array<int>, words array<binary>, codes array<binary>"
SUMS = "cluster int, what int, limb int, total long"
ASSIGNED = T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])


class Block(NamedTuple):
    first: int              # its first component
    words: np.ndarray       # (distinct subvectors, width), whole numbers as doubles
    codes: np.ndarray       # of each row


class Model(NamedTuple):
    centroids: list[list[int]]
    cluster_inertia: list[int]

    @property
    def inertia(self) -> int:
        return sum(self.cluster_inertia)

    def digest(self, cluster: int) -> str:
        return hashlib.sha256(",".join(map(str, self.centroids[cluster])).encode()).hexdigest()


def usable(vectors: DataFrame, dim: int, scale: int, column: str = "embedding") -> DataFrame:
    """Rows whose vector has ``dim`` components, none null and all finite, also
    when multiplied by ``scale``."""
    big = F.exists(F.col(column).cast("array<double>"), lambda x: x.isNull() | F.isnan(x)
                   | (F.abs(x * F.lit(float(scale))) == F.lit(float("inf"))))
    return vectors.where((F.size(column) == dim) & ~big)


def whole(col: pa.Array, dim: int, scale: int) -> np.ndarray:
    """(rows, dim) components as whole numbers in doubles."""
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat.reshape(-1, dim) * float(scale)) + 0.0


def encode(x: np.ndarray, fill: float = FILL) -> list[Block]:
    """The blocks of a shard."""
    blocks = []
    for j in range(x.shape[1]):
        words, codes = np.unique(x[:, j], return_inverse=True)
        blocks.append(Block(j, words[:, None], codes.ravel()))
    joined = True
    while joined:
        joined, row, i = False, [], 0
        while i < len(blocks):
            pair = _joined(*blocks[i:i + 2], fill * len(x)) if i + 1 < len(blocks) else None
            row.append(pair or blocks[i])
            joined, i = joined or pair is not None, i + 1 + (pair is not None)
        blocks = row
    return blocks


def _joined(a: Block, b: Block, most: float) -> Block | None:
    if max(len(a.words), len(b.words)) > most:
        return None
    both, codes = np.unique(a.codes.astype(np.int64) * len(b.words) + b.codes, return_inverse=True)
    if len(both) > most:
        return None
    at = np.divmod(both, len(b.words))
    return Block(a.first, np.hstack([a.words[at[0]], b.words[at[1]]]), codes.ravel())


def _exact(values: np.ndarray, dim: int) -> np.ndarray:
    """Whole doubles as longs, or as Python integers where the square of a
    difference, summed over ``dim``, might not fit a long."""
    most = isqrt((1 << 62) // dim) // 2
    if not values.size or np.abs(values).max() <= most:
        return values.astype(np.int64)
    return np.array([int(v) for v in values.ravel()], object).reshape(values.shape)


def _centres(centroids: list[list[int]], dim: int) -> np.ndarray:
    most = isqrt((1 << 62) // dim) // 2
    small = all(abs(c) <= most for row in centroids for c in row)
    return np.array(centroids, np.int64 if small else object).reshape(len(centroids), dim)


def distances(blocks: list[Block], centres: np.ndarray) -> np.ndarray:
    """(rows, clusters): the sum of each row's partial distances, by code."""
    total = 0
    for b in blocks:
        words = _exact(b.words, centres.shape[1])
        part = centres[:, b.first:b.first + words.shape[1]]
        apart = words[:, None, :] - part[None, :, :]
        total = total + (apart * apart).sum(axis=2)[b.codes]
    return total


def nearest(blocks: list[Block], centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's cluster (of equally near ones the smallest) and distance."""
    d = distances(blocks, centres)
    cluster = d.argmin(axis=1)
    return cluster, d[np.arange(len(d)), cluster]


def _pack(blocks: list[Block], n: int) -> pa.RecordBatch:
    def kind(b):
        return np.uint16 if len(b.words) <= 1 << 16 else np.uint32
    lists = {"first": pa.array([[b.first for b in blocks]], pa.list_(pa.int32())),
             "width": pa.array([[b.words.shape[1] for b in blocks]], pa.list_(pa.int32())),
             "words": pa.array([[np.ascontiguousarray(b.words).tobytes() for b in blocks]], pa.list_(pa.binary())),
             "codes": pa.array([[b.codes.astype(kind(b)).tobytes() for b in blocks]], pa.list_(pa.binary()))}
    return pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), *lists.values()], ["n", *lists])


def _unpack(batch: pa.RecordBatch):
    for n, first, width, words, codes in zip(*(c.to_pylist() for c in batch.columns)):
        yield [Block(f, np.frombuffer(x, np.float64).reshape(-1, w),
                     np.frombuffer(c, np.uint16 if len(x) // (8 * w) <= 1 << 16 else np.uint32))
               for f, w, x, c in zip(first, width, words, codes)] if n else []


def shards(vectors: DataFrame, dim: int, scale: int, column: str = "embedding") -> DataFrame:
    """The encoded shards of usable vectors."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SHARD):
                x = whole(batch.column(0).slice(at, SHARD), dim, scale)
                yield _pack(encode(x), len(x))
    return vectors.select(F.col(column).cast("array<double>")).mapInArrow(run, SHARDS)


def _limbs(value: int) -> list[tuple[int, int]]:
    """(place, part) whose parts times 2 ** (LIMB * place) add up to value."""
    parts, place = [], 0
    while not -(1 << 62) < value < 1 << 62:
        parts.append((place, value & ((1 << LIMB) - 1)))
        value, place = value >> LIMB, place + 1
    return [*parts, (place, value)]


def _sums(encoded: DataFrame, centroids: list[list[int]], dim: int) -> dict[tuple[int, int], int]:
    """By cluster: the sum of each component, the rows, and the distances."""
    k = len(centroids)

    def run(batches):
        centres = _centres(centroids, dim)
        sums = np.zeros((k, dim), object)
        count, apart = [0] * k, [0] * k
        for batch in batches:
            for blocks in _unpack(batch):
                cluster, d = nearest(blocks, centres)
                for c in range(k):
                    mine = cluster == c
                    count[c] += int(mine.sum())
                    apart[c] += int(d[mine].astype(object).sum()) if d.dtype == object else int(d[mine].sum())
                for b in blocks:
                    size = len(b.words)
                    times = np.bincount(cluster * size + b.codes, minlength=k * size).reshape(k, size)
                    words = _exact(b.words, dim)
                    sums[:, b.first:b.first + words.shape[1]] += (times.astype(words.dtype) @ words).astype(object)
        rows = [(c, what, place, part) for c in range(k)
                for what, value in [*enumerate(sums[c]), (COUNT, count[c]), (INERTIA, apart[c])] if value
                for place, part in _limbs(int(value))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kind) for i, kind in
             enumerate((pa.int32(), pa.int32(), pa.int32(), pa.int64()))], ["cluster", "what", "limb", "total"])

    found: dict[tuple[int, int], int] = {}
    # At most k * (components + 2) numbers, of a limb each unless they're huge.
    for r in encoded.mapInArrow(run, SUMS).groupBy("cluster", "what", "limb") \
            .agg(F.sum(F.col("total").cast("decimal(20,0)")).alias("total")).collect():
        key = (r.cluster, r.what)
        found[key] = found.get(key, 0) + (int(r.total) << LIMB * r.limb)
    return found


def starts(vectors: DataFrame, k: int, dim: int, scale: int, seed: int,
           id: str = "vec_id", column: str = "embedding") -> list[list[int]]:
    """The usable vectors of the ``k`` smallest hashes of seed and id, in that
    order; equal ids are ordered by their vectors, null ids come last."""
    by = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id).cast("string")), 256)
    rows = vectors.select(by.alias("h"), F.col(column).cast("array<double>").alias("v")) \
        .orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    x = np.floor(np.array([r.v for r in rows], np.float64).reshape(-1, dim) * float(scale))
    return [[int(v) for v in row] for row in x]


def fit(vectors: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, seed: int = 3,
        id: str = "vec_id", column: str = "embedding") -> Model:
    """Centroids after ``rounds``, and each cluster's inertia under them.

    Vectors that are null, of another length, or hold null or non-finite
    components take no part. Repeated rows count each time. Fewer vectors than
    ``k`` give as many centroids, none give none. A centroid without vectors
    stays. Of equally near centroids the first is taken.
    """
    vectors = usable(vectors.select(id, column), dim, scale, column)
    scratch = Scratch(vectors.sparkSession, "centroids")
    encoded = scratch.settle(shards(vectors, dim, scale, column), "shards")
    centroids = starts(vectors, k, dim, scale, seed, id, column)
    inertia = [0] * len(centroids)
    if centroids:
        for _ in range(rounds):
            sums = _sums(encoded, centroids, dim)
            centroids = [[sums.get((c, j), 0) // sums[c, COUNT] for j in range(dim)] if (c, COUNT) in sums else old
                         for c, old in enumerate(centroids)]
        sums = _sums(encoded, centroids, dim)
        inertia = [sums.get((c, INERTIA), 0) for c in range(len(centroids))]
    scratch.release()
    return Model(centroids, inertia)


def assign(vectors: DataFrame, model: Model, dim: int = 64, scale: int = 1024,
           column: str = "embedding", name: str = "_cluster") -> DataFrame:
    """The usable rows of ``vectors`` with their columns and a struct of
    cluster and distance (squared; null where a long can't hold it). It is
    called ``name``, with underscores added while that is taken."""
    rows = usable(vectors, dim, scale, column)
    centroids, at = model.centroids, rows.columns.index(column)
    name = spare(rows, name)
    if not centroids:
        return rows.withColumn(name, F.lit(None).cast(ASSIGNED)).where(F.lit(False))

    def run(batches):
        centres = _centres(centroids, dim)
        for batch in batches:
            for start in range(0, batch.num_rows, SHARD):
                piece = batch.slice(start, SHARD)
                cluster, d = nearest(encode(whole(piece.column(at), dim, scale)), centres)
                if d.dtype == object:
                    d = [int(v) if v < 1 << 63 else None for v in d]
                both = pa.StructArray.from_arrays([pa.array(cluster, pa.int32()), pa.array(d, pa.int64())],
                                                  ["cluster", "distance"])
                yield pa.RecordBatch.from_arrays([*piece.columns, both], [*piece.schema.names, name])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(name, ASSIGNED)]))


def op13(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = fit(vectors)

    def constant(values, kind):     # one for each cluster
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values or [None]]), F.col("_cluster.cluster") + 1)

    def long(v):
        return v if v < 1 << 63 else None

    return assign(vectors, model).select(
        "vec_id", F.col("_cluster.cluster").alias("cluster"), F.col("_cluster.distance").alias("distance"),
        constant([long(v) for v in model.cluster_inertia], "long").alias("cluster_inertia"),
        F.lit(long(model.inertia)).cast("long").alias("inertia"),
        constant([model.digest(c) for c in range(len(model.centroids))], "string").alias("centroid_sha256"))


def twin(k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """The same in SQL, a chain of assignments and means."""
    steps = [f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id,
    list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = {dim}
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, x) - 1 AS cluster, x
  FROM (SELECT sha256('{seed}:' || CAST(vec_id AS VARCHAR)) AS h, x FROM v) ORDER BY h, x LIMIT {k})"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT v.row, arg_min(c.cluster, (d, c.cluster)) AS cluster, min(d) AS d FROM v, c{r} AS c, LATERAL (
    SELECT CAST(list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d)
  GROUP BY v.row)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(n.x, c.x) AS x FROM c{r} AS c LEFT JOIN (
    SELECT cluster, list(m ORDER BY j) AS x FROM (
      SELECT cluster, j, CAST((sum(y) - ((sum(y) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
      FROM (SELECT a.cluster, unnest(range(1, {dim + 1})) AS j, unnest(v.x) AS y FROM a{r} AS a JOIN v USING (row))
      GROUP BY cluster, j) GROUP BY cluster) AS n ON n.cluster = c.cluster)""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(a.cluster AS INTEGER) AS cluster, d AS distance,
  CAST(sum(d) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} AS a JOIN v USING (row) JOIN c{rounds} AS c ON c.cluster = a.cluster"""
