"""Approximate nearest neighbours by robust-pruned directed graphs (operator 8).

Vectors are dealt into shards of bounded size by a hash of vec_id, one graph a
shard (Vamana, Subramanya et al. 2019). A graph starts with random edges;
greedy searches propose neighbours for each vector, and robust pruning keeps
the nearest candidate and drops those that are closer to it, by a factor alpha,
than to the vector: alpha = 1 first, then a relaxed one for the long edges.
Searches and pruning go over a block of vectors at once. All searches begin at
several nodes, the medoid and vectors that are far from it and each other, so a
dense cluster in the middle doesn't fill the beam before it leaves. Nodes that
can't be reached from these get an edge from the nearest one that can.

Each shard searches a sample of its own vectors and compares with brute force:
its beam is doubled until the recall is ``RECALL``, on the worst third of the
sample, too, up to the whole shard, which is exact.

Graphs are written to the shared folder. A task gets its shard once and then
the queries in blocks; a beam search gives the shard's best, and a window per
query keeps the best of all shards. Distances of the results are computed on
the original vectors in double precision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricewatch.llm.settle import settle, table

SHARD = 8192                # vectors in a shard, on average
STARTS = 16
RECALL = 0.97
SAMPLE = 96                 # vectors of a shard that its recall is measured on
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 160
ALPHA = 1.2
BLOCK = 256                 # vectors handled at once
QUERY_BLOCK = 1024


def _block_distances(x: np.ndarray, q: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Squared distances of q[i] to x[at[i, j]]."""
    diff = x[at] - q[:, None, :]
    return np.einsum("ijk,ijk->ij", diff, diff)


def beam_search(x: np.ndarray, graph: np.ndarray, start: np.ndarray, q: np.ndarray, beam: int
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Greedy beam search of all rows of ``q`` at once: the beam's nodes and
    squared distances in order, and the expanded nodes (-1 where none)."""
    n = len(q)
    ids = np.full((n, beam), -1)
    dist = np.full((n, beam), np.inf)
    open_ = np.zeros((n, beam), bool)
    first_d = _block_distances(x, q, np.broadcast_to(start, (n, len(start))))
    order = np.argsort(first_d, axis=1, kind="stable")[:, :beam]
    ids[:, :order.shape[1]], open_[:, :order.shape[1]] = start[order], True
    dist[:, :order.shape[1]] = np.take_along_axis(first_d, order, 1)
    seen = np.zeros((n, len(x)), bool)
    seen[:, start] = True
    expanded, live = [], np.arange(n)
    while len(live):
        first = open_[live].argmax(axis=1)
        go = open_[live, first]
        live, first = live[go], first[go]
        if not len(live):
            break
        node = ids[live, first]
        open_[live, first] = False
        step = np.full(n, -1)
        step[live] = node
        expanded.append(step)
        near = graph[node]
        new = near >= 0
        near = np.where(new, near, 0)
        new &= ~seen[live[:, None], near]
        seen[live[:, None], near] |= new
        d = np.where(new, _block_distances(x, q[live], near), np.inf)
        all_d = np.concatenate([dist[live], d], axis=1)
        best = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
        all_i = np.concatenate([ids[live], np.where(new, near, -1)], axis=1)
        all_o = np.concatenate([open_[live], new], axis=1)
        dist[live] = np.take_along_axis(all_d, best, 1)
        ids[live] = np.take_along_axis(all_i, best, 1)
        open_[live] = np.take_along_axis(all_o, best, 1) & np.isfinite(dist[live])
    return ids, dist, np.stack(expanded, axis=1) if expanded else np.full((n, 1), -1)


def robust_prune(x: np.ndarray, rows: np.ndarray, cand: np.ndarray, alpha: float, degree: int) -> np.ndarray:
    """Out-edges (-1 padded) of ``rows`` from their candidates (-1: none)."""
    cand = np.sort(cand, axis=1)
    again = np.zeros(cand.shape, bool)
    again[:, 1:] = cand[:, 1:] == cand[:, :-1]
    gone = again | (cand < 0) | (cand == rows[:, None])
    safe = np.where(cand < 0, 0, cand)
    d = np.where(gone, np.inf, _block_distances(x, x[rows], safe))
    order = np.argsort(d, axis=1, kind="stable")[:, :4 * degree]
    d, safe = np.take_along_axis(d, order, 1), np.take_along_axis(safe, order, 1)
    v = x[safe] - x[rows][:, None, :]           # near copies keep their digits
    norm = np.einsum("ijk,ijk->ij", v, v)
    among = np.maximum(norm[:, :, None] + norm[:, None, :] - 2 * v @ v.transpose(0, 2, 1), 0)
    left = np.isfinite(d)
    out = np.full((len(rows), degree), -1)
    every = np.arange(len(rows))
    for slot in range(degree):
        pick = left.argmax(axis=1)              # the nearest left: columns are in order
        some = left[every, pick]
        if not some.any():
            break
        out[some, slot] = safe[some, pick[some]]
        left &= ~((alpha * alpha) * among[every, pick] <= d)
        left[every, pick] = False
    return out


def starts(x: np.ndarray, most: int = STARTS) -> np.ndarray:
    """The medoid, then one after another the vector that is farthest from all
    taken; half of them among a random few, as the farthest are outliers."""
    rng = np.random.default_rng(1)
    taken = [int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())]
    far = ((x - x[taken[0]]) ** 2).sum(axis=1)
    while len(taken) < min(most, len(x)) and far.max() > 0:
        pool = np.arange(len(x)) if len(taken) % 2 else rng.integers(0, len(x), 8)
        new = int(pool[far[pool].argmax()])
        if far[new] <= 0:
            new = int(far.argmax())
        taken.append(new)
        far = np.minimum(far, ((x - x[new]) ** 2).sum(axis=1))
    return np.array(taken)


def reached(graph: np.ndarray, start: np.ndarray) -> np.ndarray:
    seen = np.zeros(len(graph), bool)
    seen[start] = True
    wave = start
    while len(wave):
        wave = np.unique(graph[wave])
        wave = wave[wave >= 0]
        wave = wave[~seen[wave]]
        seen[wave] = True
    return seen


def linked(x: np.ndarray, graph: np.ndarray, start: np.ndarray) -> np.ndarray:
    """``graph`` with two more columns: nodes that weren't reached have an
    edge from the nearest that was; those of one nearest form a chain."""
    graph = np.hstack([graph, np.full((len(graph), 2), -1)])
    good = reached(graph, start)
    lost, there = np.flatnonzero(~good), np.flatnonzero(good)
    if not len(lost):
        return graph
    near, d = np.empty(len(lost), np.int64), np.empty(len(lost))
    for part in np.array_split(np.arange(len(lost)), -(-len(lost) // BLOCK)):
        apart = ((x[lost[part], None, :] - x[None, there[:1], :]) ** 2).sum(axis=2)
        near[part], d[part] = there[0], apart[:, 0]
        for some in np.array_split(there, max(1, -(-len(there) // BLOCK))):
            apart = ((x[lost[part], None, :] - x[None, some, :]) ** 2).sum(axis=2)
            at = apart.argmin(axis=1)
            best = apart[np.arange(len(part)), at]
            closer = best < d[part]
            near[part] = np.where(closer, some[at], near[part])
            d[part] = np.where(closer, best, d[part])
    last: dict[int, int] = {}
    for i in np.argsort(d, kind="stable"):
        node, to = int(near[i]), int(lost[i])
        if node in last:
            graph[last[node], -1] = to
        else:
            graph[node, -2] = to
        last[node] = to
    return graph


def wide_enough(x: np.ndarray, graph: np.ndarray, start: np.ndarray, k: int) -> int:
    """The beam at which searches for a sample of ``x`` find ``RECALL`` of the
    nearest by distance, on the worst third, too; the shard's size if none."""
    rng = np.random.default_rng(2)
    who = rng.permutation(len(x))[:SAMPLE]
    q, k = x[who], min(k + 1, len(x))
    true = np.empty((len(who), k))
    for part in np.array_split(np.arange(len(who)), max(1, -(-len(who) // 16))):
        d = ((q[part, None, :] - x[None, :, :]) ** 2).sum(axis=2) if len(x) * len(part) * x.shape[1] < 1 << 24 else \
            np.stack([((x - v) ** 2).sum(axis=1) for v in q[part]])
        true[part] = np.sort(d, axis=1)[:, :k]
    beam = max(SEARCH_BEAM, 2 * k)
    while beam < len(x):
        _, d, _ = beam_search(x, graph, start, q, beam)
        share = np.sort((d[:, :k] <= true[:, -1:] * (1 + 1e-9)).mean(axis=1))
        if share[:max(1, len(share) // 3)].mean() >= RECALL:
            return beam
        beam *= 2
    return len(x)


def build(x: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Graph (n x DEGREE + 2, -1 padded) and the start nodes of vectors ``x``."""
    n = len(x)
    rng = np.random.default_rng(seed)
    start = starts(x)
    graph = rng.integers(0, n, (n, DEGREE))
    graph[graph == np.arange(n)[:, None]] = -1
    for alpha in (1.0, ALPHA):
        for rows in np.array_split(rng.permutation(n), max(1, -(-n // BLOCK))):
            beam, _, went = beam_search(x, graph, start, x[rows], BUILD_BEAM)
            graph[rows] = robust_prune(x, rows, np.concatenate([beam, went, graph[rows]], axis=1), alpha, DEGREE)
            # edges back, and pruning of what overflows
            src, dst = np.repeat(rows, DEGREE), graph[rows].ravel()
            ok = dst >= 0
            src, dst = src[ok], dst[ok]
            order = np.argsort(dst, kind="stable")
            src, dst = src[order], dst[order]
            to, begin, count = np.unique(dst, return_index=True, return_counts=True)
            place = np.arange(len(dst)) - np.repeat(begin, count)
            more = np.full((len(to), min(int(count.max(initial=1)), 4 * DEGREE)), -1)
            fits = place < more.shape[1]
            more[np.repeat(np.arange(len(to)), count)[fits], place[fits]] = src[fits]
            for part in np.array_split(np.arange(len(to)), max(1, -(-len(to) // BLOCK))):
                graph[to[part]] = robust_prune(x, to[part], np.concatenate([graph[to[part]], more[part]], axis=1),
                                               alpha, DEGREE)
    return linked(x, graph, start).astype(np.int32), start


SHARDS = "dim int, shard int, x binary, graph binary, start binary, beam int, member binary, node binary"


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, v: array of double) of the rows that take part."""
    v = F.col("v")
    finite = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v")) \
        .where(F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists("v", lambda e: e != 0))


def _matrix(col: pa.Array) -> np.ndarray:
    return np.array(col.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(col), -1)


def index(vectors: DataFrame, k: int) -> DataFrame:
    """One row a shard: dim, shard, packed distinct vectors, graph, members.

    Equal vectors are one node with the ``k`` + 1 smallest vec_ids, more of
    which no result can hold. Vectors of another length get shards of their
    own: they are no candidates of each other.
    """
    counts = {r.dim: r.n for r in vectors.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).collect()}
    shards = F.coalesce(*[F.when(F.col("dim") == d, F.lit(-(-n // SHARD))) for d, n in sorted(counts.items())],
                        F.lit(1))
    # as many tasks as shards, so that no two graphs are built one after another
    keyed = vectors.withColumn("dim", F.size("v")) \
        .withColumn("shard", F.pmod(F.xxhash64("vec_id"), shards).cast("int")) \
        .repartition(max(1, 2 * sum(-(-n // SHARD) for n in counts.values())), "dim", "shard")

    def pack(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        ids = t.column("vec_id").to_numpy()
        x = _matrix(t.column("v").combine_chunks() if t.num_rows else pa.array([], pa.list_(pa.float64())))
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        order = np.lexsort((*x.T[::-1], ids))               # of repeated ids the least vector counts
        ids, once = np.unique(ids[order], return_index=True)
        x = x[order][once]
        node_x, node = np.unique(x, axis=0, return_inverse=True)
        by = np.argsort(node.ravel(), kind="stable")            # ids are in order inside a node
        nth = np.arange(len(by)) - np.searchsorted(node.ravel()[by], node.ravel()[by])
        by = by[nth <= k]
        graph, start = build(node_x)
        beam = wide_enough(node_x, graph, start, k)
        return pa.table({"dim": t.column("dim").slice(0, 1), "shard": t.column("shard").slice(0, 1),
                         "x": pa.array([node_x.tobytes()], pa.binary()),
                         "graph": pa.array([graph.tobytes()], pa.binary()), "start": pa.array([start.astype(np.int32).tobytes()], pa.binary()),
                         "beam": pa.array([beam], pa.int32()),
                         "member": pa.array([ids[by].tobytes()], pa.binary()),
                         "node": pa.array([node.ravel()[by].astype(np.int64).tobytes()], pa.binary())})

    return keyed.groupBy("dim", "shard").applyInArrow(
        pack, SHARDS)


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, column: str = "embedding") -> DataFrame:
    """The ``k`` nearest found of each query: query_id, rank, vec_id, score.

    Queries and vectors are (vec_id, embedding) rows; a query isn't its own
    candidate, and candidates have its length. Null ids, and vectors that are
    null, zero or hold null or non-finite components, take no part; repeated
    rows of an id count once; equal vectors are ordered by vec_id. No vectors
    or queries give no rows.
    """
    v, q = usable(vectors, column), usable(queries, column)
    shards = settle(index(v, k), "graphs")
    n = q.count()
    blocks = -(-n // QUERY_BLOCK) or 1

    def pack(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        ids, x = t.column("vec_id").to_numpy(), _matrix(t.column("v").combine_chunks())
        order = np.lexsort((*x.T[::-1], ids))               # of repeated ids the least vector counts
        ids, once = np.unique(ids[order], return_index=True)
        return pa.table({"dim": t.column("dim").slice(0, 1), "block": t.column("block").slice(0, 1),
                         "ids": pa.array([ids.tobytes()], pa.binary()),
                         "q": pa.array([x[order][once].tobytes()], pa.binary())})

    packed = q.withColumn("dim", F.size("v")) \
        .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")) \
        .groupBy("dim", "block").applyInArrow(pack, "dim int, block int, ids binary, q binary")
    many = shards.groupBy("dim").agg((F.max("shard") + 1).alias("shards"))
    asked = packed.join(many, "dim").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    # A shard's row sorts before the blocks that are searched in it.
    rows = shards.withColumn("block", F.lit(-1)).unionByName(asked.drop("shards"), allowMissingColumns=True)
    tasks = max(1, 2 * shards.count())

    def run(batches):
        shard = None
        for batch in batches:
            for row in range(batch.num_rows):
                get = {name: batch.column(i)[row] for i, name in enumerate(batch.schema.names)}
                if get["block"].as_py() < 0:
                    shard = _Shard(get)
                elif shard is not None and shard.key == (get["dim"].as_py(), get["shard"].as_py()):
                    yield shard.search(get, k)

    found = rows.repartition(tasks, "dim", "shard").sortWithinPartitions("dim", "shard", "block") \
        .mapInArrow(run, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


class _Shard:
    def __init__(self, get: dict):
        self.key = self.dim, _ = get["dim"].as_py(), get["shard"].as_py()
        buffer = {c: get[c].as_buffer() for c in ("x", "graph", "start", "member", "node")}
        self.x = np.frombuffer(buffer["x"], np.float64).reshape(-1, self.dim)
        self.graph = np.frombuffer(buffer["graph"], np.int32).reshape(len(self.x), -1)
        self.start = np.frombuffer(buffer["start"], np.int32)
        self.member, self.node = np.frombuffer(buffer["member"], np.int64), np.frombuffer(buffer["node"], np.int64)
        self.beam = get["beam"].as_py()

    def search(self, get: dict, k: int) -> pa.RecordBatch:
        x, member = self.x, self.member
        q = np.frombuffer(get["q"].as_buffer(), np.float64).reshape(-1, self.dim)
        ids = np.frombuffer(get["ids"].as_buffer(), np.int64)
        out = [[np.empty(0, t)] for t in (np.int64, np.int64, np.float64)]
        begin = np.searchsorted(self.node, np.arange(len(x) + 1))
        for part in np.array_split(np.arange(len(q)), max(1, -(-len(q) // BLOCK))):
            near, d = self._near(q[part], k)
            near = np.where(np.isfinite(d), near, -1)[:, :k + 1]
            for i, nodes in zip(part, near):
                nodes = nodes[nodes >= 0]
                who = np.concatenate([member[begin[j]:begin[j + 1]] for j in nodes])
                score = np.repeat(np.sqrt(((x[nodes] - q[i]) ** 2).sum(axis=1)), begin[nodes + 1] - begin[nodes])
                other = who != ids[i]
                who, score = who[other], score[other]
                best = np.lexsort((who, score))[:k]
                out[0].append(np.full(len(best), ids[i]))
                out[1].append(who[best])
                out[2].append(score[best])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["query_id", "vec_id", "score"])

    def _near(self, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        if self.beam < len(self.x):
            near, d, _ = beam_search(self.x, self.graph, self.start, q, self.beam)
            return near, d
        near, dist = [], []                     # the shard's beam is the shard
        for v in q:
            d = ((self.x - v) ** 2).sum(axis=1)
            best = np.argsort(d, kind="stable")[:k + 1]
            near.append(np.append(best, np.full(k + 1 - len(best), -1)))
            dist.append(np.append(d[best], np.full(k + 1 - len(best), np.inf)))
        return np.array(near), np.array(dist)


def op8(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where(F.col("vec_id") % 100 == 0))
