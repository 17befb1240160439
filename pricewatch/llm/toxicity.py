"""Toxic spans and document scores by a linear-chain CRF (operator 2).

Labels come by document. Over all learning rows, the documents of each class
that hold a feature are counted; in a toxic document the tokens whose best
feature is surely and much likelier in toxic documents are labelled toxic, or
else its best token if that has such a feature, and all other tokens clean. A conditional random field with two
states is fitted to these labelled tokens on a bounded sample of documents
(``SAMPLE`` of either class, the smallest hashes of doc_id). Forward-backward
marginals of its tokens give a document's score, by a calibrated logistic
function of the largest and the summed marginal, and its offending offsets:
runs of tokens whose marginal is at least one half.

Features of a token are hashes of the word and of its first bytes, so words
with a known beginning are recognised.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewatch.llm import textscan as ts
from pricewatch.llm.langid import held_out
from pricewatch.llm.settle import settle, spare, table

BUCKETS = 1 << 20
PREFIXES = (4, 5, 6, 8)         # bytes
SAMPLE = 1200                   # documents of either class that the CRF is fitted on
SAMPLE_BYTES = 1 << 16          # longer documents aren't in that sample
ODDS = 2.0                      # log odds a labelling feature needs,
SURE = 16.0                     # and the log likelihood ratio to an equal share in both classes
STEPS = 40
RIDGE = 1e-3


def features(buf: np.ndarray, w: ts.Words) -> np.ndarray:
    """Buckets (features x tokens) of all tokens."""
    low = ts.PLAIN.fold[buf]
    rows = [w.hash]
    for i, size in enumerate(PREFIXES):
        h = ts.span_hash(low, w.start, np.minimum(w.end, w.start + size))
        rows.append(ts.mix(h + np.uint64(i + 1)))
    return np.stack(rows).astype(np.uint64).view(np.int64) & (BUCKETS - 1)


class Chain:
    """The two-state field: feature weights, transitions, start weights (all
    as logarithms; the clean state's emissions are 0)."""

    def __init__(self, weight=None, step=None, start=None, bias=-4.0):
        self.weight = np.zeros(BUCKETS, np.float32) if weight is None else weight
        self.step = np.zeros((2, 2)) if step is None else step
        self.start = np.zeros(2) if start is None else start
        self.bias = bias

    def emissions(self, buckets: np.ndarray) -> np.ndarray:
        return self.weight[buckets].sum(axis=0, dtype=np.float64) + self.bias

    def marginals(self, emission: np.ndarray, first: np.ndarray):
        """Of chains laid end to end (``first``: a chain begins here): the
        probability of the toxic state at each token, and of each pair of
        states at each step inside a chain.

        A step is a 2 x 2 matrix; at a chain's begin both of its rows are the
        start weights, which cuts the chains apart. The line of tokens is
        folded into rows of about equal length that advance together: one pass
        multiplies each row's matrices, one carries vectors over the rows, one
        fills in the tokens.
        """
        n = len(emission)
        if not n:
            return np.zeros(0), np.zeros((0, 2, 2))
        length = max(1, int(np.sqrt(n)))
        rows = -(-n // length)
        odds = np.exp(np.clip(emission, -30, 30))
        m = np.empty((rows * length, 2, 2))
        m[:n] = np.exp(self.step)
        m[:n][first] = np.exp(self.start)
        m[:n, :, 1] *= odds[:, None]
        m[n:] = np.eye(2)
        m /= m.sum(axis=(1, 2), keepdims=True)
        m = m.reshape(rows, length, 2, 2)
        whole = m[:, 0].copy()
        for t in range(1, length):
            whole = whole @ m[:, t]
            whole /= whole.sum(axis=(1, 2), keepdims=True)
        a, b = np.full((rows, 2), 0.5), np.full((rows, 2), 0.5)
        for r in range(1, rows):
            v = a[r - 1] @ whole[r - 1]
            a[r] = v / v.sum()
        for r in range(rows - 2, -1, -1):
            v = whole[r + 1] @ b[r + 1]
            b[r] = v / v.sum()
        before, after = np.empty((rows, length, 2)), np.empty((rows, length, 2))
        for t in range(length):
            before[:, t] = a
            a = (a[:, :, None] * m[:, t]).sum(axis=1)
            a /= a.sum(axis=1, keepdims=True)
        for t in range(length - 1, -1, -1):
            after[:, t] = b
            b = (m[:, t] * b[:, None, :]).sum(axis=2)
            b /= b.sum(axis=1, keepdims=True)
        pair = before[..., :, None] * m * after[..., None, :]
        pair = pair.reshape(-1, 2, 2)[:n]
        pair /= pair.sum(axis=(1, 2), keepdims=True)
        return pair[:, :, 1].sum(axis=1), pair


def fit(buckets: np.ndarray, first: np.ndarray, label: np.ndarray, steps: int = STEPS) -> Chain:
    """The field fitted to labelled tokens (Adam on the whole sample)."""
    chain, n = Chain(), max(1, len(label))
    inner = ~first
    seen = np.zeros((2, 2))
    previous = np.concatenate([[0], label[:-1]])
    np.add.at(seen, (previous[inner], label[inner]), 1)
    begun = np.bincount(label[first], minlength=2)
    value = [chain.weight.astype(np.float64), chain.step, chain.start, np.array([chain.bias])]
    one, two = [np.zeros_like(v) for v in value], [np.zeros_like(v) for v in value]
    flat = buckets.ravel()
    for i in range(1, steps + 1):
        p, pair = chain.marginals(chain.emissions(buckets), first)
        error = (p - label) * 1.0
        slope = [np.bincount(flat, np.tile(error, len(buckets)), minlength=BUCKETS) / n + RIDGE / n * value[0],
                 (pair[inner].sum(axis=0) - seen) / n,
                 (np.array([(1 - p[first]).sum(), p[first].sum()]) - begun) / n, np.array([error.sum() / n])]
        for v, g, a, b in zip(value, slope, one, two):
            a *= 0.9
            a += 0.1 * g
            b *= 0.99
            b += 0.01 * g * g
            v -= 0.3 * (a / (1 - 0.9 ** i)) / (np.sqrt(b / (1 - 0.99 ** i)) + 1e-9)
        chain.weight, chain.step, chain.start, chain.bias = (
            value[0].astype(np.float32), value[1], value[2], float(value[3][0]))
    return chain


def _tokens(col: pa.Array):
    """Offsets, words, features and chain starts. Letters are read in lower
    case wherever that leaves a text's bytes in place."""
    low = pc.utf8_lower(col)
    buf, off = ts.text_buffer(pc.if_else(pc.equal(pc.binary_length(low), pc.binary_length(col)), low, col))
    w = ts.words(buf, off, ts.PLAIN)
    first = np.zeros(len(w.hash), bool)
    some = np.flatnonzero(np.diff(w.first))
    first[w.first[some]] = True
    return off, w, features(buf, w) if len(w.hash) else np.zeros((1 + len(PREFIXES), 0), np.int64), first


def _evidence(w: ts.Words, p: np.ndarray) -> np.ndarray:
    """(rows x 3): 1, logit of the largest marginal, logarithm of their sum."""
    rows = len(w.first) - 1
    most, total = np.full(rows, 1e-9), np.zeros(rows)
    some = np.flatnonzero(np.diff(w.first))
    if len(some):
        most[some] = np.maximum.reduceat(p, w.first[some])
        total[some] = np.add.reduceat(p, w.first[some])
    most = np.clip(most, 1e-9, 1 - 1e-9)
    return np.stack([np.ones(rows), np.log(most / (1 - most)), np.log(total + 1e-6)], axis=1)


def _calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps with a ridge."""
    b = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(b))
        b = b + np.clip(np.linalg.solve(h, x.T @ (weight * (y - p)) - 1e-2 * b), -5, 5)
    return b


def learn(labelled: DataFrame) -> dict:
    """The model from (doc_id, text, toxic) rows; null texts and labels are
    left out. Without documents of both classes it scores 0."""
    rows = labelled.where("text is not null and toxic in (0, 1)") \
        .select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"))
    rows = settle(rows, "labelled")             # the join is run once; three passes read its rows

    def count(batches):
        sums = np.zeros((2, BUCKETS), np.int64)
        docs = np.zeros(2, np.int64)
        for piece in ts.slices(batches, budget=1 << 20):
            _, w, f, _ = _tokens(piece.column("text"))
            toxic = piece.column("toxic").to_numpy()
            docs += np.bincount(toxic, minlength=2)
            once = np.unique(np.tile(w.doc, len(f)) * BUCKETS + f.ravel())
            for c in (0, 1):
                here = once[toxic[once // BUCKETS] == c]
                sums[c] += np.bincount(here % BUCKETS, minlength=BUCKETS)
        at = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(sums[0][at], docs[0])),
                                          pa.array(np.append(sums[1][at], docs[1]))], ["bucket", "clean", "toxic"])

    counts = rows.mapInArrow(count, "bucket long, clean long, toxic long").groupBy("bucket") \
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")) \
        .where("toxic > 0 or bucket < 0").toArrow()       # at most BUCKETS rows
    bucket, clean, toxic = (counts.column(c).to_numpy() for c in ("bucket", "clean", "toxic"))
    n = {c: int(v[bucket < 0].sum()) for c, v in ((0, clean), (1, toxic))}
    if not n[0] or not n[1]:
        return {"chain": None}
    odds = np.full(BUCKETS, -10.0)
    at = bucket >= 0
    bucket, clean, toxic = bucket[at], clean[at], toxic[at]
    share, base = toxic / (toxic + clean), n[1] / (n[0] + n[1])
    ratio = toxic * np.log(share / base) + clean * np.log(np.maximum(1 - share, 1e-12) / (1 - base))
    odds[bucket] = np.where(ratio >= SURE, np.log((toxic + 0.5) / (n[1] + 1))
                            - np.log((clean + 0.5) / (n[0] + 1)), -10.0)
    short = rows.where(F.octet_length("text") <= SAMPLE_BYTES)
    chosen = [r.doc_id for c in (0, 1) for r in short.where(F.col("toxic") == c).select("doc_id")
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).collect()]
    sample = short.where(F.col("doc_id").isin(chosen)).dropDuplicates(["doc_id"]).orderBy("doc_id") \
        .toArrow().combine_chunks()
    _, w, f, first = _tokens(sample.column("text"))
    y = sample.column("toxic").to_numpy()
    best = odds[f].max(axis=0)
    label = (best >= ODDS) & (y[w.doc] == 1)
    for i in np.flatnonzero((y == 1) & (np.diff(w.first) > 0)):
        mine = slice(w.first[i], w.first[i + 1])
        if not label[mine].any() and best[mine].max() > 0:
            label[w.first[i] + best[mine].argmax()] = True
    chain = fit(f, first, label.astype(np.int64))
    p, _ = chain.marginals(chain.emissions(f), first)
    share = np.array([n[c] / max(1, (y == c).sum()) for c in (0, 1)])
    return {"chain": chain, "calibration": _calibrate(_evidence(w, p), y, share[y] / share.max())}


def tag(docs: DataFrame, model: dict, name: str = "_toxic") -> DataFrame:
    """``docs`` with its columns and the struct ``name``: score (0 to 1) and
    spans (byte offsets, end exclusive) of toxic runs.

    Null, empty and wordless texts get the score of no evidence and no spans.
    Only the text plays a part; repeated rows get equal results.
    """
    docs = docs.drop(name)          # a column of that name is replaced
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = docs.columns.index("text")
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    kind = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(span))])
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        model = shared.value
        for piece in ts.slices(batches, budget=1 << 20):
            score, spans = np.zeros(piece.num_rows), [[]] * piece.num_rows
            if model["chain"] is not None:
                off, w, f, first = _tokens(piece.column(text))
                p, _ = model["chain"].marginals(model["chain"].emissions(f), first)
                z = _evidence(w, p) @ model["calibration"]
                score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                spans = _runs(w, p >= 0.5, off, first)
            found = pa.StructArray.from_arrays([pa.array(score), pa.array(spans, arrow)], names=["score", "spans"])
            yield pa.RecordBatch.from_arrays([*piece.columns, found], [*piece.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, kind)]))


def _runs(w: ts.Words, toxic: np.ndarray, off: np.ndarray, first: np.ndarray) -> list[list[dict]]:
    out = [[] for _ in range(len(off) - 1)]
    before = np.concatenate([[False], toxic[:-1]]) & ~first
    for i in np.flatnonzero(toxic & ~before):
        j = i
        while j + 1 < len(toxic) and toxic[j + 1] and not first[j + 1]:
            j += 1
        doc = w.doc[i]
        out[doc].append({"start": int(w.start[i] - off[doc]), "end": int(w.end[j] - off[doc])})
    return out


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of the rows that may be learned from; of several
    labels of a document the largest counts. Labels grow with the documents, so
    they are never broadcast."""
    once = labels.where("doc_id is not null and toxic is not null") \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return docs.where(~held_out(F.col("doc_id"), 5, 0)).select("doc_id", "text") \
        .join(once.where(~held_out(F.col("doc_id"), 5, 0)).hint("merge"), "doc_id")


def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(labelled_rows(docs, table(spark, sf_dir, "labels")))
    name = spare(docs, "_toxic")
    found = F.col(name)
    return tag(docs, model, name).select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), found["score"].alias("score"),
        (found["score"] >= 0.5).cast("int").alias("predicted"), found["spans"].alias("spans"))
