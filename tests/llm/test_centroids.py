"""Centroid clustering: encoding without loss, and the rounds in plain Python."""

import hashlib
import math

import numpy as np
import pytest

pytest.importorskip("pricewatch.llm")

from pricewatch.llm import centroids as ce  # noqa: E402
from pricewatch.llm.ship import ship  # noqa: E402


def plain(rows, k, rounds, dim, scale, seed):
    """rows: (id, vector). Centroids, and (id, cluster, distance) of all."""
    x = [[math.floor(scale * float(v)) for v in vec] for _, vec in rows]
    by = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, hashlib.sha256(
        f"{seed}:{rows[i][0]}".encode()).hexdigest() if rows[i][0] is not None else "", rows[i][1]))
    c = [x[i] for i in by[:k]]

    def near(v):
        d = [sum((a - b) ** 2 for a, b in zip(v, m)) for m in c]
        return d.index(min(d)), min(d)
    for _ in range(rounds):
        at = [near(v)[0] for v in x]
        groups = [[v for v, a in zip(x, at) if a == j] for j in range(len(c))]
        c = [[sum(col) // len(g) for col in zip(*g)] if g else old for g, old in zip(groups, c)]
    return c, [(rows[i][0], *near(v)) for i, v in enumerate(x)]


def check(spark, rows, dim, k=4, rounds=3, kind="float"):
    ship(spark)
    good = [(i, v) for i, v in rows if v is not None and len(v) == dim
            and all(e is not None and math.isfinite(e) for e in v)]
    d = spark.createDataFrame([(i, v, "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, _cluster string")
    c, want = plain(good, k, rounds, dim, 1024, 3)
    model = ce.fit(d, k, rounds, dim)
    out = ce.assign(d, model, dim)
    assert out.columns == ["vec_id", "embedding", "_cluster", "_cluster_"]
    got = [(r.vec_id, r._cluster_.cluster, r._cluster_.distance) for r in out.collect()]
    assert model.centroids == c
    assert sorted(got, key=repr) == sorted(
        ((i, j, x if x < 2 ** 63 else None) for i, j, x in want), key=repr)
    assert model.inertia == sum(x for _, _, x in want)
    assert model.cluster_inertia == [sum(x for _, j, x in want if j == n) for n in range(len(c))]


def test_encoding_is_lossless():
    rng = np.random.default_rng(0)
    copies = np.repeat(rng.integers(-9, 9, (3, 12)), 40, axis=0).astype(float)
    for x in (rng.integers(-500, 500, (300, 12)).astype(float), copies, copies[:1], np.zeros((5, 7))):
        blocks = ce.encode(x)
        assert (np.hstack([b.words[b.codes] for b in blocks]) == x).all()
        assert [b.first for b in blocks] == np.cumsum([0, *(b.words.shape[1] for b in blocks)])[:-1].tolist()
    assert len(ce.encode(copies)) == 1 and len(ce.encode(copies)[0].words) == 3


def test_rounds(spark):
    rng = np.random.default_rng(1)
    rows = [(i, np.float32(v).tolist()) for i, v in enumerate(rng.normal(size=(300, 6)))]
    rows += [(400 + i, [0.5] * 6) for i in range(150)] + [(7, [0.25] * 6)] * 3          # copies, repeated ids
    rows += [(600, None), (601, [1.0] * 5), (602, [float("nan")] * 6), (603, [1.0, None, 1.0, 1.0, 1.0, 1.0]),
             (604, [float("inf")] * 6), (None, [0.125] * 6)]
    check(spark, rows, 6)


def test_few_and_none(spark):
    check(spark, [(1, [0.0, 1.0]), (2, [0.0, 1.0]), (None, [3.0, -2.0])], 2)     # ties, fewer rows than centroids
    d = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    model = ce.fit(d)
    assert model == ce.Model([], []) and ce.assign(d, model).count() == 0 and model.inertia == 0


def test_numbers_beyond_a_long(spark):
    check(spark, [(1, [3e300, -2.5]), (2, [1e30, 7.0]), (3, [-4e300, 1.0]), (4, [1.0, 2.0]), (5, [1.5, 2.0]),
                  (6, [1e305, 9.0])], 2, k=2, kind="double")
