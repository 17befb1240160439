"""Importance resampling: CRC against zlib, and the rule in plain Python."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest

pytest.importorskip("pricewatch.llm")

from pricewatch.llm import importance as im  # noqa: E402
from pricewatch.llm.ship import ship  # noqa: E402

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_crc():
    data = np.random.default_rng(0).integers(0, 256, 40_000).astype(np.uint8)
    size = np.array([*range(1, 10), 255, 256, 257, 511, 512, 513, 1024, 30_000])
    start = np.arange(len(size)) * 7
    assert im.span_crc(data, start, start + size).tolist() == [
        zlib.crc32(data[a:a + n].tobytes()) for a, n in zip(start, size)]
    assert len(im.span_crc(data, start[:0], start[:0])) == 0


def plain(docs, target, buckets, fewest, most, percent, least):
    def features(text):
        w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
        return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets
                        for n in range(fewest, most + 1) for i in range(len(w) - n + 1)]
    s, t = np.zeros(buckets), np.zeros(buckets)
    for text in (x for _, x in docs):
        np.add.at(s, features(text)[1], 1)
    for text in target:
        np.add.at(t, features(text)[1], 1)
    rows = []
    for i, text in docs:
        n, f = features(text)
        g = [math.floor(1000 * math.log((t[b] + 1) * (s.sum() + buckets) / ((s[b] + 1) * (t.sum() + buckets))))
             for b in f]
        w = sum(g) // len(g) if g else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, n, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], -1 if r[0] is None else r[0]))
    rank = {r[0]: j + 1 for j, r in enumerate(able[:percent * len(able) // 100])}
    return sorted(((*r, rank.get(r[0])) for r in rows), key=repr)


@pytest.mark.parametrize("fewest,most,percent", [(1, 1, 10), (1, 2, 50), (2, 3, 100)])
def test_rule(spark, fewest, most, percent):
    ship(spark)
    rng = np.random.default_rng(3)
    words = ["Ab", "é", "c" * 300, "日本", "x1", "the", "Z"]
    docs = [(i, " ,".join(rng.choice(words, rng.integers(0, 40)))) for i in range(200)]
    docs += [(1000, None), (1001, ""), (1002, "..."), (None, "the x1 " * 30), (1003, "long " * 60_000 + "y" * 70_000)]
    target = ["the x1 the", None, "é É ab"]
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, _draw int")
    b = spark.createDataFrame([(t,) for t in target], "text string")
    out = im.resample(d, b, percent, 20, 500, fewest, most)
    assert out.columns == ["doc_id", "text", "_draw", "_draw_"]
    got = sorted(((r.doc_id, *(r._draw_[c] for c in im.RESULT)) for r in out.collect()), key=repr)
    assert got == plain(docs, target, 500, fewest, most, percent, 20)


def test_repeated_and_empty(spark):
    ship(spark)
    d = spark.createDataFrame([(i // 100, "w " * 30) for i in range(1000)], "doc_id long, text string")
    none = d.where("doc_id = 99")
    got = im.resample(d, none, percent=25)
    assert sorted(r._draw.rank for r in got.collect() if r._draw.rank) == list(range(1, 251))
    assert im.resample(none, d).count() == 0
    assert im.resample(d, d, percent=0).where("_draw.rank is not null").count() == 0
