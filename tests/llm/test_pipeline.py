"""The corpus pipeline against a plain Python version of its stages, on a small
table whose cases are clear-cut."""

import os
import re

import numpy as np
import pytest

pytest.importorskip("pricewatch.llm")
pipeline = pytest.importorskip("corpus_pipeline")

from test_llm import water  # noqa: E402

SPOTS = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def shingles(text):
    w = SPOTS.findall(low(text))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain(docs, items):
    """doc_id to text of what the first four stages keep."""
    docs = {i: t for i, t in docs if t and re.search(r"[^\W\d_]", t)}
    sets = {i: shingles(t) for i, t in docs.items()}
    up = {i: i for i in docs}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for a in docs:
        for b in docs:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    docs = {i: t for i, t in docs.items() if root(i) == i}
    seen, out = set(), {}
    for i in sorted(docs):
        lines = docs[i].split("\n")
        left = [x for x in lines if low(x) not in seen or len(x.split()) < 20]
        seen |= {low(x) for x in lines}
        if "\n".join(left).strip():
            out[i] = "\n".join(left) if len(left) < len(lines) else docs[i]
    windows = {tuple(w[j:j + 13]) for t in items for w in [PLAIN.findall(low(t))] for j in range(len(w) - 12)}
    kept = {}
    for i, t in out.items():
        w = PLAIN.findall(low(t))
        hit = {j + k for j in range(len(w) - 12) if tuple(w[j:j + 13]) in windows for k in range(13)}
        if not (hit and 20 * len(hit) >= len(w)):
            kept[i] = t
    return kept


def test_pipeline(spark, scratch):
    rng = np.random.default_rng(12)
    vocabulary = {"en": [f"th{a}{b}ing" for a in "aeiou" for b in "bcdfg"], "de": [f"sch{a}{b}en" for a in "aeiou"
                                                                               for b in "klmnr"]}

    def words(n, lang):
        return [w + "bcdfghklmn"[rng.integers(0, 10)] + "aeiou"[rng.integers(0, 5)]
                for w in rng.choice(vocabulary[lang], n)]
    item = words(30, "en")
    passage = " ".join(words(60, "en"))
    rows = []
    for i in range(90):
        lang = ("en", "de")[i % 2]
        lines = [" ".join(words(40, lang)) for _ in range(3)]
        if i in (10, 20, 30):
            lines.insert(1, passage)
        if i in (40, 44):
            lines.append(" ".join(item))
        rows.append([i, "\n".join(lines), lang, ("a", "b", None, "c")[i % 4]])
    rows.append([90, rows[3][1], "de", "a"])                                # an exact copy
    changed = rows[5][1].split(" ")
    changed[50] = "other"
    rows.append([91, " ".join(changed), "de", "b"])                         # a near copy
    rows += [[92, "", "en", "a"], [93, None, "en", "a"], [94, "12 34 !!", "en", "b"]]
    folder = os.path.join(scratch, "sf")
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, "
                          "source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")

    want = plain([(r[0], r[1]) for r in rows], [" ".join(item)])
    source = {r[0]: r[3] for r in rows}
    got = pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in got} <= set(want)
    assert 44 in want and not {40, 90, 91, 92, 93, 94} & {r.doc_id for r in got}
    assert all(r.text == want[r.doc_id] and r.n_chars == len(r.text) and r.source == source[r.doc_id] for r in got)
    sizes = {}
    for i, t in want.items():
        sizes[source[i]] = sizes.get(source[i], 0) + len(t.split())
    goal = water(sizes)
    for s, target in goal.items():
        taken = sum(len(r.text.split()) for r in got if r.source == s)
        assert abs(taken - target) <= 130, (s, taken, target)              # a document
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert pipeline.mixing_sources(spark, docs.limit(0), folder).count() == 0
    for name, stage in pipeline.STAGES[:4]:
        empty = stage(spark, docs.limit(0), folder)
        assert empty.columns == docs.columns and empty.count() == 0, name
