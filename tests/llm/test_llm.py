"""Small cases of the text operators: nulls, empty and long texts, ties,
repeated rows, empty tables, clashing columns, brute force."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("pricewatch.llm")

from pricewatch.llm import (ann, chat, decontam, html_text, langid, mixing, paragraphs, setsketch, tokencount,
                            toxicity)  # noqa: E402
from pricewatch.llm import textscan as ts  # noqa: E402
from pricewatch.llm.ship import ship  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _mix long, _overlap long, _lang long"
LONG = " ".join(f"w{i}" for i in range(20_000))
PASSAGE = " ".join(f"p{i}" for i in range(60))


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    near = " ".join("x" if i == 30 else f"p{i}" for i in range(60))
    rows = [(0, PASSAGE), (1, PASSAGE), (1, PASSAGE), (2, near), (3, None), (4, ""), (5, " \n "), (6, LONG),
            (7, "one two"), (8, "ONE two"), (None, "no id"), (9, f"start here\n{PASSAGE}\nand an end of its own")]
    return spark.createDataFrame([(i, t, "en", "s" if i != 7 else None, 0, 1, 1, 1) for i, t in rows], SCHEMA)


def test_near_duplicates(docs):
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in setsketch.near_duplicates(docs, 4).collect()}
    assert {(0, 57, 0, True), (1, 57, 0, False), (2, 57, 0, False), (3, 0, 3, True), (4, 0, 4, True),
            (5, 0, 5, True), (7, 1, 7, True), (8, 1, 7, False), (None, 1, None, True)} <= got
    assert {r.doc_id for r in setsketch.keep_one(docs, 4).collect()} == {0, 3, 4, 5, 6, 7, None}
    assert setsketch.near_duplicates(docs.where("doc_id = 99")).count() == 0


def test_sketches_merge_and_estimate():
    x = ts.mix(np.arange(3000, dtype=np.uint64))
    a, b = x[:2000], x[500:2500]
    sets = [np.sort(a), np.sort(b), np.unique(np.concatenate([a, b]))]
    r = setsketch.sketch(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
    assert (setsketch.merge(r[0], r[1]) == r[2]).all()
    est = setsketch.joint_similarity(r[:1], r[1:2], np.array([2000]), np.array([2000]))
    assert abs(est[0] - 0.6) < 0.15


def test_paragraphs(docs):
    got = {(r.doc_id, r.par, r.first_doc_id) for r in paragraphs.repeats(docs).collect()}
    assert got == {(1, 0, 0), (2, 0, 0), (9, 1, 0)}
    left = {r.doc_id: r.text for r in paragraphs.without_repeats(docs).collect()}
    assert left[9] == "start here\nand an end of its own" and 1 not in left and left[0] == PASSAGE and 3 in left
    assert paragraphs.tune_bands(64, 0.8, 0.9995) == 4


def test_decontamination(spark, docs):
    items = spark.createDataFrame([(1, " ".join(f"p{i}" for i in range(20))), (2, "one two"), (3, None), (4, "...")],
                                  "item_id long, text string")
    by = {}
    for most in (decontam.BROADCAST_BYTES, 0):
        by[most] = {(r.doc_id, r._o.n_words, r._o.n_hit, tuple(r._o["items"]))
                    for r in decontam.overlap(docs, items, most=most, name="_o").collect()}
        assert {(0, 60, 20, ("1",)), (8, 2, 2, ("2",)), (3, 0, 0, ())} <= by[most]
    assert len(set(map(frozenset, by.values()))) == 1
    nothing = {(r._o.n_hit, tuple(r._o["items"])) for r in decontam.overlap(docs, items.limit(0), name="_o").collect()}
    assert nothing == {(0, ())}                             # an empty benchmark
    assert {r.doc_id for r in decontam.remove_documents(docs, items).collect()} == {3, 4, 5, 6, None}
    assert {r.doc_id: r.text for r in decontam.remove_spans(docs, items).collect()}[8] == ""
    assert decontam.items_digest(["10", "9"]) == hashlib.sha256(b"10,9").hexdigest()


def test_mixing(docs):
    rows = [(r.doc_id, r._m.asDict()) for r in mixing.mixed(docs, "_m").collect()]
    assert len(rows) == docs.count() and all(m["copies"] in (0, 1, 2) for _, m in rows)
    assert rows and sorted(rows, key=str) == sorted(
        [(r.doc_id, r._m.asDict()) for r in mixing.mixed(docs, "_m").collect()], key=str)
    assert mixing.mix(docs).columns == docs.columns
    assert mixing.mix(docs.where("doc_id = 99")).count() == 0
    for u in (0.0, 0.5, 0.999):
        fa, fb = mixing.transfer(0.3, 10, 0.6, 4, u)
        assert abs(fa * 10 + fb * 4 - 5.4) < 1e-9 and {fa, fb} & {0.0, 1.0}


def water(sizes, share=1.5, most=2):
    """Targets by a plain loop: (source, size) in order, null last."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, full = share * sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in full]
        if not rest:
            return {s: most * sizes[s] for s in order}
        level = (total - sum(most * sizes[s] for s in full)) / sum(w[s] for s in rest)
        over = {s for s in rest if level * w[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else level * w[s] for s in order}
        full |= over


def test_mixing_meets_targets(spark, monkeypatch):
    """Few documents a source, some very large; several groups; targets by a
    plain loop, taken words near them, reruns and other partitions alike."""
    ship(spark)
    rng = np.random.default_rng(6)
    rows = []
    for s, n in (("a", 60), ("b", 300), ("c", 40), (None, 25), ("z", 1)):
        for j in range(n):
            size = 6000 if j == 0 and n > 1 else int(rng.integers(1, 400))
            rows.append((len(rows), "w " * size, s, "x"))
    rows += [(None, None, "a", "x"), (5, "", "b", "x"), (7, "w w", "b", "x"), (7, "w w", "b", "x")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, _size string")
    want = water({s: sum(len((r[1] or "").split()) for r in rows if r[2] == s) for s in ("a", "b", "c", "z", None)})
    for groups in (1 << 16, 50):
        monkeypatch.setattr(mixing, "GROUP", groups)
        got = mixing.mixed(d, "_m").collect()
        again = mixing.mixed(d.repartition(5), "_m").collect()
        assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(rows)
        for s, target in want.items():
            mine = [r for r in got if r.source == s]
            assert abs(mine[0]._m.target - target) < 1e-6 * target
            taken = sum(r._m.copies * r._m.size for r in mine)
            near = sorted(r._m.size for r in mine if r._m.size)
            assert abs(taken - target) <= max(0.01 * target, near[len(near) // 2]), (s, taken, target)
            p = target / max(1, mine[0]._m.source_size)
            assert all(int(p) <= r._m.copies <= int(p) + 1 for r in mine)
    out = mixing.mix(d)
    assert out.columns == d.columns and out.count() == sum(r._m.copies for r in got)


def test_mixing_keeps_expectations(spark):
    """Over many seeds (ids) each document is taken as often as its share says."""
    ship(spark)
    sizes = [900, 300, 200, 100, 80, 50, 30, 20, 10, 5] * 2
    rows = [(1000 * seed + i, "w " * n, f"s{seed:03d}") for seed in range(120) for i, n in enumerate(sizes)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixed(d, "_m").collect()
    for i, n in enumerate(sizes):
        mine = [r._m for r in got if r.doc_id % 1000 == i]
        want = np.mean([m.target / m.source_size for m in mine])
        assert abs(np.mean([m.copies for m in mine]) - want) < 0.2, (n, want)


def test_language(spark):
    ship(spark)
    words = {"en": "the cat sat on the mat and then ", "de": "der hund liegt auf dem boden und "}
    rows = [(i, words[l] * 5, l, "s", 0, 0, 0, 0) for i, l in enumerate(["en", "de"] * 10)]
    rows += [(50, None, "en", "s", 0, 0, 0, 0), (51, "12 34 !!", "en", "s", 0, 0, 0, 0), (None, "the cat", None, "s", 0, 0, 0, 0)]
    d = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r._l for r in langid.identify(d, langid.learned_from(d), "_l").collect()}
    assert all(got[i].name == l for i, l in enumerate(["en", "de"] * 10))
    assert got[50].name == got[51].name == "und" and got[50].score == 0 and got[None].name == "en"
    assert langid.identify(d.limit(2), langid.learned_from(d.where("doc_id = 99"))).count() == 2


def test_language_letters_and_alphabets(spark):
    """Marks alone are no letters; many languages; a language of thousands of
    letters and short texts stay in the pipeline, junk goes."""
    ship(spark)
    rng = np.random.default_rng(4)
    rows = [(3 * i, " ".join("".join(chr(0x4E00 + c) for c in rng.zipf(1.5, 30) % 5000) for _ in range(4)), "zh")
            for i in range(60)]
    rows += [(3 * i + 1, "the cat sat on the mat and then it went out", "en") for i in range(60)]
    rows += [(1000, "\u0301\u0302", None), (1001, "The mat.", None), (1002, "\u4e01", None),
             (1003, "qzx vkj wqp " * 40, None), (1004, "the cat sat on the mat and then it went out " * 5_000, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r._lang for r in langid.identify(d, langid.learned_from(d)).collect()}
    assert got[1000].name == "und" and got[1004].name == "en" and got[1004].score > 0.9
    assert all(got[i].name == l for i, _, l in rows if l)
    kept = {r.doc_id for r in langid.known_language(d).collect()}
    assert kept == {i for i, _, _ in rows} - {1000, 1003}
    many = spark.createDataFrame([(f"{chr(0x4E00 + i)}{chr(0x6000 + i % 200)} " * 9, f"l{i:03d}") for i in range(600)],
                                 "text string, lang string")
    model = langid.learn(many)
    names, _, _ = langid.decide([r.text for r in many.collect()], model)
    assert len(model["names"]) == 600 and names == [r.lang for r in many.collect()]


def test_language_against_plain_counts(spark):
    """The filters' decisions are those of counts without filters."""
    ship(spark)
    from conftest import SF_SMALL
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = d.select("doc_id", "text", "lang").collect()
    learning = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    counts = {}
    for r in learning:
        if r.text is not None and r.lang is not None:
            counts.setdefault(r.lang, Counter()).update(langid.grams([r.text])[0].tolist())
    held = {l: {g for g, n in c.items() if n >= sum(c.values()) * langid.SHARE} for l, c in counts.items()}
    got = {r.doc_id: r._lang.name for r in langid.identify(d, langid.learned_from(d)).collect()}
    same = total = 0
    for r in rows:
        g, _, letters = langid.grams([r.text])
        if r.text and letters[0] and len(g) >= 20:
            share = {l: np.mean([x in h for x in g.tolist()]) for l, h in held.items()}
            best = max(share.values())
            total, same = total + 1, same + (share[got[r.doc_id]] >= best - 0.02)
        elif not r.text or not letters[0]:
            assert got[r.doc_id] == "und"
    assert same == total > 100


def test_toxicity(spark):
    ship(spark)
    rng = np.random.default_rng(0)
    text = [" ".join(rng.choice([f"word{j}" for j in range(50)], 20)) + (" badword" if i % 4 == 0 else "")
            for i in range(400)]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(text)] + [(-1, None), (-2, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)] + [(None, 1), (7, None)],
                                   "doc_id long, toxic int")
    model = toxicity.learn(toxicity.labelled_rows(d, labels))
    got = {r.doc_id: r._toxic for r in toxicity.tag(d, model).collect()}
    assert all((got[i].score >= 0.5) == (i % 4 == 0) for i in range(400)) and got[-1].score < 0.5
    assert [text[300][s.start:s.end] for s in got[300].spans] == ["badword"]
    none = toxicity.learn(toxicity.labelled_rows(d, labels.where("toxic = 9")))
    assert {r._toxic.score for r in toxicity.tag(d, none).collect()} == {0.0}


def test_toxicity_against_all_paths():
    """Marginals of chains laid end to end, by adding up all state paths."""
    rng = np.random.default_rng(2)
    chain = toxicity.Chain()
    chain.step, chain.start = rng.normal(size=(2, 2)), rng.normal(size=2)
    sizes = [1, 2, 3, 5, 1, 7]
    emission = rng.normal(size=sum(sizes)) * 2
    first = np.zeros(len(emission), bool)
    first[np.cumsum([0, *sizes[:-1]])] = True
    want = []
    for begin, n in zip(np.cumsum([0, *sizes[:-1]]), sizes):
        total, at = 0.0, np.zeros(n)
        for path in np.ndindex(*(2,) * n):
            weight = np.exp(chain.start[path[0]] + sum(emission[begin + i] * s for i, s in enumerate(path))
                            + sum(chain.step[a, b] for a, b in zip(path, path[1:])))
            total, at = total + weight, at + weight * np.array(path)
        want += (at / total).tolist()
    assert np.allclose(chain.marginals(emission, first)[0], want)


def test_chat(spark):
    ship(spark)
    rows = [(1, 0, "user", "<\\|a<|b"), (1, 1, "assistant", chat.TRICKY), (2, 0, "assistant", None),
            (2, 0, "assistant", None), (None, None, None, "x")]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(d)).collect()}
    assert got[1].valid and got[1].loss_chars == len(chat.TRICKY)
    assert got[1].turns_sha256 == hashlib.sha256(f"user\n<\\|a<|b\nassistant\n{chat.TRICKY}\n".encode()).hexdigest()
    assert not got[2].valid and got[2].n_turns == 2 and got[None].n_turns == 1
    for s in ("<|", "<\\|", "<\\\\||", "a<|im_end|>"):
        assert chat.unescape(chat.escape(s)) == s and "<|" not in chat.escape(s)
    assert chat.unescape_role(chat.escape_role("a\\n\nb<|")) == "a\\n\nb<|"


def test_tokens(spark):
    P = pytest.importorskip("public_tokenizers")
    ship(spark)
    path = P.path("byte_bpe_50k.json")
    texts = [None, "", "a<|endoftext|>b", " \n\n x  y\t'll ", "日本語 😀", LONG, "don't"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tok = tokencount._tokenizer(path)
    for r in tokencount.count_tokens(d, path).collect():
        t = texts[r.doc_id] or ""
        assert (r.n_tokens, r.n_bytes) == (len(tok.encode(t, add_special_tokens=False).ids), len(t.encode()))


def test_neighbours(spark):
    ship(spark)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 8)).astype(np.float32)
    x[500:] = x[0]                                          # a hundred equal vectors
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [
        (700, None), (701, [0.0] * 8), (702, [float("nan")] * 8), (703, [1.0] * 3), (None, [1.0] * 8)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in ann.search(d, d.where("vec_id % 100 = 0")).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    hit = 0
    for q in range(0, 600, 100):
        dist = np.sqrt(((x.astype(float) - x[q]) ** 2).sum(axis=1))
        dist[q] = np.inf
        best = np.lexsort((np.arange(600), dist))[:10]
        hit += len({v for _, v in got[q]} & set(best.tolist()))
    assert hit >= 54 and [v for _, v in sorted(got[0])] == list(range(500, 510)) and 700 not in got


def test_neighbours_of_skewed_vectors(spark, monkeypatch):
    """A third near copies of one vector, six hundred equal ones, three
    shards: each kind of query finds its nearest."""
    ship(spark)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(6000, 32))
    x[:2000] = x[0] * 0.1 + rng.normal(size=(2000, 32)) * 0.1
    x[2000:2600] = rng.normal(size=32) + 2
    monkeypatch.setattr(ann, "SHARD", 2000)
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    asked = [*range(0, 2000, 50), *range(2000, 2600, 30), *range(2600, 6000, 85)]
    got = {}
    for r in ann.search(d, d.where(f"vec_id in ({','.join(map(str, asked))})")).collect():
        got.setdefault(r.query_id, set()).add((r.vec_id, r.score))
    for lo, hi in ((0, 2000), (2000, 2600), (2600, 6000)):
        hits = []
        for q in (i for i in asked if lo <= i < hi):
            dist = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
            dist[q] = np.inf
            most = np.sort(dist)[9] * (1 + 1e-9)
            hits.append(sum(s <= most for _, s in got[q]) / 10)
        assert np.mean(hits) >= 0.95, (lo, np.mean(hits))
    graph, start = ann.build(x[:3000])
    assert ann.reached(graph, start).all()
    assert ann.search(d.limit(0), d).count() == 0 and ann.search(d, d.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 2.0]), (3, [1.0, 2.0, 3.0])],
                                  "vec_id long, embedding array<double>")
    assert {(r.query_id, r.vec_id, r.score) for r in ann.search(twice, twice).collect()} == {(1, 2, 1.0), (2, 1, 1.0)}


def test_pages(spark):
    ship(spark)
    page = ("<title>t</title><style>.x{display:none}</style>a<p>b<p>c <b class=x>no</b><ul><li>d<li>e</ul>"
            "<table><tr><td>k<td>1<tr><td>long<td>2</table><div hidden>no</div>" + "<div>" * 3000 + "deep")
    assert html_text.page_text(page) == "a\n\nb\n\nc\n\n- d\n- e\n\nk     1\nlong  2\n\ndeep"
    d = spark.createDataFrame([(1, "u", page, "c"), (2, None, None, "c"), (None, "u", "", "c"), (3, "u", "<a '", "c")],
                              "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in html_text.extract_text(d).collect()}
    assert got[2] == got[None] == "" and got[1].endswith("deep") and html_text.extract_text(d.where("page_id = 9")).count() == 0


def test_words_match_regex():
    text = ["Ab  c\nd é", "", "X"]
    buf, off = ts.text_buffer(__import__("pyarrow").array(text))
    w = ts.words(buf, off, ts.SPACED)
    assert np.diff(w.first).tolist() == [len(re.findall("[^\x20\x09-\x0D]+", t)) for t in text]
