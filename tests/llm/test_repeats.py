"""Repeated passages against brute force on windows of words."""

import re

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("pricewatch.llm")

from pricewatch.llm import paragraphs  # noqa: E402
from pricewatch.llm import textscan as ts  # noqa: E402
from pricewatch.llm.ship import ship  # noqa: E402

WINDOW = 50


def own_words(rng, n):
    return [f"v{i}" for i in rng.integers(0, 5000, n)]


def wrapped(rng, words, width):
    """The words with a line break after every ``width`` of them."""
    return "\n".join(" ".join(words[i:i + width]) for i in range(0, len(words), width))


def planted():
    """Texts that share passages of 50 to 120 words, never at a line's edge on both sides."""
    rng = np.random.default_rng(6)
    passages = [own_words(rng, n) for n in (50, 60, 80, 120)]
    texts = []
    for i in range(60):
        words = own_words(rng, 70) + (passages[i % 4] if i % 3 else []) + own_words(rng, 70)
        texts.append(wrapped(rng, words, (1000, 17, 9, 40)[i % 7 % 4]))
    return texts


def spots(text):
    return [(m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]


def seen_before(texts):
    """Of each text, the numbers of the words in windows that an earlier text has."""
    seen, out = set(), []
    for text in texts:
        words = text.lower().split()
        windows = [tuple(words[i:i + WINDOW]) for i in range(len(words) - WINDOW + 1)]
        out.append({j for i, x in enumerate(windows) if x in seen for j in range(i, i + WINDOW)})
        seen.update(windows)
    return out


def test_passages_inside_lines_and_over_breaks(spark):
    ship(spark)
    texts = planted()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {}
    for r in paragraphs.repeats(docs).collect():
        spans.setdefault(r.doc_id, []).append((r.start, r.end))
        assert len(texts[r.doc_id][r.start:r.end].split()) == r.n_words
    brute = seen_before(texts)
    assert sum(map(bool, brute)) == 36
    wanted = hit = 0
    for i, text in enumerate(texts):
        gone = {j for j, (a, b) in enumerate(spots(text)) if any(s <= a and b <= e for s, e in spans.get(i, []))}
        assert gone <= brute[i]                                 # nothing but the passage
        assert not brute[i] or len(gone & brute[i]) >= paragraphs.LEAST_WORDS
        wanted, hit = wanted + len(brute[i]), hit + len(gone & brute[i])
    assert hit >= 0.75 * wanted


def test_cut_keeps_breaks_and_joins_overlaps():
    assert paragraphs._cut("a b c d\ne f", [(2, 6), (4, 8)]) == "a \ne f"
    assert paragraphs._cut("a b\nc d\ne", [(4, 8)]) == "a b\ne"


def test_units_of_any_text():
    texts = ["a " * 100, "", None, "x y", " ".join(f"w{i}" for i in range(300)), "\n\nq " * 20]
    buf, off = ts.text_buffer(pa.array(texts, pa.string()))
    w = ts.words(buf, off, ts.SPACED)
    for a, b in (paragraphs.units(w), paragraphs.blocks(w)):
        assert set(w.doc[a]) == {0, 4, 5} and (w.doc[a] == w.doc[b - 1]).all()
        assert (b - a >= paragraphs.LEAST_WORDS).all()


def test_near_copies_of_rows_without_doc_id(spark):
    ship(spark)
    rng = np.random.default_rng(7)
    a, b = own_words(rng, 60), own_words(rng, 60)
    rows = [(None, a), (5, a), (7, a[:30] + ["x"] + a[31:]), (None, b), (8, b[:30] + ["x"] + b[31:])]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")
    whole = {(r.doc_id, r.first_doc_id) for r in paragraphs.repeats(docs).collect() if r.start == 0 and r.n_words == 60}
    assert whole == {(5, None), (7, None), (8, None)}


def test_rows_of_one_doc_id(spark):
    """A repeat of a row isn't cut out of another row of its doc_id."""
    ship(spark)
    rng = np.random.default_rng(8)
    a, b, c, d = (own_words(rng, 80) for _ in range(4))
    docs = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(a)), (2, " ".join(b)), (2, " ".join(b)),
                                  (None, " ".join(c)), (None, " ".join(c[:40] + d[:40]))],
                                 "doc_id long, text string")
    left = sorted(((r.doc_id or 0, len(r.text.split())) for r in paragraphs.without_repeats(docs).collect()))
    assert [x for x in left if x[0]] == [(1, 80), (2, 80), (2, 80)]
    unnamed = [n for i, n in left if not i]                 # documents of their own
    assert len(unnamed) == 2 and 40 <= unnamed[0] <= 60 and unnamed[1] == 80


def test_short_lines_that_never_met(spark):
    """Common short lines stay where they meet; a passage of short lines that
    stood together before goes."""
    ship(spark)
    rng = np.random.default_rng(9)
    x, y, z, p, q, r = (" ".join(own_words(rng, 9)) for _ in range(6))
    own = [" ".join(own_words(rng, 30)) for _ in range(8)]
    texts = [f"{own[0]}\n{x}\n{own[1]}", f"{own[2]}\n{y}", f"{z}\n{own[3]}", f"{own[4]}\n{x}\n{y}\n{z}",
             f"{own[5]}\n{p}\n{q}\n{r}", f"{own[6]}\n{p}\n{q}\n{r}\n{own[7]}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = {d.doc_id: d.text for d in paragraphs.without_repeats(docs).collect()}
    assert [left[i] for i in range(5)] == texts[:5] and left[5] == f"{own[6]}\n{own[7]}"
