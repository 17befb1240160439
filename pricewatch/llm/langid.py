"""Language identification by n-gram filters with a bit for each language
(operator 9).

Learning counts the character n-grams of each language over all learning
texts. A language holds an n-gram when it makes up at least a stated share of
the language's n-grams, so a language holds at most 1 / share of them whatever
the size of the corpus. The filter is a table of bit masks: an n-gram sets its
languages' bits in several slots, and the bitwise and of its slots gives all
languages that hold it, as bit-sliced Bloom filters that share their hash
functions. A text's n-grams are looked up; the hits of each language, corrected
for the share of false positives that its filter's filling predicts, decide.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewatch.llm import textscan as ts
from pricewatch.llm.settle import settle, spare, table

GRAM = 4                    # characters; a text's runs of non-letters read as one space
LARGE = 0x2E80              # from here on alphabets have thousands of letters; their n-grams have SHORT
SHORT = 2
SHARE = 2e-5                # of a language's n-grams, to be held by it
SLOTS = 1 << 20
HASHES = 3
UNKNOWN = "und"
REJECT = 0.3                # documents with a lower score, less its margin, have no known language


@functools.cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code point of each letter or mark, 32 for all else; and
    whether it is a letter."""
    out, letter = np.full(0x110000, 32, np.uint32), np.zeros(0x110000, bool)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind in "LM":
            low = chr(c).lower()
            out[c] = ord(low) if len(low) == 1 else c
            letter[c] = kind == "L"
    return out, letter


def grams(texts: list[str | None], n: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams with at least one letter, the row of each, and the
    number of letters of each row. Every row is read as if it stood between
    spaces."""
    fold, letter = _letters()
    raw = "\0".join(t or "" for t in texts)
    code = np.frombuffer(("\0" + raw + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(t or "") for t in texts])
    row = np.repeat(np.arange(len(texts)), size + 1)
    row = np.append(row, len(texts) - 1) if len(texts) else row
    code = np.where(code < 0x110000, code, 0)
    low = fold[code]
    space = low == 32
    letters = np.bincount(row[letter[code]], minlength=len(texts))
    edge = np.zeros(len(low), bool)                 # the separators between rows stay
    edge[np.concatenate([[0], np.cumsum(size + 1)])] = True
    keep = ~space | edge
    keep[1:] |= ~space[:-1]
    low, row, edge = low[keep].astype(np.uint64), row[keep], edge[keep]
    large = (low >= LARGE) & (low < 0xA0000)
    found, rows = [], []
    for size_ in (n, SHORT):
        m = len(low) - size_ + 1
        if m <= 0:
            continue
        step = ts.stream(23 + (size_ != n), size_)
        all_large = large[:m]
        with np.errstate(over="ignore"):
            h = low[:m] * step[0]
            for j in range(1, size_):
                h = h + low[j:m + j] * step[j]
                all_large = all_large & large[j:m + j]
        # not across rows: no separator inside
        inner = np.concatenate([[0], np.cumsum(edge)])
        ok = inner[size_ - 1:len(edge)][:m] - inner[1:m + 1] == 0 if size_ > 2 else np.ones(m, bool)
        ok = ok & (all_large != (size_ == n))
        last = row[size_ - 2:size_ - 2 + m]
        found.append(ts.mix(h[ok]))
        rows.append(last[ok])
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64), letters
    return np.concatenate(found), np.concatenate(rows), letters


def learn(labelled: DataFrame, share: float = SHARE, slots: int = SLOTS, hashes: int = HASHES) -> dict:
    """The filter from (text, lang) rows; null texts and languages are left
    out. Counts cover all rows; a task adds up its n-grams before they are
    shuffled. Returned: languages (sorted), masks (slots x words of 64 bits, so
    ``slots / 8`` bytes a language), the false positive share of each language,
    and the part of its n-grams that it holds (few for a language of thousands
    of letters)."""
    labelled = labelled.select("text", F.col("lang").cast("string").alias("lang")) \
        .where("text is not null and lang is not null")

    def count(batches):
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for piece in ts.slices(batches, budget=1 << 20):
            langs = np.array(piece.column("lang").to_pylist(), object)
            h, row, _ = grams(piece.column("text").to_pylist())
            names, code = np.unique(langs.astype(str), return_inverse=True)
            for i, name in enumerate(names):
                g, n = np.unique(h[code[row] == i], return_counts=True)
                if name in sums:
                    g = np.concatenate([sums[name][0], g])
                    n = np.concatenate([sums[name][1], n])
                    g, where = np.unique(g, return_inverse=True)
                    n = np.bincount(where, n).astype(np.int64)
                sums[name] = g, n
                if len(g) > 1 << 18:                    # bounded memory in a task
                    yield _counts(name, *sums.pop(name))
        for name, (g, n) in sums.items():
            yield _counts(name, g, n)

    counts = settle(labelled.mapInArrow(count, "lang string, gram long, n long")
                    .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    total = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    held = counts.join(F.broadcast(total), "lang").where(F.col("n") >= F.col("total") * share)
    own = {r.lang: (r.held or 0) / r.total for r in total.join(
        held.groupBy("lang").agg(F.sum("n").alias("held")), "lang", "left").collect()}      # a row a language
    names = sorted(own)
    # at most len(names) / share rows, so this fits the driver
    words = max(1, -(-len(names) // 64))
    masks = np.zeros((slots, words), np.uint64)
    fill = np.zeros(max(1, len(names)))
    rows = held.select("lang", "gram").toArrow() if names else None
    if rows is not None and rows.num_rows:
        lang = np.searchsorted(np.array(names), np.array(rows.column("lang").to_pylist()))
        at = _places(rows.column("gram").to_numpy().view(np.uint64), slots, hashes)
        bit = np.uint64(1) << (lang % 64).astype(np.uint64)
        for p in at:
            np.bitwise_or.at(masks, (p, lang // 64), bit)
        fill = np.array([((masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean()
                         for i in range(len(names))])
    return {"names": names, "masks": masks, "false": np.minimum(fill ** hashes, 0.99), "hashes": hashes,
            "own": np.array([own[n] for n in names])}


def _counts(name, g, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([name] * len(g), pa.string()), pa.array(ts.signed(g)),
                                       pa.array(n.astype(np.int64))], ["lang", "gram", "n"])


def _places(h: np.ndarray, slots: int, hashes: int) -> list[np.ndarray]:
    """Slots of each n-gram, by double hashing; ``slots`` is a power of two."""
    step = (h >> np.uint64(32)) | np.uint64(1)
    with np.errstate(over="ignore"):
        return [((h + np.uint64(i) * step) & np.uint64(slots - 1)).astype(np.int64) for i in range(hashes)]


def decide(texts: list[str | None], model: dict) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language and score of each text, and its n-grams. The winner has the
    greatest corrected share of hits, ties go to the language first in order;
    the score is that share in relation to what the language holds of its own
    n-grams, at most 1."""
    h, row, letters = grams(texts)
    n = np.bincount(row, minlength=len(texts)).astype(float)
    masks = model["masks"]
    both = None
    for p in _places(h, len(masks), model["hashes"]):
        both = masks[p] if both is None else both & masks[p]
    share = np.zeros((len(model["names"]), len(texts)))
    for i, f in enumerate(model["false"][:len(model["names"])]):
        hits = np.bincount(row, (both[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1), minlength=len(texts))
        share[i] = (hits - n * f) / np.maximum(n * (1 - f), 1e-9)
    share = np.clip(share, 0, 1)
    if not len(share):
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), n
    best = share.argmax(axis=0)
    score = np.minimum(1, share.max(axis=0) / np.maximum(model["own"][best], 1e-9))
    known = (letters > 0) & np.array([t is not None for t in texts], bool)
    names = [model["names"][b] if k else UNKNOWN for b, k in zip(best, known)]
    return names, np.where(known, score, 0.0), n


def identify(docs: DataFrame, model: dict, name: str = "_lang") -> DataFrame:
    """``docs`` with its columns and the struct ``name``: name, score and
    n_grams.

    Null texts and texts without a letter are ``und`` with score 0, as are all
    texts when nothing was learned. Repeated rows get equal results; other
    columns, lang, source and doc_id included, play no part.
    """
    docs = docs.drop(name)          # a column of that name is replaced
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = docs.columns.index("text")
    kind = T.StructType([T.StructField("name", T.StringType()), T.StructField("score", T.DoubleType()),
                         T.StructField("n_grams", T.LongType())])
    schema = T.StructType([*docs.schema.fields, T.StructField(name, kind)])

    def run(batches):
        for piece in ts.slices(batches, budget=1 << 20):
            names, score, n = decide(piece.column(text).to_pylist(), shared.value)
            found = pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(n.astype(np.int64))],
                names=["name", "score", "n_grams"])
            yield pa.RecordBatch.from_arrays([*piece.columns, found], [*piece.schema.names, name])

    return docs.mapInArrow(run, schema)


def held_out(doc_id, mod: int, rest: int):
    """crc32 of the doc_id as text, modulo ``mod``, is ``rest``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod == rest, F.lit(False))


def learned_from(docs: DataFrame) -> dict:
    """The filter learned from the rows of ``docs`` that may be learned from."""
    return learn(docs.where(~held_out(F.col("doc_id"), 3, 1)))


def known_language(docs: DataFrame, least: float = REJECT) -> DataFrame:
    """``docs`` without the rows that are no text of a learned language: those
    without a letter, and those whose score is below ``least`` by more than the
    margin that so few n-grams leave (one over the root of their number), so a
    short text isn't judged by a handful of them."""
    name = spare(docs, "_lang")
    found, lang = identify(docs, learned_from(docs), name), F.col(name)
    margin = 1 / F.sqrt(F.greatest(lang["n_grams"], F.lit(1)))
    return found.where((lang["name"] != UNKNOWN) & (lang["score"] + margin >= least)).select(docs.columns)


def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), learned_from(docs))
    return found.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"),
                        F.col("_lang.name").alias("lang_pred"), F.col("_lang.score").alias("score"))
