"""Repeated passages by paragraph MinHash banding (operator 6).

A text is read in three ways. Its lines are paragraphs. Its words, whatever the
lines, are cut where the hash of two words is the least of ``PIECE`` words to
either side, so a passage is cut alike wherever it stands and however it is
wrapped; pieces from one cut on that together have ``LEAST_WORDS`` words are a
unit, and units overlap. Blocks lie between the cuts that are the least of
``BLOCK_REACH`` words to either side.

Equal paragraphs and units (by the hash of their word sequence) are one class,
as are equal blocks; lines and blocks are compared among themselves only, as
every line resembles the block that it lies in. Lines of at least ``LEAST_WORDS`` words and blocks also get a MinHash
signature of their shingles, whose bands are tuned for a wanted recall at the
threshold. Colliding classes are joined, verified by exact Jaccard similarity
on the full sets and clustered by components (``neardup``).

A cluster's first document stays, the others' members are repeats. Repeated
units are removed, and repeated blocks from their first repeated unit or line
to their last. Repeated lines that also stand next to each other in an earlier
document are one passage, which is removed when it has at least ``LEAST_WORDS``
words; so a passage of several short lines goes as a whole, and short lines
that many documents happen to have stay, also where they meet.

What is shuffled of a paragraph, unit or block is the hash of its class and the
key of its document. Classes of several documents come back to these documents
as lists, and a second scan of their texts finds the places again.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewatch.llm import textscan as ts
from pricewatch.llm.neardup import near_components
from pricewatch.llm.settle import Scratch, settle, spare, table

LEAST_WORDS = 20
SHINGLE = 5
PERCENT = 80
HASHES = 64
RECALL = 0.9995             # of pairs exactly at the threshold
PIECE = 4                   # pieces have 9 words on average
BLOCK_REACH = 32            # blocks have 65
LONGEST = 32                # a longer piece, as of one repeated word, is cut every LONGEST // 2 words
APART = np.uint16(0x5A5A)   # keeps blocks' signatures out of the lines' buckets
LINE, UNIT, BLOCK = range(3)
UNNAMED, NAMED, CLASH = range(3)       # documents without doc_id; with their own; with one that others have, too
ROW = "grp int, key long"


def tune_bands(hashes: int, similarity: float, recall: float) -> int:
    """The most rows a band may have so that a pair at ``similarity`` meets in
    some band with probability ``recall``; more rows mean fewer false pairs."""
    fit = [r for r in range(1, hashes + 1)
           if hashes % r == 0 and (1 - similarity ** r) ** (hashes // r) <= 1 - recall]
    return max(fit, default=1)


ROWS = tune_bands(HASHES, PERCENT / 100, RECALL)
_FACTORS = ts.stream(31, HASHES)
_PAIR = ts.stream(37, 2)
_BLOCK = ts.stream(41, 1)[0]
_BASE = ts.stream(43, 1)[0]
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def block_class(cls: np.ndarray) -> np.ndarray:
    """The class of a block: another one than a line's of the same words."""
    return ts.mix(cls ^ _BLOCK)


def minhash(run: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """16 bits of each of ``HASHES`` minima of each span's shingles."""
    low = np.empty((len(begin), HASHES), np.uint64)
    if len(begin):
        with np.errstate(over="ignore"):
            for i, factor in enumerate(_FACTORS):
                low[:, i] = np.minimum.reduceat(run * factor, begin)
    return (ts.mix(low) >> np.uint64(48)).astype(np.uint16)


def same_share(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=1) if len(a) else np.zeros(0)


def _lines(buf: np.ndarray, off: np.ndarray):
    """Offsets of all lines (n + 1), the row of each and its number in it."""
    breaks = np.flatnonzero(buf == 10) + 1
    edge = np.union1d(breaks, off)
    # empty rows and a break at a row's end leave lines without bytes, which have no words
    row = np.searchsorted(off, edge[:-1], side="right") - 1
    nth = np.arange(len(row)) - np.searchsorted(row, row)
    return edge, row, nth


def span_classes(w: ts.Words, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of the word sequence of each span: a polynomial in an odd base,
    modulo 2 ** 64, from sums up to each word."""
    n = len(w.hash)
    power = np.full(n + 1, _BASE)
    power[0] = 1
    back = np.full(n + 1, _INVERSE)
    back[0] = 1
    with np.errstate(over="ignore"):
        power, back = np.multiply.accumulate(power), np.multiply.accumulate(back)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(ts.mix(w.hash) * power[:-1], dtype=np.uint64)])
        return ts.mix((total[b] - total[a]) * back[a] + (b - a).astype(np.uint64) * _PAIR[0])


def shingles(w: ts.Words, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shingles of each span, one after another, the first of each, and how
    many different ones a span has. Spans have ``SHINGLE`` words at least."""
    size = b - a - SHINGLE + 1
    begin = np.cumsum(size) - size
    at = np.arange(int(size.sum())) - np.repeat(begin, size) + np.repeat(a, size)
    step, m = ts.stream(11, SHINGLE), len(w.hash) - SHINGLE + 1
    if not len(size) or m <= 0:
        return np.empty(0, np.uint64), begin, np.zeros(len(size), np.int64)
    with np.errstate(over="ignore"):
        run = w.hash[:m] * step[0]
        for j in range(1, SHINGLE):
            run = run + w.hash[j:m + j] * step[j]
    run = ts.mix(run)[at]
    # One sort tells them all apart: a span's number, then 40 bits of the hash.
    row = np.repeat(np.arange(len(size), dtype=np.uint64) << np.uint64(40), size)
    key = np.sort(row | (run >> np.uint64(24)))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    return run, begin, np.bincount((key[new] >> np.uint64(40)).astype(np.int64), minlength=len(size))


def cuts(w: ts.Words, reach: int) -> np.ndarray:
    """The words at which a piece begins: each row's first word and those where
    the hash of two words is the least of ``reach`` words to either side."""
    n = len(w.hash)
    with np.errstate(over="ignore"):
        after = np.append(w.hash[1:], w.hash[:1])
        after[w.first[1:][np.diff(w.first) > 0] - 1] = 0    # a row's last word has none after it
        rank = ts.mix(w.hash * _PAIR[0] + after * _PAIR[1])
    # Rows lie ``reach`` places apart, so no window sees two; minima of windows by doubling.
    at = np.arange(n) + (w.doc + 1) * reach
    low = np.full(n + (len(w.first) + 1) * reach, np.iinfo(np.uint64).max, np.uint64)
    low[at] = rank
    wide = 1
    while wide < reach:
        more = min(wide, reach - wide)
        low = np.minimum(low[:len(low) - more], low[more:])
        wide += more
    least = (rank < low[at - reach]) & (rank <= low[np.minimum(at + 1, len(low) - 1)])     # of equal words the first
    least[w.first[:-1][np.diff(w.first) > 0]] = True
    return np.flatnonzero(least)


def units(w: ts.Words) -> tuple[np.ndarray, np.ndarray]:
    """First and last word (exclusive) of every unit."""
    at = np.append(cuts(w, PIECE), len(w.hash))
    gap = np.diff(at)
    more = np.where(gap > LONGEST, (gap - 1) // (LONGEST // 2), 0)
    nth = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
    at = np.union1d(at, np.repeat(at[:-1], more) + nth * (LONGEST // 2))
    last = w.first[1:][w.doc[at[:-1]]] if len(w.hash) else at[:0]
    a = at[:-1]
    b = at[np.minimum(np.searchsorted(at, a + LEAST_WORDS), len(at) - 1)]
    fits = (b <= last) & (b - a >= LEAST_WORDS)
    return a[fits], b[fits]


def blocks(w: ts.Words) -> tuple[np.ndarray, np.ndarray]:
    """First and last word (exclusive) of every block of ``LEAST_WORDS`` words."""
    at = np.append(cuts(w, BLOCK_REACH), len(w.hash))
    a, b = at[:-1], at[1:]
    return a[b - a >= LEAST_WORDS], b[b - a >= LEAST_WORDS]


def _ends(w: ts.Words, off: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Where the next word of the row begins, or the row's end."""
    after = np.append(w.start, off[-1])[b]
    return np.minimum(after, off[1:][w.doc[b - 1]]) if len(b) else b


class Parts:
    """The lines with words, units and blocks of a column of texts."""

    def __init__(self, col: pa.Array, kinds=(LINE, UNIT, BLOCK)):
        buf, off = ts.text_buffer(col)
        self.off, (edge, row, par) = off, _lines(buf, off)
        w = self.words = ts.words(buf, off, ts.SPACED)
        first = np.searchsorted(w.start, edge)
        some = np.flatnonzero(np.diff(first))
        places = {LINE: lambda: (first[some], first[some + 1]), UNIT: lambda: units(w), BLOCK: lambda: blocks(w)}
        both = {k: places[k]() for k in kinds}
        a, b = {k: x[0] for k, x in both.items()}, {k: x[1] for k, x in both.items()}
        self.a, self.b = a, b                       # first word, and the one after the last
        self.doc = {k: w.doc[a[k]] for k in a}
        self.cls = {k: span_classes(w, a[k], b[k]) for k in a}
        self.cls[BLOCK] = block_class(self.cls[BLOCK])
        line = {k: some if k == LINE else np.searchsorted(edge, w.start[a[k]], side="right") - 1 for k in a}
        self.par = {k: par[line[k]] for k in a}     # the number of the line where it begins
        self.start = {k: edge[some] if k == LINE else w.start[a[k]] for k in a}
        self.end = {k: edge[some + 1] if k == LINE else _ends(w, off, b[k]) for k in a}

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Lines that another one of the row follows, one of them short, and
        the class of both together."""
        doc, size, cls = self.doc[LINE], self.b[LINE] - self.a[LINE], self.cls[LINE]
        at = np.flatnonzero((doc[1:] == doc[:-1]) & (np.minimum(size[1:], size[:-1]) < LEAST_WORDS))
        with np.errstate(over="ignore"):
            return at, ts.mix(cls[at] * _PAIR[0] + ts.mix(cls[at + 1]) * _PAIR[1])


def identified(docs: DataFrame, grp: str = "grp", key: str = "key") -> DataFrame:
    """``docs`` with the columns ``grp`` and ``key``, which tell documents
    apart and order them. Those without doc_id come first, by a hash of their texts, then the others
    by doc_id; where texts share one, the further ones come last, by a hash."""
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    h, own = F.xxhash64(text), F.col("doc_id").isNotNull()
    shared = docs.where(own).groupBy(doc_id.alias("_id")).agg(F.min(h).alias("_lo"), F.max(h).alias("_hi")) \
        .where("_lo < _hi").select(F.col("_id").alias(f"{key}_id"), F.col("_lo").alias(f"{key}_lo"))
    rows, later = docs, F.lit(False)
    if not shared.isEmpty():
        rows = docs.join(shared, doc_id == F.col(f"{key}_id"), "left")
        later = F.coalesce(h != F.col(f"{key}_lo"), F.lit(False))
    return rows.select(*docs.columns, F.when(~own, UNNAMED).when(later, CLASH).otherwise(NAMED).alias(grp),
                       F.when(~own, h).when(later, F.xxhash64(doc_id, text)).otherwise(doc_id).alias(key))


def class_members(rows: DataFrame) -> DataFrame:
    """(grp, key, cls): the classes of each document's lines, pairs of lines,
    units and blocks, each once."""
    def run(batches):
        for piece in ts.slices(batches, budget=1 << 20):
            parts = Parts(piece.column("text"))
            at, pair = parts.pairs()
            doc = np.concatenate([*parts.doc.values(), parts.doc[LINE][at]])
            cls = np.concatenate([*parts.cls.values(), pair])
            order = np.lexsort((cls, doc))
            doc, cls = doc[order], cls[order]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (cls[1:] != cls[:-1])
            doc = pa.array(doc[new])
            yield pa.RecordBatch.from_arrays(
                [piece.column("grp").take(doc), piece.column("key").take(doc), pa.array(ts.signed(cls[new]))],
                ["grp", "key", "cls"])
    return rows.select("grp", "key", "text").mapInArrow(run, f"{ROW}, cls long")


def signed_classes(rows: DataFrame) -> DataFrame:
    """(id, n, sig, grp, key) of the blocks and the lines of at least
    ``LEAST_WORDS`` words."""
    def run(batches):
        for piece in ts.slices(batches, budget=1 << 20):
            buf, off = ts.text_buffer(piece.column("text"))
            w = ts.words(buf, off, ts.SPACED)
            first = np.searchsorted(w.start, _lines(buf, off)[0])
            long_ = np.flatnonzero(np.diff(first) >= LEAST_WORDS)
            a, b = blocks(w)
            block = np.repeat([False, True], [len(long_), len(a)])
            a, b = np.append(first[long_], a), np.append(first[long_ + 1], b)
            run_, begin, size = shingles(w, a, b)
            sig, doc, ids = minhash(run_, begin), pa.array(w.doc[a]), span_classes(w, a, b)
            ids[block] = block_class(ids[block])
            sig[block] ^= APART
            yield pa.RecordBatch.from_arrays(
                [pa.array(ts.signed(ids)), pa.array(size), _binary(sig), piece.column("grp").take(doc),
                 piece.column("key").take(doc)], ["id", "n", "sig", "grp", "key"])
    return rows.select("grp", "key", "text").mapInArrow(run, f"id long, n long, sig binary, {ROW}")


_GROUPS = (UNNAMED, NAMED, CLASH)


def _range(low: str = "key", high: str = "key"):
    """Aggregates: the least and the greatest key of each group."""
    if low == "key":
        cases = [(g, F.when(F.col("grp") == g, F.col("key"))) for g in _GROUPS]
        return [f(c).alias(f"{n}{g}") for g, c in cases for n, f in (("lo", F.min), ("hi", F.max))]
    return [f(f"{n}{g}").alias(f"{n}{g}") for g in _GROUPS for n, f in (("lo", F.min), ("hi", F.max))]


def _several():
    """Whether the keys are of more than one document."""
    apart = F.greatest(*[F.coalesce(F.col(f"lo{g}") < F.col(f"hi{g}"), F.lit(False)) for g in _GROUPS])
    kinds = sum((F.col(f"lo{g}").isNotNull().cast("int") for g in _GROUPS[1:]), F.col("lo0").isNotNull().cast("int"))
    return apart | (kinds > 1)


def _first(name: str):
    """The first document's group and key."""
    grp = F.when(F.col("lo0").isNotNull(), UNNAMED).when(F.col("lo1").isNotNull(), NAMED).otherwise(CLASH)
    return grp.alias(f"{name}_grp"), F.coalesce("lo0", "lo1", "lo2").alias(f"{name}_key")


def marks(rows: DataFrame) -> DataFrame:
    """(grp, key, marks) of the documents that have repeats, of (grp, key,
    text): for each class of theirs that begins in another document cls,
    component, near (the cluster begins there), equal (the very words stand
    there), and the doc_ids of the two."""
    scratch = Scratch(rows.sparkSession, "signatures")
    signed = scratch.settle(signed_classes(rows), "minhashes")
    places = Scratch(rows.sparkSession, "places")

    def content(ids):
        first = signed.join(ids, "id").groupBy("id").agg(*_range())
        wanted = places.settle(first.select("id", *_first("at")).groupBy(
            F.col("at_grp").alias("grp"), F.col("at_key").alias("key")).agg(F.collect_list("id").alias("ids")), "wanted")
        scratch.release()           # the bands are dealt; the few signatures still wanted come with the texts
        return rows.join(wanted, ["grp", "key"]).select("text", "ids") \
            .mapInArrow(_texts, "id long, n long, sig binary, text string").dropDuplicates(["id"])

    comp = near_components(signed.select("id", "n", "sig"), content, HASHES // ROWS, 2 * ROWS,
                           SHINGLE, ts.SPACED, same_share, PERCENT / 100 - 0.3, PERCENT, turns=8)
    places.release()
    scratch = Scratch(rows.sparkSession, "clusters")
    members = scratch.settle(class_members(rows), "members")
    # nearly all classes have one document and no link, and go here
    named = scratch.settle(
        members.groupBy("cls").agg(*_range()).join(comp.withColumnRenamed("id", "cls"), "cls", "left")
        .withColumn("several", _several()).where(F.col("component").isNotNull() | F.col("several"))
        .withColumn("component", F.coalesce("component", "cls")), "classes")
    first = named.groupBy("component").agg(*_range("lo", "hi")).where(_several()).select("component", *_first("near"))
    known = named.join(first, "component").select("cls", "component", "several", "near_grp", "near_key", *_first("equal"))
    here = members.join(known, "cls")

    def other(name):
        return (F.col("grp") != F.col(f"{name}_grp")) | (F.col("key") != F.col(f"{name}_key"))

    def keeper(name):
        return F.when(F.col(f"{name}_grp") == NAMED, F.col(f"{name}_key"))
    mark = F.struct("cls", "component", other("near").alias("near"), (F.col("several") & other("equal")).alias("equal"),
                    keeper("near").alias("near_doc"), keeper("equal").alias("equal_doc"))
    lists = settle(here.select("grp", "key", mark.alias("m")).where("m.near or m.equal")
                   .groupBy("grp", "key").agg(F.collect_list("m").alias("marks")), "marks")
    scratch.release()
    return lists


class Found(NamedTuple):
    """Removed places of a column of texts, by row and start."""
    doc: np.ndarray
    par: np.ndarray
    start: np.ndarray
    end: np.ndarray
    n_words: np.ndarray
    mark: np.ndarray        # which of the marks, all rows' one after another
    kind: np.ndarray


def _keyed(doc: np.ndarray, cls: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ts.mix(cls + ts.mix(doc.astype(np.uint64) + np.uint64(1)))


def find(col: pa.Array, lists: pa.ListArray) -> Found:
    """The places of the marks in their texts that are removed."""
    parts = Parts(col)
    size = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten()
    value = {n: flat.field(n).to_numpy(zero_copy_only=False) for n in ("cls", "near", "equal")}
    known = _keyed(np.repeat(np.arange(len(size)), size), value["cls"].astype(np.int64).view(np.uint64))
    order = np.argsort(known)
    known = known[order]

    def marked(doc, cls, flag):
        if not len(known) or not len(doc):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        k = _keyed(doc, cls)
        at = np.minimum(np.searchsorted(known, k), len(known) - 1)
        good = (known[at] == k) & value[flag].astype(bool)[order[at]]
        return np.flatnonzero(good), order[at[good]]

    i = {}
    mark = {}
    for kind, flag in ((LINE, "near"), (UNIT, "equal"), (BLOCK, "near")):
        i[kind], mark[kind] = marked(parts.doc[kind], parts.cls[kind], flag)
    words_ = {k: (parts.b[k] - parts.a[k])[i[k]] for k in i}
    # Marked lines, one after another and a pair that an earlier document has, are a run.
    at, pair = parts.pairs()
    beside = np.zeros(len(parts.doc[LINE]), bool)
    beside[at[marked(parts.doc[LINE][at], pair, "equal")[0]]] = True
    lines = i[LINE]
    goes_on = np.zeros(len(lines), bool)
    goes_on[1:] = (np.diff(lines) == 1) & beside[lines[:-1]]
    run = np.cumsum(~goes_on) - 1
    keep = np.bincount(run, words_[LINE])[run] >= LEAST_WORDS if len(run) else goes_on
    alone = words_[LINE] >= LEAST_WORDS
    out = [_rows(parts, k, i[k][x], mark[k][x]) for k, x in ((LINE, keep | alone), (UNIT, slice(None)))]
    inner = [_rows(parts, k, i[k][x], mark[k][x]) for k, x in ((LINE, alone), (UNIT, slice(None)))]
    near = _trimmed(_rows(parts, BLOCK, i[BLOCK], mark[BLOCK]), Found(*map(np.concatenate, zip(*inner))), parts)
    out = Found(*map(np.concatenate, zip(*out, near)))
    order = np.lexsort((out.kind, out.end, out.start, out.doc))
    return Found(*(x[order] for x in out))


def _rows(parts: Parts, kind: int, i: np.ndarray, mark: np.ndarray) -> Found:
    doc = parts.doc[kind][i]
    return Found(doc, parts.par[kind][i], parts.start[kind][i], parts.end[kind][i],
                 (parts.b[kind] - parts.a[kind])[i], mark, np.full(len(i), kind))


def _trimmed(near: Found, inner: Found, parts: Parts) -> Found:
    """The repeated blocks, from where the first of ``inner`` in one begins to
    where the last ends: a block of a near copy may begin and end with words of
    its own. Blocks without any stay as they are. Positions are of the buffer,
    so a row's places lie together."""
    if not len(near.doc) or not len(inner.doc):
        return near
    starts, ends = np.argsort(inner.start), np.sort(inner.end)
    lo_at = np.searchsorted(inner.start[starts], near.start)
    hi_at = np.searchsorted(ends, near.end, side="right") - 1
    lo = np.append(inner.start[starts], np.iinfo(np.int64).max)[lo_at]
    hi = np.where(hi_at >= 0, ends[hi_at], -1)
    has_lo, has_hi = lo < near.end, hi > near.start
    whole = has_lo & has_hi & (lo >= hi)
    from_lo, to_hi = has_lo & ~whole, has_hi & ~whole
    start, end = np.where(from_lo, lo, near.start), np.where(to_hi, hi, near.end)
    par = np.where(from_lo, inner.par[starts][np.minimum(lo_at, len(starts) - 1)], near.par)
    n_words = np.searchsorted(parts.words.start, end) - np.searchsorted(parts.words.start, start)
    return Found(near.doc, par, start, end, n_words, near.mark, near.kind)


def repeats(docs: DataFrame) -> DataFrame:
    """The removed paragraphs, units and blocks, which may overlap: doc_id, par
    (the number of the line where it begins), start, end (bytes), n_words,
    component (of the cluster), first_doc_id (the document that keeps it).

    Null and empty texts have no paragraphs. Rows of one doc_id and text are
    one document and don't repeat each other (their places come once); rows of
    one doc_id and several texts are documents of their own, judged by their
    own words, as are rows without doc_id. Those without come first, then the
    others by doc_id, and last what has another text than its doc_id's first;
    first_doc_id is null for a keeper of either of these kinds. Repeats inside
    the first document stay. Other columns are ignored; an empty table gives no
    rows.
    """
    def run(batches):
        for piece in ts.slices(batches, budget=1 << 20):
            lists = piece.column("marks")
            f = find(piece.column("text"), lists)
            off, flat = ts.text_buffer(piece.column("text"))[1], lists.flatten()
            unit = f.kind == UNIT
            mark = flat.take(pa.array(f.mark))
            keeper = pc.if_else(pa.array(unit), mark.field("equal_doc"), mark.field("near_doc"))
            component = pc.if_else(pa.array(unit), mark.field("cls"), mark.field("component"))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id").take(pa.array(f.doc)), pa.array(f.par), pa.array(f.start - off[f.doc]),
                 pa.array(f.end - off[f.doc]), pa.array(f.n_words), component, keeper],
                ["doc_id", "par", "start", "end", "n_words", "component", "first_doc_id"])
    rows = identified(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                  F.col("text").cast("string").alias("text")))
    once = rows.join(marks(rows), ["grp", "key"]).select("doc_id", "text", "marks")
    return once.mapInArrow(run, "doc_id long, par long, start long, end long, n_words long, component long, "
                                "first_doc_id long").distinct()


def _texts(batches):
    """The wanted classes' size, signature and text, if they are in this text."""
    for batch in batches:
        for piece in ts.slices([batch], budget=1 << 20):
            lists = piece.column("ids")
            parts = Parts(piece.column("text"), (LINE, BLOCK))
            buf = ts.text_buffer(piece.column("text"))[0]
            size = np.diff(lists.offsets.to_numpy())
            known = np.sort(_keyed(np.repeat(np.arange(len(size)), size),
                                   lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)))
            a, b, ids, block, word = [], [], [], [], []
            for kind in (LINE, BLOCK):
                k = _keyed(parts.doc[kind], parts.cls[kind])
                at = np.minimum(np.searchsorted(known, k), len(known) - 1)
                good = np.flatnonzero((known[at] == k) & (parts.b[kind] - parts.a[kind] >= LEAST_WORDS))
                a.append(parts.start[kind][good])
                b.append(parts.end[kind][good])
                ids.append(parts.cls[kind][good])
                block.append(np.full(len(good), kind == BLOCK))
                word.append((parts.a[kind][good], parts.b[kind][good]))
            ids, once = np.unique(np.concatenate(ids), return_index=True)
            a, b, block = (np.concatenate(x)[once] for x in (a, b, block))
            raw = buf.tobytes()
            col = pa.array([raw[x:y].decode("utf-8", "replace") for x, y in zip(a, b)], pa.string())
            run, begin, size = shingles(parts.words, *(np.concatenate(x)[once] for x in zip(*word)))
            sig = minhash(run, begin)
            sig[block] ^= APART
            yield pa.RecordBatch.from_arrays([pa.array(ts.signed(ids)), pa.array(size), _binary(sig), col],
                                             ["id", "n", "sig", "text"])


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row's bytes as a binary value."""
    wide = rows.shape[1] * rows.itemsize
    off = pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int32) * wide)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, off, pa.py_buffer(np.ascontiguousarray(rows))])


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` without the repeated passages; rows that had words and lose
    them all go. Texts that lose nothing are left as they are."""
    grp, key, marks_ = spare(docs, "_grp"), spare(docs, "_key"), spare(docs, "_marks")
    rows = identified(docs, grp, key)
    lists = marks(rows.select(F.col(grp).alias("grp"), F.col(key).alias("key"), F.col("text").cast("string").alias("text")))
    lists = lists.select(F.col("grp").alias(grp), F.col("key").alias(key), F.col("marks").alias(marks_))
    both = rows.join(lists, [grp, key], "left").select(*docs.columns, marks_)
    text = docs.columns.index("text")

    def run(batches):
        for piece in ts.slices(batches, budget=1 << 20):
            cols = list(piece.columns[:-1])
            had = np.flatnonzero(piece.column(piece.num_columns - 1).is_valid().to_numpy(zero_copy_only=False))
            keep = np.ones(piece.num_rows, bool)
            if len(had):
                some = cols[text].take(pa.array(had))
                f = find(some, piece.column(piece.num_columns - 1).take(pa.array(had)))
                off = ts.text_buffer(some)[1]
                edge = np.searchsorted(f.doc, np.arange(len(had) + 1))
                texts = cols[text].to_pylist()
                for i, row in enumerate(had.tolist()):
                    places = slice(edge[i], edge[i + 1])
                    if edge[i] < edge[i + 1]:
                        texts[row] = _cut(texts[row], list(zip((f.start[places] - off[i]).tolist(),
                                                               (f.end[places] - off[i]).tolist())))
                        keep[row] = bool(texts[row].strip())
                cols[text] = pa.array(texts, cols[text].type)
            yield pa.RecordBatch.from_arrays(cols, list(piece.schema.names[:-1])).filter(pa.array(keep))

    return both.mapInArrow(run, docs.schema)


def _cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the byte spans, sorted by start; a break is left where lines meet."""
    raw, parts, at = text.encode(), [], 0
    merged: list[list[int]] = []
    for start, end in spans:
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    for start, end in merged:
        parts.append(raw[at:start])
        at = min(end, len(raw))
        if b"\n" in raw[start:at] and start and raw[start - 1:start] != b"\n":
            parts.append(b"\n")
    left = b"".join([*parts, raw[at:]])
    return left.decode("utf-8", "replace").rstrip("\n") if at >= len(raw) else left.decode("utf-8", "replace")


def op6(spark, sf_dir):
    return repeats(table(spark, sf_dir, "documents"))
