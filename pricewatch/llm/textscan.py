"""Words, shingles and hashes of Arrow string columns, vectorised on bytes.

The helpers look at the UTF-8 bytes of a whole column at once: a 256-entry
table says which bytes belong to words, so no Python string is made per word.
A hash is 64 bits wide; where two different inputs must not be confused the
callers compare the words themselves (decontamination) or accept a collision
chance below 1e-10 per comparison of two sets (near-duplicates).
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 4 << 20           # text handled at once inside a task


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64) over an array."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random odd 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed)) | U64(1)


class WordRule(NamedTuple):
    """Which bytes form words, and the byte each one is read as."""
    inside: np.ndarray
    fold: np.ndarray


def word_rule(pattern: str) -> WordRule:
    """The rule of a character class over ASCII such as ``[^\\x20]``; bytes
    from 0x80 up are word bytes when the class takes characters beyond ASCII.
    A-Z is read as a-z, and the class is applied after that."""
    rx = re.compile(pattern[:-1] if pattern.endswith("+") else pattern)
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    inside = np.array([bool(rx.fullmatch(chr(fold[b]))) for b in range(128)]
                      + [bool(rx.fullmatch("é"))] * 128)
    return WordRule(inside, fold)


SPACED = word_rule("[^\\x20\\x09-\\x0D]")
PLAIN = word_rule("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]")


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and the n + 1 offsets of its texts; null reads as
    empty."""
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks != 1 else col.chunk(0)
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    if len(col) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1]
    off = off.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(batches, column: str = "text", budget: int = SLICE_BYTES):
    """Cut record batches so that each piece holds at most ``budget`` bytes of
    ``column``, or a single row that is longer."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, off = text_buffer(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            stop = int(np.searchsorted(off, off[at] + budget, side="right")) - 1
            stop = min(max(stop, at + 1), batch.num_rows)
            yield batch.slice(at, stop - at)
            at = stop


class Words(NamedTuple):
    start: np.ndarray       # byte position in the buffer
    end: np.ndarray
    doc: np.ndarray         # row number
    hash: np.ndarray        # 64-bit hash of the folded bytes
    first: np.ndarray       # n + 1: index of each row's first word


_PLACE = stream(7, 256)


def _places(n: int) -> np.ndarray:
    global _PLACE
    if n > len(_PLACE):
        _PLACE = stream(7, max(n, 2 * len(_PLACE)))
    return _PLACE


def words(buf: np.ndarray, off: np.ndarray, rule: WordRule) -> Words:
    """All words of all rows, in order."""
    rows = len(off) - 1
    if not len(buf):
        none = np.empty(0, np.int64)
        return Words(none, none, none, np.empty(0, U64), np.zeros(rows + 1, np.int64))
    inside = rule.inside[rule.fold[buf]]
    cut = np.zeros(len(buf) + 1, bool)
    cut[off] = True
    before = np.empty(len(buf), bool)
    before[0], before[1:] = False, inside[:-1]
    start = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.empty(len(buf), bool)
    after[-1], after[:-1] = False, inside[1:]
    end = np.flatnonzero(inside & (~after | cut[1:])) + 1
    first = np.searchsorted(start, off)
    doc = np.repeat(np.arange(rows), np.diff(first))
    return Words(start, end, doc, span_hash(rule.fold[buf], start, end), first)


def span_hash(folded: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span."""
    if not len(start):
        return np.empty(0, U64)
    size = end - start
    begin = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(begin, size)
    at = place + np.repeat(start, size)
    with np.errstate(over="ignore"):
        term = (folded[at].astype(U64) + U64(1)) * _places(int(size.max()))[place]
        return mix(np.add.reduceat(term, begin) + size.astype(U64) * U64(0xD6E8FEB86659FD93))


_STEP = stream(11, 64)


def windows(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``k`` words inside a row, with the index of its
    first word."""
    n = len(w.hash) - k + 1
    if n <= 0:
        return np.empty(0, U64), np.empty(0, np.int64)
    step = _STEP if k <= len(_STEP) else stream(11, k)
    with np.errstate(over="ignore"):
        total = w.hash[:n] * step[0]
        for j in range(1, k):
            total = total + w.hash[j:j + n] * step[j]
        total = mix(total + U64(k) * U64(0xA24BAED4963EE407))
    at = np.flatnonzero(w.doc[:n] == w.doc[k - 1:])
    return total[at], at


def shingle_sets(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``k``-word shingles of each row, sorted, concatenated, and
    the n + 1 offsets. A row of fewer words has its whole sequence as its one
    shingle, a row without words none."""
    h, at = windows(w, k)
    rows = len(w.first) - 1
    count = np.diff(w.first)
    doc = w.doc[at]
    for short in range(1, k):
        few = np.flatnonzero(count == short)
        if len(few):
            only = Words(w.start, w.end, w.doc, w.hash, w.first)
            hs, places = windows(only, short)
            keep = np.isin(places, w.first[few])
            h, doc = np.concatenate([h, hs[keep]]), np.concatenate([doc, w.doc[places[keep]]])
    order = np.argsort(doc, kind="stable")
    h, doc = h[order], doc[order]
    edge = np.searchsorted(doc, np.arange(rows + 1))
    parts = [np.unique(h[a:b]) for a, b in zip(edge[:-1], edge[1:])]
    size = np.array([len(p) for p in parts], np.int64)
    return (np.concatenate(parts) if parts else np.empty(0, U64),
            np.concatenate([[0], np.cumsum(size)]).astype(np.int64))


def set_hash(sets: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each set (sums of mixed members)."""
    rows = len(off) - 1
    a, b = np.zeros(rows, U64), np.zeros(rows, U64)
    full = np.flatnonzero(np.diff(off))
    if len(full):
        with np.errstate(over="ignore"):
            a[full] = np.add.reduceat(mix(sets ^ U64(0x5851F42D4C957F2D)), off[:-1][full])
            b[full] = np.add.reduceat(mix(sets ^ U64(0x14057B7EF767814F)), off[:-1][full])
    return a, b


def signed(x: np.ndarray) -> np.ndarray:
    """uint64 as the long of the same bits."""
    return x.view(np.int64)
