"""Token counts with a whole-token shortcut (operator 5).

A byte-level BPE tokenizer cuts a text into pre-tokens and merges each one by
itself. Most pre-tokens are vocabulary strings. ``proven_whole`` runs the
merges over every vocabulary string once, on the driver, and keeps those that
come out as one token: a pre-token equal to such a string counts 1 without any
merging. The other pre-tokens are merged by the tokenizer's own model, once
for each different one in a worker's bounded memory of results. Special
strings inside a text are cut out first and count 1, as the library does by
default.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewatch.llm import textscan as ts
from pricewatch.llm.settle import table

# Fixed value: the published pre-token pattern of byte-level BPE.
PRETOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PIECE = 1 << 20             # characters cut into pre-tokens at once
REMEMBERED = 1 << 18        # merged pre-tokens a worker remembers


@functools.cache
def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the vocabulary:
    printable Latin-1 stands for itself, the others follow from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = iter(range(256, 512))
    return {b: chr(b) if b in own else chr(next(rest)) for b in range(256)}


def spell(text: str) -> str:
    """A text in the vocabulary's letters."""
    return text.encode("utf-8", "surrogatepass").translate(bytes(range(256))).decode("latin-1").translate(byte_letters())


@functools.cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def proven_whole(path: str) -> list[str]:
    """The texts whose pre-token the model turns into exactly one token: every
    vocabulary string that is valid UTF-8, is one pre-token, and merges to
    itself. Bounded by the vocabulary."""
    tok = _tokenizer(path)
    back = {letter: b for b, letter in byte_letters().items()}
    cut = regex.compile(PRETOKENS)
    found = []
    for piece in tok.get_vocab(with_added_tokens=False):
        if not all(c in back for c in piece):
            continue
        try:
            text = bytes(back[c] for c in piece).decode("utf-8")
        except UnicodeDecodeError:
            continue
        if cut.findall(text) == [text] and [t.value for t in tok.model.tokenize(piece)] == [piece]:
            found.append(text)
    return found


def special_strings(path: str) -> list[str]:
    with open(path, encoding="utf-8") as f:
        return [t["content"] for t in json.load(f).get("added_tokens", [])]


class Counter:
    """Counts the tokens of texts; one in each worker."""

    def __init__(self, path: str, whole: list[str], special: list[str]):
        self.model = _tokenizer(path).model
        self.known = dict.fromkeys(whole, 1)
        self.merged: dict[str, int] = {}
        self.find = regex.compile(PRETOKENS).findall
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) \
            if special else None

    def merge(self, pre: str) -> int:
        n = self.merged.get(pre)
        if n is None:
            n = len(self.model.tokenize(spell(pre)))
            if len(self.merged) >= REMEMBERED:
                self.merged.clear()
            self.merged[pre] = n
        return n

    def plain(self, text: str) -> int:
        total = 0
        for piece in pieces(text):
            pre = self.find(piece)
            hits = [*map(self.known.get, pre)]
            missing = hits.count(None)
            total += len(hits) - missing
            if missing:
                merge = self.merge
                total += sum(merge(p) for p, hit in zip(pre, hits) if hit is None)
        return total

    def count(self, text: str) -> int:
        if not self.special or not self.special.search(text):
            return self.plain(text)
        return len(self.special.findall(text)) + sum(map(self.plain, self.special.split(text)))


def pieces(text: str, size: int = PIECE):
    """Parts of a long text that can be cut into pre-tokens on their own: no
    pre-token goes on from a non-space to a space."""
    at = 0
    while len(text) - at > size:
        m = _EDGE.search(text, at + size)
        if not m:
            break
        yield text[at:m.end()]
        at = m.end()
    yield text[at:]


_EDGE = regex.compile(r"\S(?=\s)")


def count_tokens(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) of each row.

    Null and empty texts have 0 bytes and tokens. Rows, repeated ones too, are
    counted one by one; a null doc_id stays null; other columns are ignored.
    ``path`` names a byte-level BPE file that every worker can open.
    """
    whole, special = proven_whole(path), special_strings(path)
    shared = docs.sparkSession.sparkContext.broadcast((whole, special))

    def run(batches):
        counter = None
        for piece in ts.slices(batches, budget=1 << 22):
            counter = counter or Counter(path, *shared.value)
            col = piece.column("text")
            _, off = ts.text_buffer(col)
            n = np.array([counter.count(t) if t else 0 for t in col.to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(np.diff(off)), pa.array(n), pa.array(n > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op5(spark, sf_dir):
    import public_tokenizers
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
