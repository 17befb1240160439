"""Benchmark decontamination (operator 7).

The windows of the benchmark items (13 words, or a shorter item's whole
sequence) are hashed into a set that is broadcast while its words and ids stay
below a stated number of bytes; tasks slide the same windows over the documents and look them up. Every
hit is verified on the words themselves. A larger benchmark takes the other
way: the hashes of the documents' windows meet the benchmark's in a join, and
only documents with a meeting are scanned again, against the windows they met.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewatch.llm import textscan as ts
from pricewatch.llm.settle import settle, spare, table

WINDOW = 13
BROADCAST_BYTES = 48 << 20          # of words and ids, and 100 for each window's objects
OVERLAP = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))])


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(hash, k, words, item) of every window: its words joined by spaces."""
    def run(batches):
        for piece in ts.slices(batches):
            rows = {"hash": [], "k": [], "words": [], "item": []}
            buf, off = ts.text_buffer(piece.column("text"))
            low = ts.PLAIN.fold[buf].tobytes()
            w = ts.words(buf, off, ts.PLAIN)
            count = np.diff(w.first)
            names = piece.column("item").to_pylist()
            for k in range(1, size + 1):
                h, at = ts.windows(w, k)
                if k < size:
                    keep = count[w.doc[at]] == k
                    h, at = h[keep], at[keep]
                for x, i in zip(ts.signed(h).tolist(), at.tolist()):
                    rows["hash"].append(x)
                    rows["k"].append(k)
                    rows["words"].append(_joined(low, w, i, k))
                    rows["item"].append(names[w.doc[i]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["hash"], pa.int64()), pa.array(rows["k"], pa.int32()),
                 pa.array(rows["words"], pa.binary()), pa.array(rows["item"], pa.string())], list(rows))
    return items.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text")) \
        .where("item is not null").mapInArrow(run, "hash long, k int, words binary, item string").distinct()


def _joined(low: bytes, w: ts.Words, first: int, k: int) -> bytes:
    return b" ".join(low[w.start[j]:w.end[j]] for j in range(first, first + k))


class Windows:
    """The looked-up windows: sorted hashes by length, and the items of each
    window's words."""

    def __init__(self, rows):
        self.items: dict[bytes, list[str]] = {}
        by: dict[int, set[int]] = {}
        for h, k, words, item in rows:
            by.setdefault(k, set()).add(h)
            self.items.setdefault(bytes(words), []).append(item)
        self.hashes = {k: np.sort(np.array(sorted(v), np.int64)) for k, v in by.items()}

    def scan(self, buf: np.ndarray, off: np.ndarray):
        """Words, and for each row the items that occur and the hit words."""
        w = ts.words(buf, off, ts.PLAIN)
        low = ts.PLAIN.fold[buf].tobytes()
        hit = np.zeros(len(w.hash) + 1, np.int64)
        items: dict[int, set[str]] = {}
        for k, known in self.hashes.items():
            h, at = ts.windows(w, k)
            h = ts.signed(h)
            place = np.minimum(np.searchsorted(known, h), len(known) - 1)
            for i in at[known[place] == h].tolist():
                names = self.items.get(_joined(low, w, i, k))
                if names:                                   # verified: the words are equal
                    hit[i] += 1
                    hit[i + k] -= 1
                    items.setdefault(int(w.doc[i]), set()).update(names)
        return w, np.cumsum(hit)[:-1] > 0, items


def _spans(w: ts.Words, hit: np.ndarray, row: int, offset: int) -> list[dict]:
    """Byte spans of the runs of hit words in a row."""
    a, b = w.first[row], w.first[row + 1]
    here = np.concatenate([[False], hit[a:b], [False]])
    edge = np.flatnonzero(here[1:] != here[:-1])
    return [{"start": int(w.start[a + s] - offset), "end": int(w.end[a + e - 1] - offset)}
            for s, e in zip(edge[::2], edge[1::2])]


def overlap(docs: DataFrame, items: DataFrame, size: int = WINDOW,
            most: int = BROADCAST_BYTES, name: str = "_overlap") -> DataFrame:
    """``docs`` with its columns, and the struct ``name``: n_words, n_hit (words
    inside any occurrence of a window), items (ids of items with occurring
    windows, sorted as strings) and spans (bytes, end exclusive) of hit words.

    Null and empty texts have no words. A null item_id or an item without
    words has no windows. Rows are judged one by one.
    """
    docs = docs.drop(name)          # a column of that name is replaced
    spark = docs.sparkSession
    known = settle(item_windows(items, size), "windows")
    size = known.agg(F.sum(F.length("words") + F.length(F.col("item").cast("binary")) + 100)).first()[0] or 0
    if size <= most:
        rows = [tuple(r) for r in known.collect()]
        shared = spark.sparkContext.broadcast(rows)
        return _scanned(docs, name, lambda: Windows(shared.value).scan)
    return _joined_scan(docs, name, known, size)


def _result(piece, scan, text) -> pa.Array:
    buf, off = ts.text_buffer(text)
    w, hit, items = scan(buf, off)
    total = np.concatenate([[0], np.cumsum(hit)])
    n, n_hit = np.diff(w.first), total[w.first[1:]] - total[w.first[:-1]]
    names = [sorted(items.get(i, ())) for i in range(len(n))]
    spans = [_spans(w, hit, i, int(off[i])) if n_hit[i] else [] for i in range(len(n))]
    kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
                      ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])
    return pa.StructArray.from_arrays(
        [pa.array(n, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(names, pa.list_(pa.string())),
         pa.array(spans, kind.field("spans").type)], fields=list(kind))


def _scanned(docs: DataFrame, name: str, make) -> DataFrame:
    text = docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, OVERLAP)])

    def run(batches):
        scan = None
        for piece in ts.slices(batches):
            scan = scan or make()
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, _result(piece, scan, piece.column(text))],
                [*piece.schema.names, name])

    return docs.mapInArrow(run, schema)


def _joined_scan(docs: DataFrame, name: str, known: DataFrame, size: int) -> DataFrame:
    """The way for a benchmark too large to broadcast: by a join on hashes."""
    lengths = [r.k for r in known.select("k").distinct().collect()]        # at most ``size``
    row, met_ = spare(docs, "_row"), spare(docs, "_met")
    keyed = docs.withColumn(row, F.xxhash64(*docs.columns))

    def hashes(batches):
        for piece in ts.slices(batches):
            w = ts.words(*ts.text_buffer(piece.column("text")), ts.PLAIN)
            ids = piece.column(0).to_numpy()
            for k in lengths:
                h, at = ts.windows(w, k)
                yield pa.RecordBatch.from_arrays([pa.array(ids[w.doc[at]]), pa.array(ts.signed(h))],
                                                 ["id", "hash"])

    met = keyed.select(F.col(row).alias("id"), "text").mapInArrow(hashes, "id long, hash long").distinct() \
        .join(known, "hash").groupBy(F.col("id").alias(row)) \
        .agg(F.collect_list(F.struct("hash", "k", "words", "item")).alias(met_))
    both = keyed.join(met, row, "left").drop(row)
    text, names = docs.columns.index("text"), docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField(name, OVERLAP)])

    def run(batches):
        for piece in ts.slices(batches):
            found = piece.column(len(names)).to_pylist()
            parts = [_result(None, Windows([(m["hash"], m["k"], m["words"], m["item"]) for m in mine or ()]).scan,
                             piece.column(text).slice(i, 1)) for i, mine in enumerate(found)]
            yield pa.RecordBatch.from_arrays([*piece.columns[:len(names)], pa.concat_arrays(parts)],
                                             [*names, name])

    return both.mapInArrow(run, schema)


def contaminated(name: str = "_overlap"):
    """The rule: words were hit, and they are at least a twentieth."""
    o = F.col(name)
    return (o["n_hit"] > 0) & (o["n_hit"] * 20 >= o["n_words"])


def remove_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the contaminated rows."""
    name = spare(docs, "_overlap")
    return overlap(docs, items, name=name).where(~contaminated(name)).select(docs.columns)


def remove_spans(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` with the hit words cut out of the texts, all rows kept."""
    name = spare(docs, "_overlap")

    def cut(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            spans = batch.column(batch.schema.get_field_index(name)).field("spans").to_pylist()
            new = []
            for t, s in zip(texts, spans):
                if s:
                    raw, parts, at = t.encode(), [], 0
                    for x in s:
                        parts.append(raw[at:x["start"]])
                        at = x["end"]
                    t = b"".join([*parts, raw[at:]]).decode()
                new.append(t)
            cols = [pa.array(new, pa.string()) if n == "text" else batch.column(i)
                    for i, n in enumerate(batch.schema.names) if n != name]
            yield pa.RecordBatch.from_arrays(cols, [n for n in batch.schema.names if n != name])
    return overlap(docs, items, name=name).mapInArrow(cut, docs.schema)


def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = overlap(docs, table(spark, sf_dir, "benchmark"))
    o = F.col("_overlap")
    return found.select(
        "doc_id", o["n_words"].alias("n_words"), o["n_hit"].alias("n_hit"),
        F.size(o["items"]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", o["items"]), 256).alias("items_sha256"),
        contaminated().alias("contaminated"))


def items_digest(ids: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
