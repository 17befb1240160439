"""Importance resampling towards a target distribution (operator 12).

Hashed n-gram counts of the corpus and of the target give each bucket a gain
(the log of the smoothed ratio of its shares); a document's weight is the mean
gain of its features. A Gumbel number from its id is added, and the documents
with the highest sums are drawn: a sample without replacement, in proportion
to the weights, that reruns repeat.

Buckets come from CRC-32, computed for all features of a batch at once. The
CRC is linear: without its start value it is the XOR of a contribution of each
byte, which depends on the byte and on its distance from the span's end. A
table holds the contributions up to ``REACH`` bytes from the end;
``bitwise_xor.reduceat`` combines them over the spans, and a constant of the
length brings in start value and final inversion. A longer span is cut into
blocks of ``REACH`` bytes from its end: the state after one block is shifted
over the next by four tables, one for each of its bytes.

Counting is one pass over the texts with a vector of counts a task; scoring is
another. Scores are whole numbers, so their histogram is small and gives the
lowest score drawn; only documents from there up are sorted, by range, and
ranked by their partition's offset and their place in it.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewatch.llm import textscan as ts
from pricewatch.llm.settle import settle, spare, table

REACH = 256                 # bytes from the end that the table covers
ALL = np.uint32(0xFFFFFFFF)
POLYNOMIAL = 0xEDB88320     # of CRC-32, reversed
FEATURES = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_features", T.LongType()),
                         T.StructField("weight", T.LongType())])
RESULT = ("n_words", "n_features", "weight", "score", "rank")


@functools.cache
def _step() -> np.ndarray:
    """A state's low byte to what a step of one byte adds."""
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & 1, (x >> 1) ^ np.uint32(POLYNOMIAL), x >> 1).astype(np.uint32)
    return x


def _zeros(state: np.ndarray, n: int) -> np.ndarray:
    """States after ``n`` zero bytes."""
    for _ in range(n):
        state = (state >> np.uint32(8)) ^ _step()[state & np.uint32(255)]
    return state


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contributions (by distance from the end, byte); the start value after
    0 ... REACH bytes; the shift over REACH bytes (by the state's byte)."""
    place = np.empty((REACH, 256), np.uint32)
    place[0] = _step()
    for d in range(1, REACH):
        place[d] = _zeros(place[d - 1], 1)
    start = np.empty(REACH + 1, np.uint32)
    start[0] = ALL
    for n in range(1, REACH + 1):
        start[n] = _zeros(start[n - 1], 1)
    shift = np.stack([_zeros(np.arange(256, dtype=np.uint32) << np.uint32(8 * i), REACH) for i in range(4)])
    return place, start, shift


def _linear(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC without start value and inversion of spans of 1 to REACH bytes."""
    size = end - start
    begin = np.cumsum(size) - size
    from_end = np.repeat(begin + size, size) - np.arange(1, int(size.sum()) + 1)
    at = np.repeat(end, size) - 1 - from_end
    return np.bitwise_xor.reduceat(_tables()[0].ravel()[(from_end << 8) + data[at]], begin)


def span_crc(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of each byte span ``data[start:end]``, none empty."""
    if not len(start):
        return np.empty(0, np.uint32)
    _, first, shift = _tables()
    blocks = (end - start - 1) // REACH             # behind the head of 1 to REACH bytes
    head = end - blocks * REACH
    state = _linear(data, start, head) ^ first[head - start]
    left = np.flatnonzero(blocks)
    done = 0
    while len(left):
        a = head[left] + done * REACH
        s = state[left]
        s = shift[0][s & 255] ^ shift[1][(s >> 8) & 255] ^ shift[2][(s >> 16) & 255] ^ shift[3][s >> 24]
        state[left] = s ^ _linear(data, a, a + REACH)
        done += 1
        left = left[blocks[left] > done]
    return state ^ ALL


def features(buf: np.ndarray, off: np.ndarray, fewest: int, most: int, buckets: int):
    """Words of each row, features of each row, and their buckets, row by row.
    A feature is a run of ``fewest`` to ``most`` words, joined by one space."""
    start, end, first = word_spans(buf, off)
    data, count = ts.PLAIN.fold[buf], np.diff(first)
    if most > 1:                                    # words with one space between
        size = end - start
        to = np.cumsum(size + 1) - size - 1
        plain = np.full(int(size.sum()) + len(size), 32, np.uint8)
        within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        plain[np.repeat(to, size) + within] = data[np.repeat(start, size) + within]
        data, start, end = plain, to, to + size
    row = np.repeat(np.arange(len(count)), count)
    found, of = [], []
    for n in range(fewest, most + 1):
        i = np.arange(max(0, len(start) - n + 1))
        i = i[row[i] == row[i + n - 1]]
        found.append(span_crc(data, start[i], end[i + n - 1]).astype(np.int64) % buckets)
        of.append(row[i])
    bucket, of = np.concatenate(found), np.concatenate(of)
    order = np.argsort(of, kind="stable") if most > fewest else slice(None)
    return count, np.bincount(of, minlength=len(count)), bucket[order]


def word_spans(buf: np.ndarray, off: np.ndarray):
    """Starts and ends of all words, and the n + 1 places of rows in them."""
    inside = np.concatenate([[False], ts.PLAIN.inside[ts.PLAIN.fold[buf]], [False]])
    cut = np.zeros(len(buf) + 1, bool)
    cut[off] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    return start, end, np.searchsorted(start, off)


def bucket_counts(texts: DataFrame, buckets: int, fewest: int = 1, most: int = 1) -> np.ndarray:
    """Features of all texts by bucket: a vector of ``buckets`` longs."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for piece in ts.slices(batches):
            buf, off = ts.text_buffer(piece.column("text"))
            total += np.bincount(features(buf, off, fewest, most, buckets)[2], minlength=buckets)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(total[full], pa.int64())],
                                         ["bucket", "n"])
    counts = np.zeros(buckets, np.int64)
    for r in texts.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket int, n long") \
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect():         # at most ``buckets`` rows
        counts[r.bucket] = r.n
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket, in thousandths: the log of its smoothed share in the
    target over that in the corpus."""
    s_all, t_all, n = float(corpus.sum()), float(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n))))
                     for s, t in zip(corpus.astype(float).tolist(), target.astype(float).tolist())], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, fewest: int = 1, most: int = 1, name: str = "_weight") -> DataFrame:
    """``docs`` with the struct ``name``: n_words, n_features, weight (the
    floored mean gain of the features, 0 without any)."""
    rows = docs.withColumn("text", F.col("text").cast("string"))
    text = rows.columns.index("text")

    def run(batches):
        for piece in ts.slices(batches):
            buf, off = ts.text_buffer(piece.column(text))
            words, n, bucket = features(buf, off, fewest, most, len(gain))
            total = np.concatenate([[0], np.cumsum(gain[bucket])])
            end = np.cumsum(n)
            weight = (total[end] - total[end - n]) // np.maximum(n, 1)
            both = pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in (words, n, weight)],
                                              FEATURES.fieldNames())
            yield pa.RecordBatch.from_arrays([*piece.columns, both], [*piece.schema.names, name])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(name, FEATURES)]))


def gumbel(seed: int, id: str = "doc_id"):
    """Thousandths of a Gumbel number made of seed and id; a null id counts as
    an empty one."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, buckets: int = 10_000,
             fewest: int = 1, most: int = 1, seed: int = 2024, id: str = "doc_id", keep: list[str] | None = None,
             name: str = "_draw") -> DataFrame:
    """``docs`` (its columns, or those of ``keep``) with a struct of n_words,
    n_features, weight, score and rank: 1, 2, ... for the ``percent`` of the
    rows with ``least_words`` that are drawn (rounded down), else null. It is
    called ``name``, with underscores added while that is taken.

    Null, empty and wordless texts have no features and weight 0. Rows of
    equal score are ordered by id, null first; repeated rows of an id are
    drawn one by one, in an order without meaning. An empty target is uniform;
    no rows give no rows.
    """
    name = spare(docs, name)
    gain = gains(bucket_counts(docs, buckets, fewest, most), bucket_counts(target, buckets, fewest, most))
    keep = docs.columns if keep is None else keep
    o, raw = F.col(name), spare(docs, name + "_raw")
    scored = weighted(docs, gain, fewest, most, raw).withColumn(name, F.struct(
        *[F.col(raw)[c].alias(c) for c in FEATURES.fieldNames()],
        (F.col(raw)["weight"] + gumbel(seed, id)).alias("score")))
    scored = settle(scored.select(*keep, name), "scores")
    able = scored.where(o["n_words"] >= least_words)
    # A score is a whole number between the logs of the least and the greatest
    # possible ratio, in thousandths: under 100,000 different ones at any size.
    count = sorted(((r.score, r["count"]) for r in able.groupBy(o["score"].alias("score")).count().collect()),
                   reverse=True)
    drawn = percent * sum(c for _, c in count) // 100
    lowest, above = None, 0
    for score, c in count:
        if above >= drawn:
            break
        lowest, above = score, above + c
    if lowest is None:
        return _ranked(scored, name, F.lit(None))
    high = (o["n_words"] >= least_words) & (o["score"] >= lowest)
    place = spare(scored, "_place")
    # monotonically_increasing_id: the partition's number, 33 bits of the place in it.
    ordered = scored.where(high).repartitionByRange(o["score"].desc(), F.col(id).asc_nulls_first(),
                                                    F.xxhash64(*keep, name)) \
        .sortWithinPartitions(o["score"].desc(), F.col(id).asc_nulls_first()) \
        .withColumn(place, F.monotonically_increasing_id())
    ordered = settle(ordered, "order")
    part = F.shiftright(place, 33)
    before, offset = 0, [F.lit(0), F.lit(0)]
    for r in sorted(ordered.groupBy(part.alias("part")).count().collect()):     # a row a partition
        offset += [F.lit(r.part), F.lit(before)]
        before += r["count"]
    rank = F.element_at(F.create_map(*offset[2:] or offset), part) + F.col(place).bitwiseAND((1 << 33) - 1) + 1
    rest = _ranked(scored.where(~high), name, F.lit(None))
    return rest.unionByName(_ranked(ordered, name, F.when(rank <= drawn, rank)).select(rest.columns))


def _ranked(rows: DataFrame, name: str, rank) -> DataFrame:
    return rows.select(*[c for c in rows.columns if c not in (name, "_place")], F.struct(
        *[F.col(name)[c].alias(c) for c in RESULT[:-1]], rank.cast("long").alias("rank")).alias(name))


def op12(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = resample(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", *[F.col("_draw")[c].alias(c) for c in RESULT[1:]])


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), b AS (
  SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark
), words AS MATERIALIZED (SELECT DISTINCT word FROM (SELECT unnest(w) AS word FROM d UNION ALL SELECT word FROM b)),
steps AS MATERIALIZED (
  SELECT i, list_reduce(range(0, 8), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
                        CAST(i AS BIGINT)) AS v FROM range(0, 256) AS t(i)
), crc AS MATERIALIZED (
  SELECT word, xor(4294967295, list_reduce(
    list_transform(range(1, octet_length(encode(word)) + 1),
                   lambda i: CAST('0x' || hex(array_slice(encode(word), i, i)) AS BIGINT)),
    lambda c, x: xor(c >> 8, steps[xor(c & 255, x) + 1]), CAST(4294967295 AS BIGINT))) % 10000 AS bucket
  FROM words, (SELECT list(v ORDER BY i) AS steps FROM steps)
), f AS MATERIALIZED (
  SELECT row, doc_id, bucket FROM (SELECT row, doc_id, unnest(w) AS word FROM d) JOIN crc USING (word)
), s AS (SELECT bucket, count(*) AS s FROM f GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM b JOIN crc USING (word) GROUP BY bucket),
gain AS (
  SELECT s.bucket, CAST(floor(1000 * ln(
    CAST(coalesce(t, 0) + 1 AS DOUBLE) * ((SELECT count(*) FROM f) + 10000)
    / (CAST(s + 1 AS DOUBLE) * ((SELECT count(*) FROM b) + 10000)))) AS BIGINT) AS g
  FROM s LEFT JOIN t ON t.bucket = s.bucket
), weights AS (
  SELECT row, count(*) AS n, CAST(sum(g) AS BIGINT) AS g FROM f JOIN gain USING (bucket) GROUP BY row
), scored AS (
  SELECT d.row, doc_id, coalesce(n, 0) AS n_features,
    coalesce((g - ((g % n) + n) % n) // n, 0) AS weight,
    CAST('0x' || substr(sha256('2024:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) AS h
  FROM d LEFT JOIN weights USING (row)
), sums AS (
  SELECT row, doc_id, n_features, weight,
    weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM scored
), ranks AS (
  SELECT row, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n
  FROM sums WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank
FROM sums LEFT JOIN ranks USING (row)
"""
