"""Operator 12: importance resampling to a target distribution, ranked by parallel sorting by regular sampling.

Words and word pairs are hashed into buckets (crc32 of their bytes). A bucket's gain is the log ratio of its share in the
target over its share in the source, and a document's weight is the mean gain of its features, read from one array. A
pair's crc32 is put together from its words' in numpy, as crc32 is linear, so no pair is ever built as a string.

Documents are then ranked by weight plus Gumbel noise, which draws without replacement. The sort is by regular sampling:
every run is sorted where it lies, rows at a fixed stride of each run give splitters, rows are dealt to the segments
between splitters, and the rows before each segment give exact ranks.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import filled, segment_sum, stage, text_slices, unused

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
#: Rows of a sample that the driver sorts (40 bytes each); a larger sample is ranked by the same sort, one level down.
MOST_SAMPLES = 200_000
SAMPLE_SEGMENT = 100_000
WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True  # after A-Z are lower-cased
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
POLYNOMIAL = 0xEDB88320


@cache
def crc_table() -> np.ndarray:
    """The crc32 of each byte's step."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(POLYNOMIAL) ^ (c >> np.uint32(1)), c >> np.uint32(1))
    return c


def applied(table: np.ndarray, c: np.ndarray) -> np.ndarray:
    """A linear map of 32-bit values, given by what it makes of each of their four bytes (shape 4 × 256)."""
    return table[0, c & 255] ^ table[1, c >> 8 & 255] ^ table[2, c >> 16 & 255] ^ table[3, c >> 24]


@cache
def shift(n: int) -> np.ndarray:
    """What ``n`` more bytes make of a crc32: crc32(a + b) = shift(len(b)) of crc32(a), xor crc32(b)."""
    if n == 0:
        return np.array([[v << 8 * k for v in range(256)] for k in range(4)], np.uint32)
    if n == 1:
        c = shift(0)
        return crc_table()[c & 255] ^ (c >> np.uint32(8))
    half = shift(n // 2)
    whole = applied(half, half)
    return applied(shift(1), whole) if n % 2 else whole


def shifted(c: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Each crc32 of ``c`` shifted by as many bytes as ``by`` says."""
    lengths, which = np.unique(by, return_inverse=True)
    if len(lengths) > 512:  # many odd lengths: one table at a time
        out = np.empty(len(c), np.uint32)
        for k, n in enumerate(lengths.tolist()):
            at = which == k
            out[at] = applied(shift(n), c[at])
        return out
    tables = np.array([shift(n) for n in lengths.tolist()], np.uint32).reshape(-1, 4, 256)
    return tables[which, 0, c & 255] ^ tables[which, 1, c >> 8 & 255] ^ tables[which, 2, c >> 16 & 255] ^ tables[which, 3, c >> 24]


def words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Codes of all words into the distinct words (lower-cased bytes), these, and words per text."""
    texts = filled(texts)
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = LOWER[np.frombuffer(raw, np.uint8)[ends[0] : ends[-1]]] if raw is not None else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    inside = WORD[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = ends[:-1][ends[:-1] < len(data)]
    begins[first] = inside[first]  # a word ends with its text
    kept = data[inside]
    offsets = np.append((np.cumsum(inside) - 1)[begins], len(kept)).astype(np.int64)
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
    coded = found.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, np.diff(np.concatenate([[0], np.cumsum(begins)])[ends])


def features(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all words and of all pairs on end, and how many words and pairs each text has."""
    codes, distinct, count = words(texts)
    plain = distinct.to_pylist()
    crc = np.fromiter(map(zlib.crc32, plain), np.uint32, len(plain))
    size = np.fromiter(map(len, plain), np.int64, len(plain))
    spaced = np.fromiter((zlib.crc32(b" ", c) for c in crc.tolist()), np.uint32, len(plain))
    doc = np.repeat(np.arange(len(count)), count)
    left = np.flatnonzero(doc[:-1] == doc[1:]) if len(doc) else np.zeros(0, np.int64)
    a, b = codes[left], codes[left + 1]
    pair = shifted(spaced[a], size[b]) ^ crc[b]
    return (crc % buckets)[codes].astype(np.int64), (pair % buckets).astype(np.int64), count, np.maximum(count - 1, 0)


def as_text(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.col(text).cast("string").alias("text"))


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all whole texts; a task sends one row a bucket, the driver gets one row a bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in text_slices(batch):
                one, two, _, _ = features(part.column("text"), buckets)
                total += np.bincount(one, minlength=buckets) + np.bincount(two, minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["bucket", "n"])

    found = as_text(docs, text).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 × log of the smoothed share in the target over that in the source) of every bucket."""
    n, s, t = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((b + 1) * (s + n) / ((a + 1) * (t + n)))) for a, b in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows doc_id, n_words, n_features, weight: the floored mean gain of each whole text's features, 0 without any."""
    held = docs.sparkSession.sparkContext.broadcast(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                one, two, count, pairs = features(part.column("text"), len(held.value))
                total, n = segment_sum(held.value[one], count) + segment_sum(held.value[two], pairs), count + pairs
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(count), pa.array(n), pa.array(np.floor_divide(total, np.maximum(n, 1)))], names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def gumbel(key: Column, seed: int = SEED) -> Column:
    """1000 × Gumbel noise, floored, from the first 32 bits of sha256 of ``seed:key``; a null key counts as empty."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def order_of(columns: Sequence[np.ndarray]) -> np.ndarray:
    return np.lexsort(tuple(reversed(columns)))


def regular_splitters(samples: DataFrame, key: list[str], expected: int, segments: int) -> np.ndarray:
    """At most ``segments`` - 1 rows of the samples at even distances in their order (one row each, a column a key)."""
    if expected <= MOST_SAMPLES:
        found = np.array([c.to_numpy(zero_copy_only=False) for c in samples.select(*key).toArrow().columns], np.int64).reshape(len(key), -1)
        found = found[:, order_of(list(found))]
        at = np.arange(1, segments) * found.shape[1] // segments
        return found[:, np.unique(at[at < found.shape[1]])]
    ranked = ranks(samples.select(*key), key, into="_at", segments=-(-expected // SAMPLE_SEGMENT))
    n = samples.count()
    place = lambda c: F.floor(c * segments / F.lit(n))
    chosen = ranked.where(place(F.col("_at")) > place(F.col("_at") - 1)).select(*key).toArrow()
    found = np.array([c.to_numpy(zero_copy_only=False) for c in chosen.columns], np.int64).reshape(len(key), -1)
    return found[:, order_of(list(found))]


def ranks(rows: DataFrame, key: Sequence[str], into: str = "rank", segments: int | None = None) -> DataFrame:
    """All rows with exact ranks 1, 2, 3... in the ascending order of the long columns ``key``, none of them null.

    With as many segments as runs none gets over twice its share of the rows, whatever their distribution: rows are told
    apart by their run and place there, so rows with equal keys have ranks of their own, next to each other, and any
    number of them may be split between segments. A run is what one task holds. The driver gets at most
    ``MOST_SAMPLES`` sampled keys; larger samples are ranked by this same function. ``segments`` defaults to
    ``spark.sql.shuffle.partitions``.
    """
    spark = rows.sparkSession
    part, at, segment = (unused(rows, c) for c in ("_run", "_at", "_segment"))
    local = F.monotonically_increasing_id()
    runs = stage(rows.sortWithinPartitions(*key).withColumns({part: F.spark_partition_id().cast("long"), at: local.bitwiseAND(F.lit((1 << 33) - 1))}), "runs")
    order = [*key, part, at]
    n, many = runs.agg(F.count("*"), F.count_distinct(part)).first()
    segments = max(1, min(segments or int(spark.conf.get("spark.sql.shuffle.partitions")), n))
    stride = max(1, n // segments**2)
    samples = runs.where(F.col(at) % stride == 0)
    splitters = regular_splitters(samples, order, n // stride + many, segments) if segments > 1 else np.zeros((len(order), 0), np.int64)
    held = spark.sparkContext.broadcast(splitters)

    @F.arrow_udf("int")
    def deal(*columns: pa.Array) -> pa.Array:
        own, cuts = [c.to_numpy(zero_copy_only=False) for c in columns], held.value
        both = order_of([np.concatenate([s, c]) for s, c in zip(cuts, own, strict=True)])  # a row equal to a splitter comes after it
        before = np.cumsum(both < cuts.shape[1])
        out = np.empty(len(both), np.int32)
        out[both] = before
        return pa.array(out[cuts.shape[1] :])

    dealt = runs.withColumn(segment, deal(*(F.col(c) for c in order))).repartitionById(segments, F.col(segment)).sortWithinPartitions(segment, *order)
    placed = stage(dealt.withColumn(at, local), "segments")
    sizes = placed.groupBy(segment).agg(F.count("*").alias("n"), F.min(at).alias("first")).toArrow()  # a row for each segment
    which, size, first = (sizes.column(c).to_numpy() for c in (segment, "n", "first"))
    before = np.concatenate([[0], np.cumsum(size[np.argsort(which)])])[np.argsort(np.argsort(which))]
    starts = spark.createDataFrame([(int(a), int(b)) for a, b in zip(which, before - first + 1, strict=True)], f"{segment} int, _before long")
    return placed.join(F.broadcast(starts), segment).withColumn(into, F.col(at) + F.col("_before")).select(*rows.columns, into)


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """Rows doc_id, n_features, weight, score, rank: one for each document; those drawn have a rank from 1.

    Of the N documents with at least ``least_words`` words the floor(``percent`` × N / 100) of highest score are drawn, ties
    to the smaller doc_id (a null one first), then fewer features, then the smaller weight. A null text has no words;
    rows that repeat are documents of their own, and all count; other columns are ignored. Texts are read twice: once
    for the counts of all, once for the weights.
    """
    gain = gains(bucket_counts(docs, buckets=buckets), bucket_counts(target, buckets=buckets))
    scored = weighed(docs, gain).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    scored = stage(scored, "scored")
    able = F.col("n_words") >= least_words
    down = {"_down": -F.col("score"), "_there": F.col("doc_id").isNotNull().cast("long"), "_doc": F.coalesce("doc_id", F.lit(0))}
    ranked = ranks(scored.where(able).withColumns(down), [*down, "n_features", "weight"])
    drawn = scored.where(able).count() * percent // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")).unionByName(scored.where(~able).select(*columns, F.lit(None).cast("long").alias("rank")))
