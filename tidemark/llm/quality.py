"""Operator 7: a quality classifier, logistic regression on hashed word n-grams trained by follow the regularised leader.

Features are the words and word pairs of a whole text, hashed into ``BUCKETS`` places; runs of signs count as words of
their own, and all pairs of a word with itself share one place. A feature's value is its share of the text's features. The score is one sparse dot product through a sigmoid.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import filled, hashed, mixed, segment_sum, stage, text_slices, words_of

BUCKETS = 1 << 18
#: Labelled rows that one model learns from; more rows are dealt out to as many models as it takes, and these averaged.
ROWS_OF_A_MODEL = 5000
#: Parts of 1 / FINE that models' weights are rounded to before they are added up, so that sums depend on no order.
FINE = 1 << 26
EPOCHS = 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 1e-4, 1e-5
SCALE = 30.0
TWICE = np.uint64(2)  # the place of a word that follows itself
SIGNS = r"([^\p{L}\p{N}\s]+)"


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Places of all features of all texts on end, and how many each text has."""
    codes, words, count = words_of(pc.replace_substring_regex(filled(texts), SIGNS, r" \1 "))
    word = mixed(hashed(words))[codes]
    doc = np.repeat(np.arange(len(texts)), count)
    with np.errstate(over="ignore"):
        pair = mixed(word[:-1] * np.uint64(0x9E3779B97F4A7C15) + word[1:])
    pair[codes[:-1] == codes[1:]] = TWICE
    pair = pair[doc[:-1] == doc[1:]]
    pairs = np.maximum(count - 1, 0)
    each = count + pairs
    start = np.cumsum(each) - each
    out = np.empty(each.sum(), np.int64)
    mask = np.uint64(BUCKETS - 1)
    out[np.repeat(start - (np.cumsum(count) - count), count) + np.arange(len(word))] = word & mask
    out[np.repeat(start + count - (np.cumsum(pairs) - pairs), pairs) + np.arange(len(pair))] = pair & mask
    return out, each


class FollowTheLeader:
    """FTRL-proximal for logistic loss, one step per example; the last weight is the bias."""

    def __init__(self) -> None:
        self.z = np.zeros(BUCKETS + 1)
        self.n = np.zeros(BUCKETS + 1)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z = self.z[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2))

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ value, -30, 30))) - label) * value
        step = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - step * w
        self.n[at] += g * g


def in_holdout(key: Column) -> Column:
    """Whether a row is held out of training: crc32 of its id as text leaves 1 when divided by 3. Null: no."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(3)) == 1, F.lit(False))


STATE = "place int, weight long, rows long"


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows_of_a_model: int = ROWS_OF_A_MODEL) -> np.ndarray:
    """Weights (float32, ``BUCKETS`` + 1) from every labelled row outside the held-out fold.

    Rows without an id or a label teach nothing; of documents that share an id one teaches. Without any row all weights
    are 0 and every score is 0.5. Rows are dealt by their ids' hashes to models of about ``rows_of_a_model`` rows each. A
    model learns its rows in the order of these hashes, ``EPOCHS`` times, in one task that holds a batch of them at a
    time. A place's weight is the mean over the models whose rows hold it, in proportion to how many of their rows do;
    only these means reach the driver. Texts meet their labels where their model learns, so they are shuffled once.
    Each epoch makes the features of its texts anew, as these are larger than the texts.
    """
    fold = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    fold = stage(fold.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~in_holdout(F.col("doc_id"))).distinct(), "training-labels")
    models = -(-fold.count() // rows_of_a_model)
    weights = np.zeros(BUCKETS + 1, np.float32)
    if not models:
        return weights
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.col("doc_id").isNotNull() & ~in_holdout(F.col("doc_id")))
    both = own.withColumn("key", F.xxhash64("text")).unionByName(fold, allowMissingColumns=True).withColumn("h", F.xxhash64("doc_id"))
    dealt = both.withColumn("model", F.pmod("h", F.lit(models)).cast("int")).repartitionById(models, "model").groupBy("model", "h", "doc_id")
    found = dealt.agg(F.min_by(F.struct("text"), "key").alias("own"), F.collect_set("label").alias("labels")).where("own is not null")
    rows = found.select("model", "h", "doc_id", F.explode("labels").alias("label"), "own.text").withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(EPOCHS))))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, model, held = None, FollowTheLeader(), np.zeros(BUCKETS + 1, np.int64)

        def learned() -> pa.RecordBatch:
            there = np.flatnonzero(held)
            weight = np.rint(model.weights(there) * FINE).astype(np.int64) * held[there]
            return pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(weight, pa.int64()), pa.array(held[there], pa.int64())], names=["place", "weight", "rows"])

        for part in (p for batch in batches for p in text_slices(batch)):
            at, each = features(part.column("text"))
            for k, epoch, y, piece in zip(*(part.column(c).to_pylist() for c in ("model", "epoch", "label")), np.split(at, np.cumsum(each)[:-1]), strict=True):
                if k != now:
                    yield learned()
                    now, model, held = k, FollowTheLeader(), np.zeros(BUCKETS + 1, np.int64)
                place, times = np.unique(piece, return_counts=True)
                places = np.append(place, BUCKETS)
                model.learn(places, np.append((times / max(len(piece), 1)).astype("<f4") * SCALE, 1.0), y)
                held[places] += epoch == 1
        yield learned()

    ordered = rows.sortWithinPartitions("model", "epoch", "h", "doc_id", "label").select("model", "epoch", "label", "text")
    mean = F.sum("weight") / F.sum("rows") / F.lit(float(FINE))
    means = ordered.mapInArrow(learn, STATE).groupBy("place").agg(mean.cast("float").alias("weight")).toArrow()
    weights[means.column("place").to_numpy()] = means.column("weight").to_numpy()
    return weights


def scores(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    at, each = features(texts)
    dot = segment_sum(weights[at].astype(np.float64), each) * SCALE / np.maximum(each, 1) + float(weights[BUCKETS])
    return 1 / (1 + np.exp(-np.clip(dot, -30, 30)))


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", into: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score of each whole text in ``into``; a null text scores as an empty one.

    ``into`` must be a new column, so that none of the table's own is lost.
    """
    if into.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"the table has a column {into} of its own; name another for the score")
    held = docs.sparkSession.sparkContext.broadcast(weights)

    @F.arrow_udf("double")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            part = pa.RecordBatch.from_arrays([batch], names=["text"])
            found = [scores(p.column("text"), held.value) for p in text_slices(part)]
            yield pa.array(np.concatenate(found) if found else np.zeros(0))

    return docs.withColumn(into, of(F.col(text).cast("string")))
