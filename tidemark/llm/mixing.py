"""Operator 2: mixing sources to target weights by iterative proportional fitting.

Tokens (words: runs without white space) are summed over the cells of source, language and topic. The cells' weights are
raked until every marginal has its target share; a cell's weight over its own tokens is how often its documents should
be drawn. Divided by the largest such ratio these are sampling probabilities, and a document is drawn by comparing its
own hash with its probability, so the sample is the same in every run and on any number of machines.

The tables have no topic, so topics are found here: spherical k-means on hashed word weights, over every distinct text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import filled, hashed, mixed, stage, text_slices, unused, words_of

DIMENSIONS = ("source", "lang", "topic")
CELL = [f"_{d}" for d in DIMENSIONS]
#: Where a dimension has no given targets, a value with a share of x times the commonest one's gains (1 + EVEN) / (x + EVEN).
EVEN = 2.0
TOLERANCE = 1e-6
#: Rounds after which targets that contradict each other are given up; the result says whether they were met.
MOST_ROUNDS = 40
ROUNDS_AT_ONCE = 2
#: Cells that the driver rakes itself; there are as many as combinations of source, language and topic.
MOST_CELLS_HERE = 50_000
SEED = 20240301
TOPICS, PLACES = 6, 1024
#: Distinct texts of a language from which it has a mean of its own.
LEAST_OF_LANG = 16
TEXTS_AT_ONCE = 2000
#: Parts of 1 / FINE that weights and directions are rounded to. Sums of TEXTS_AT_ONCE of them, and their products with centres
#: in parts of 2 / FINE, stay under 2 ** 24 and are exact in any order, so topics don't depend on batches or machines.
FINE = 4096
#: Sums that a task holds at once, 8 KB each.
MOST_SUMS = 1000
#: A word's place and how often words of a text fall on it.
PAIR = np.dtype([("place", "<u2"), ("count", "<u4")])


@dataclass(frozen=True)
class Topics:
    """Weights of hashed words, what texts of a language have in common, and the directions of the topics from there.

    ``langs`` names the rows of ``means``; the first row is the mean of all texts, which languages without a row have.
    """

    idf: np.ndarray
    langs: dict[str, int]
    means: np.ndarray
    centres: np.ndarray

    def rows_of(self, langs: pa.Array) -> np.ndarray:
        coded = langs.dictionary_encode()
        return np.array([self.langs.get(v, 0) for v in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy(zero_copy_only=False)]

    def directions(self, places: pa.Array, langs: pa.Array) -> np.ndarray:
        """Directions of texts from the mean of their language, in whole parts."""
        return np.rint(units(weighed(places, self.idf) - self.means[self.rows_of(langs)]) * np.float32(FINE))

    def nearest(self, directions: np.ndarray) -> np.ndarray:
        return (directions @ self.centres.T).argmax(axis=1)

    def of(self, places: pa.Array, langs: pa.Array) -> list[str | None]:
        """The nearest topic of each text; null for a text without words."""
        out: list[str | None] = []
        for x in range(0, len(places), TEXTS_AT_ONCE):
            part = places.slice(x, TEXTS_AT_ONCE)
            near = self.nearest(self.directions(part, langs.slice(x, TEXTS_AT_ONCE)))
            out += [f"topic {k}" if there else None for k, there in zip(near.tolist(), pc.binary_length(part).to_pylist(), strict=True)]
        return out


def units(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def word_places(texts: pa.Array) -> np.ndarray:
    """How many words of each text fall on each of ``PLACES`` hashed places."""
    codes, words, count = words_of(pc.utf8_lower(filled(texts)))
    place = (mixed(hashed(words)) & np.uint64(PLACES - 1)).astype(np.int64)[codes]
    at = np.repeat(np.arange(len(texts)), count) * PLACES + place
    return np.bincount(at, minlength=len(texts) * PLACES).reshape(-1, PLACES).astype(np.float32)


def packed_places(texts: pa.Array) -> pa.Array:
    """The places of each text that words fall on, with their counts, as the bytes of ``PAIR``."""
    out = []
    for x in range(0, len(texts), TEXTS_AT_ONCE):
        count = word_places(texts.slice(x, TEXTS_AT_ONCE))
        row, place = np.nonzero(count)
        pairs = np.empty(len(row), PAIR)
        pairs["place"], pairs["count"] = place, count[row, place]
        ends = np.concatenate([[0], np.cumsum(np.count_nonzero(count, axis=1))]) * PAIR.itemsize
        out.append(pa.Array.from_buffers(pa.binary(), len(count), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(pairs.tobytes())]))
    return pa.concat_arrays(out) if out else pa.array([], pa.binary())


def unpacked_places(places: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each place of each text the text's row, and the pairs."""
    size = pc.binary_length(places).to_numpy(zero_copy_only=False).astype(np.int64) // PAIR.itemsize
    return np.repeat(np.arange(len(places)), size), np.frombuffer(b"".join(places.to_pylist()), PAIR)


def weighed(places: pa.Array, idf: np.ndarray) -> np.ndarray:
    """Unit vectors of the weights of texts' words."""
    row, pairs = unpacked_places(places)
    x = np.zeros((len(places), PLACES), np.float32)
    x[row, pairs["place"]] = np.log1p(pairs["count"].astype(np.float32)) * idf[pairs["place"]]
    return units(x)


def summed(texts: DataFrame, parts: int, values: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sums over all rows (lang, places): of the texts in each part how many there are, and what their values add up to.

    ``values`` gives a batch's parts and whole numbers for each place. Tasks add up what they read, so only sums are
    shuffled, and one number for each part and place reaches the driver.
    """

    def rows(held: dict[int, np.ndarray]) -> pa.RecordBatch:
        keys, sums = np.array(list(held), np.int64), np.array(list(held.values()), np.int64).reshape(-1, PLACES + 1)
        at, place = np.nonzero(sums)
        return pa.RecordBatch.from_arrays([pa.array(keys[at], pa.int64()), pa.array(place, pa.int64()), pa.array(sums[at, place], pa.int64())], names=["part", "place", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for x in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part, own = values(batch.slice(x, TEXTS_AT_ONCE))
                order = np.argsort(part, kind="stable")
                keys, starts, count = np.unique(part[order], return_index=True, return_counts=True)
                for k, n, total in zip(keys.tolist(), count, np.add.reduceat(own[order], starts, axis=0), strict=True):
                    now = held.setdefault(k, np.zeros(PLACES + 1, np.int64))
                    now[:PLACES] += total.astype(np.int64)
                    now[PLACES] += n
                if len(held) > MOST_SUMS:
                    yield rows(held)
                    held = {}
        yield rows(held)

    found = texts.select("lang", "places").mapInArrow(add, "part long, place long, n long").groupBy("part", "place").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((parts, PLACES + 1), np.int64)
    out[found.column("part").to_numpy(), found.column("place").to_numpy()] = found.column("n").to_numpy()
    return out[:, PLACES], out[:, :PLACES]


def fit_topics(texts: DataFrame, topics: int = TOPICS, rounds: int = 10) -> Topics:
    """Topics of all rows (h, lang, places): one for each distinct text that has words, h being its hash.

    Words say first of all which language a text is in, so texts are taken as directions from their language's mean.
    Frequencies, means and, in each round, centres are sums over every text. Rounds start from the texts with the
    smallest hashes and end early where no centre moves, so equal tables give equal topics. The driver and each task
    hold the model: a row of ``PLACES`` numbers for each topic and each language with at least ``LEAST_OF_LANG`` texts.
    """
    spark = texts.sparkSession

    def there(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        row, pairs = unpacked_places(batch.column("places"))
        own = np.zeros((batch.num_rows, PLACES), np.float32)
        own[row, pairs["place"]] = 1
        return np.zeros(batch.num_rows, np.int64), own

    count, found = summed(texts, 1, there)
    idf = (np.log((count[0] + 1) / (found[0] + 1)) + 0.1).astype(np.float32)
    often = texts.groupBy("lang").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_OF_LANG).select("lang").toArrow()
    langs = {v: k for k, v in enumerate(sorted(often.column("lang").to_pylist()), 1)}
    model = Topics(idf, langs, np.zeros((len(langs) + 1, PLACES), np.float32), np.zeros((1, PLACES), np.float32))

    def of_langs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        own = held.value
        return own.rows_of(batch.column("lang")), np.rint(weighed(batch.column("places"), own.idf) * np.float32(FINE))

    def of_topics(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        x = held.value.directions(batch.column("places"), batch.column("lang"))
        return held.value.nearest(x), x

    held = spark.sparkContext.broadcast(model)
    count, found = summed(texts, len(langs) + 1, of_langs)
    count[0], found[0] = count.sum(), found.sum(axis=0)
    model = replace(model, means=(found / np.maximum(count, 1)[:, None] / FINE).astype(np.float32))
    first = texts.orderBy("h").limit(topics).select("lang", "places").toArrow().combine_chunks()
    if not len(first):
        return model
    whole = lambda x: np.rint(units(x.astype(np.float64)) * (FINE // 2)).astype(np.float32)
    model = replace(model, centres=whole(model.directions(*(pa.concat_arrays(first.column(c).chunks) for c in ("places", "lang")))))
    for _ in range(rounds):
        held = spark.sparkContext.broadcast(model)
        count, found = summed(texts, len(model.centres), of_topics)
        centres = np.where(count[:, None] > 0, whole(found), model.centres)
        if (centres == model.centres).all():
            break
        model = replace(model, centres=centres)
    return model


def words_in(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\S+")).cast("long")


def described(docs: DataFrame, seed: int = SEED, without: tuple[str, ...] = ()) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the document's cell, its words and its place in the draw (0 to 1), and the names of these columns.

    A null source or language, and the topic of a text without words, is a value of its own, ``(none)``. The names are
    none of the table's own; keys are source, lang, topic, words and unit, and h and places for the text's hash and its
    hashed words. Rows are written with these, but for columns in ``without``, so texts are read once.
    """
    names = {k: unused(docs, f"_{k}") for k in (*DIMENSIONS, "words", "unit", "h", "places")}

    @F.arrow_udf("binary")
    def places(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [packed_places(p.column("text")) for p in text_slices(pa.RecordBatch.from_arrays([texts], names=["text"]))]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.binary())

    text = F.col("text").cast("string")
    own = lambda c: F.coalesce(c.cast("string"), F.lit("(none)"))
    unit = (F.xxhash64(F.lit(seed), F.col("doc_id"), text).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    values = {"source": own(F.col("source")), "lang": own(F.col("lang")), "words": words_in(text), "unit": unit, "h": F.xxhash64(text, own(F.col("lang"))), "places": places(text)}
    rows = stage(docs.withColumns({names[k]: c for k, c in values.items()}).drop(*without), "described")
    once = rows.where(F.col(names["words"]) > 0).select(*(F.col(names[k]).alias(k) for k in ("h", "lang", "places"))).dropDuplicates(["h"])
    held = docs.sparkSession.sparkContext.broadcast(fit_topics(stage(once, "topic-texts")))

    @F.arrow_udf("string")
    def topic(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for found, langs in batches:
            yield pa.array(held.value.of(found, langs), pa.string())

    return rows.withColumn(names["topic"], own(topic(F.col(names["places"]), F.col(names["lang"])))), names


def cell_totals(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rows (cell, words, documents) of a described table."""
    cells = rows.select(*(F.col(names[d]).alias(c) for d, c in zip(DIMENSIONS, CELL, strict=True)), F.col(names["words"]).alias("w"))
    return stage(cells.groupBy(*CELL).agg(F.sum("w").alias("words"), F.count("*").alias("documents")), "cells")


def marginals(cells: DataFrame) -> DataFrame:
    """Rows (dimension, value, words) of the values that have words."""
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("dimension"), F.col(c).alias("value"), F.col("words").alias("w")) for c in CELL))).alias("m")
    return cells.where("words > 0").select(each).groupBy("m.dimension", "m.value").agg(F.sum("m.w").alias("words"))


def flat_targets(cells: DataFrame, even: float = EVEN) -> DataFrame:
    """Rows (dimension, value, share): the shares of words in each dimension, made more even.

    The commonest value keeps its words and rarer ones gain, the rarest up to (1 + even) / even times, so that one rare
    value doesn't press down the probabilities of all others. Shares are in proportion; raking scales them.
    """
    own = marginals(cells)
    most = own.groupBy("dimension").agg(F.max("words").alias("most"))
    return own.join(most, "dimension").select("dimension", "value", (F.col("words") * (1 + even) / (F.col("words") / F.col("most") + even)).alias("share"))


def raked_here(found: pa.Table, shares: dict[str, dict[str, float]], tolerance: float, rounds: int) -> tuple[np.ndarray, bool]:
    """Weights of cells with words after raking to the shares of each dimension, and whether they met these."""
    words = found.column("words").to_numpy().astype(float)
    weight = words / max(words.sum(), 1.0)
    places = []
    for c, own in shares.items():
        coded = found.column(c).combine_chunks().dictionary_encode()
        places.append((coded.indices.to_numpy(zero_copy_only=False), np.array([own.get(v, 0.0) for v in coded.dictionary.to_pylist()])))
    for done in range(1, rounds + 1):
        off = 0.0
        for at, share in places:
            sums = np.bincount(at, weight, len(share))
            off = max(off, float(np.abs(share - sums)[(sums > 0) & (share > 0)].max(initial=0.0)))
            weight = weight * np.divide(share, sums, out=np.zeros_like(share), where=sums > 0)[at]
        if off <= tolerance and (done % ROUNDS_AT_ONCE == 0 or done == rounds):
            return weight, True
    return weight, False


def rake(cells: DataFrame, targets: DataFrame, tolerance: float = TOLERANCE, rounds: int = MOST_ROUNDS, most_here: int = MOST_CELLS_HERE) -> DataFrame:
    """Cells with ``ratio``, raked weight over the cell's share of words, and ``converged``.

    ``targets`` has rows (dimension, value, share); dimensions are columns of ``cells``. Values without words are left
    out and the other shares of the dimension scaled to 1; values without a target weigh 0, and dimensions without any
    are not raked. Rounds end when no marginal was off by more than ``tolerance``; targets that contradict each other (no
    weights fit them all) end after ``rounds`` with the last fit and ``converged`` false.

    The cells are one row for each combination that occurs, far fewer than the documents; sums are made before shuffles.
    Up to ``most_here`` cells (about 100 bytes each) are raked by the driver in one go, more of them by joins, a few
    rounds a job; both take the same steps.
    """
    total = cells.agg(F.sum("words")).first()[0] or 0
    wanted = targets.join(marginals(cells), ["dimension", "value"], "left_semi")
    wholes = {r.dimension: r.whole for r in wanted.groupBy("dimension").agg(F.sum("share").alias("whole")).collect()}
    count = cells.where("words > 0").count()
    if wholes and total and count <= most_here:
        shares: dict[str, dict[str, float]] = {c: {} for c in wholes}
        for r in wanted.collect():
            shares[r.dimension][r.value] = r.share / wholes[r.dimension]
        found = cells.where("words > 0").toArrow()
        weight, converged = raked_here(found, shares, tolerance, rounds)
        there = weight > 0
        out = found.filter(pa.array(there)).append_column("weight", pa.array(weight[there]))
        out = out.append_column("ratio", pa.array(weight[there] * float(total) / out.column("words").to_numpy()))
        out = out.append_column("converged", pa.array(np.full(len(out), converged)))
        schema = ", ".join([*(f"`{c}` {t}" for c, t in cells.dtypes), "weight double", "ratio double", "converged boolean"])
        return cells.sparkSession.createDataFrame(out, schema)
    now = cells.where("words > 0").withColumn("weight", F.col("words") / F.lit(float(max(total, 1))))
    for c, whole in wholes.items():
        own = wanted.where(F.col("dimension") == c).select(F.col("value").alias(c), (F.col("share") / whole).alias(f"{c}_share"))
        now = now.join(own, c, "left").fillna(0.0, [f"{c}_share"])
    now = stage(now.withColumn("off", F.lit(0.0)), "raked")
    columns, converged = now.columns, not wholes or not total
    for done in range(0, 0 if converged else rounds, ROUNDS_AT_ONCE):
        for k in range(min(ROUNDS_AT_ONCE, rounds - done)):
            now = now.withColumn("off", F.lit(0.0))
            for c in wholes:
                sums = now.groupBy(c).agg(F.sum("weight").alias("_sum"))
                share = F.col(f"{c}_share")
                now = now.join(sums, c).withColumns({"weight": F.col("weight") * share / F.col("_sum"), "off": F.greatest("off", F.abs(share - F.col("_sum")))}).where("weight > 0").select(*columns)
            now = stage(now, "raked")
        if (now.agg(F.max("off")).first()[0] or 0.0) <= tolerance:
            converged = True
            break
    return now.select(*cells.columns, "weight", (F.col("weight") * float(total) / F.col("words")).alias("ratio"), F.lit(converged).alias("converged"))


def probabilities(cells: DataFrame, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """Rows (cell, ratio, probability, converged); the largest probability is 1.

    ``targets`` may give rows (value, share) for ``source``, ``lang`` or ``topic``; others are made more even.
    """
    given = [t.select(F.lit(f"_{d}").alias("dimension"), F.col("value").cast("string").alias("value"), F.col("share").cast("double").alias("share")) for d, t in (targets or {}).items()]
    rest = flat_targets(cells).where(~F.col("dimension").isin(*(f"_{d}" for d in targets or {})))
    raked = rake(cells, reduce(DataFrame.unionByName, given, rest))
    most = raked.agg(F.max("ratio")).first()[0] or 1.0
    return stage(raked.select(*CELL, "ratio", (F.col("ratio") / F.lit(float(most))).alias("probability"), "converged"), "probabilities")


def draw(rows: DataFrame, names: dict[str, str], targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """A described table with a struct ``names["draw"]`` of ratio, probability, sampled and converged.

    Documents without words have ratio and probability 0 and are not drawn.
    """
    names["draw"] = unused(rows, "_draw")
    chances = probabilities(cell_totals(rows, names), targets)
    mine = chances.select(*(F.col(c).alias(names[d]) for d, c in zip(DIMENSIONS, CELL, strict=True)), F.struct("ratio", "probability", "converged").alias(names["draw"]))
    there = F.col(names["words"]) > 0
    value = lambda k: F.when(there, F.coalesce(F.col(names["draw"])[k], F.lit(0.0))).otherwise(0.0)
    joined = rows.join(mine, [names[d] for d in DIMENSIONS], "left")
    out = F.struct(value("ratio").alias("ratio"), value("probability").alias("probability"), (F.col(names["unit"]) < value("probability")).alias("sampled"), F.coalesce(F.col(names["draw"])["converged"], F.lit(True)).alias("converged"))
    return joined.withColumn(names["draw"], out)


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, seed: int = SEED) -> DataFrame:
    """Rows doc_id, source, lang, topic, ratio, probability, sampled, converged: one for each document.

    Nulls in source or lang are a value of their own, shown as ``(none)``. Rows that repeat in full are drawn alike.
    Documents in cells of equal weight have equal probabilities; their hashes decide, so there are no ties. Other
    columns are ignored.
    """
    rows, names = described(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "source", "lang"), seed, ("text",))
    drawn = draw(rows, names, targets)
    return drawn.select("doc_id", *(F.col(names[d]).alias(d) for d in DIMENSIONS), F.col(names["draw"])["ratio"].alias("ratio"), *(F.col(names["draw"])[k].alias(k) for k in ("probability", "sampled", "converged")))


def sampled_documents(docs: DataFrame, targets: dict[str, DataFrame] | None = None, seed: int = SEED) -> DataFrame:
    """The documents that are drawn, with their own columns, whatever these are called."""
    rows, names = described(docs, seed)
    drawn = draw(rows, names, targets)
    return drawn.where(F.col(names["draw"])["sampled"]).select(*docs.columns)
