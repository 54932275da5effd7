"""Operator 13: periodic runs of words, by a dictionary of basic factors.

Factors of 1, 2, 4, 8... words get numbers by pairing the numbers of their halves, so equal factors of one text have equal
numbers. A run of period q repeats its factors at distance q: where a factor's next occurrence, and that one's next, lie
at one distance of at most twice the factor's length, these occurrences are an arithmetic progression that proposes the
distance as a period. A proposal is extended both ways by comparing ever shorter factors, and proposals of one run
are the same after that. Factors that occur once in a text can't lie at a repeat, so only positions whose halves both
repeat go to the next length: plain prose is done after two or three.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import filled, segment_sum, text_slices, words_of

#: A run has at least so many words, and so many times its period.
LEAST_WORDS, LEAST_TIMES = 6, 4
RUN = "array<struct<start:long,length:long,period:long>>"


def basic_factors(codes: np.ndarray, doc: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For lengths 1, 2, 4...: the number of the factor at each place, -1 where it occurs once in its text or doesn't fit,
    and how far on it occurs next, 0 where it doesn't.

    Numbers of different texts differ, so no factor crosses a text's end. Ends after ``longest``, or where none repeats.
    """
    n, size = len(codes), 1
    place = np.arange(n)
    key = doc * (int(codes.max()) + 1 if n else 1) + codes
    while len(place):
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        number = np.empty(len(key), np.int64)
        number[order] = np.cumsum(np.concatenate([[False], ~same]))
        again = np.zeros(len(key), bool)
        again[order[1:]] |= same
        again[order[:-1]] |= same
        ids, far = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        ids[place[again]] = number[again]
        earlier, later = place[order[:-1][same]], place[order[1:][same]]
        far[earlier] = later - earlier
        yield ids, far
        if 2 * size > longest:
            return
        here = place[again]
        here = here[here + size < n]
        place = here[ids[here + size] >= 0]
        key = ids[place] * (len(key) + 1) + ids[place + size]
        size *= 2


def common(levels: list[np.ndarray], x: np.ndarray, y: np.ndarray, back: bool) -> np.ndarray:
    """How many words are equal from x and y on, or before x and y with ``back``, within one text."""
    n, reach = len(levels[0]), np.zeros(len(x), np.int64)
    for k in reversed(range(len(levels))):
        size, ids = 1 << k, levels[k]
        live = np.arange(len(x))
        while len(live):  # the longest factors may fit more than once, others once at most
            step = -reach[live] - size if back else reach[live]
            a, b = x[live] + step, y[live] + step
            inside = (a >= 0) & (b < n)
            live, a, b = live[inside], a[inside], b[inside]
            equal = (ids[a] >= 0) & (ids[a] == ids[b])
            live = live[equal]
            reach[live] += size
    return reach


def runs_of(codes: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All runs of all texts on end, by text, start, period: text, start (in its text), length, period."""
    doc = np.repeat(np.arange(len(count)), count)
    levels, found = [], []
    longest = 1 << max(int(count.max(initial=0)) // LEAST_TIMES - 1, 0).bit_length()  # at least the longest period there can be
    for k, (ids, far) in enumerate(basic_factors(codes, doc, longest)):
        levels.append(ids)
        at = np.flatnonzero((far > 0) & (far <= 2 << k))
        at = at[far[at] == far[at + far[at]]]  # three occurrences at one distance
        first = np.ones(len(at), bool)
        first[1:] = (at[1:] != at[:-1] + 1) | (far[at[1:]] != far[at[:-1]])
        found.append((at[first], far[at[first]]))
    at, period = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in (0, 1))
    before = common(levels, at, at + period, True) if len(at) else at
    length = before + period + (common(levels, at, at + period, False) if len(at) else at)
    start = at - before
    good = length >= np.maximum(LEAST_WORDS, LEAST_TIMES * period)
    rows = np.unique(np.stack([start[good], length[good], period[good]], axis=1), axis=0)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    once = np.ones(len(rows), bool)
    once[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)  # of periods of one stretch the smallest
    start, length, period = rows[once].T
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    text = doc[start]
    return text, start - (np.cumsum(count) - count)[text], length, period


def repeats(start: np.ndarray, length: np.ndarray, period: np.ndarray, n: int) -> np.ndarray:
    """Marks the words that lie in a run after its first ``period`` words."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    return np.cumsum(edge[:-1]) > 0


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows doc_id, n_words, runs, collapsed: the runs of each whole text by start and period, and the text without repeats.

    Words are what stands between ASCII white space, numbered from 0. A run is a stretch with smallest period q, of at
    least ``LEAST_WORDS`` words and ``LEAST_TIMES`` periods, that no neighbouring word extends. ``collapsed`` joins by one
    space the words that lie in no run after its first period. Runs that share words are all reported. A null or empty
    text has no words and no runs; a null key stays null; rows that repeat are searched each; other columns are ignored.
    One pass without a shuffle; a task holds about 2 MB of text, or one longer text.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                codes, words, count = words_of(filled(part.column("text")))
                doc, start, length, period = runs_of(codes, count)
                own = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(count)))]).astype(np.int32)
                runs = pa.ListArray.from_arrays(pa.array(own), pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], names=["start", "length", "period"]))
                kept = ~repeats(start + (np.cumsum(count) - count)[doc], length, period, len(codes))
                ends = np.concatenate([[0], np.cumsum(segment_sum(kept.astype(np.int64), count))]).astype(np.int32)
                left = pa.ListArray.from_arrays(pa.array(ends), words.cast(pa.string()).take(pa.array(codes[kept])))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(count), runs, pc.binary_join(left, " ")], names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(search, f"doc_id long, n_words long, runs {RUN}, collapsed string")


def looped(text: Column, key: Column) -> Column:
    """The text of every tenth key with the words from some place on replaced by a loop of the first few of them; others
    as they are.

    With h the crc32 of the key as text and g = h // 10, keys with h % 10 = 0 are looped: each word i from a on becomes
    word a + (i - a) % p, where a = g % n and p = 1 + (n - a) // (3 + g % 8) for n words.
    """
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10)
    n = F.size(words)

    def of(w: Column, g: Column) -> Column:
        a = (g % F.size(w)).cast("int")
        p = (1 + F.floor((F.size(w) - a) / (3 + g % 8))).cast("int")
        return F.array_join(F.concat(F.slice(w, F.lit(1), a), F.transform(F.sequence(a, F.size(w) - 1), lambda i: F.get(w, a + (i - a) % p))), " ")

    whole = F.get(F.transform(F.array(F.struct(words.alias("w"), g.alias("g"))), lambda x: of(x["w"], x["g"])), F.lit(0))
    return F.when((h % 10 == 0) & (n > 0), whole).otherwise(text)


def run_digest(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_runs, the longest run (start, length, period, exponent_milli), and hashes of all runs and
    of the collapsed text."""
    found = periodic_runs(docs)
    best = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("a"), r["start"].alias("b"), r["period"].alias("c")))), 1)
    best = F.when(F.size("runs") > 0, best)
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    out = found.withColumn("best", best).select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.b").alias("start"), (-F.col("best.a")).alias("length"), F.col("best.c").alias("period"), lines.alias("lines"), "collapsed")
    return out.select("doc_id", "n_runs", "start", "length", "period", F.floor(F.col("length") * 1000 / F.col("period")).alias("exponent_milli"), F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.coalesce("collapsed", F.lit("")).cast("binary"), 256).alias("collapsed_sha256"))
