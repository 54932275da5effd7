"""Operator 6: quality rules on repetition, from rolling hashes of word n-grams in numpy.

Words are runs of characters other than ASCII white space. A document fails the base rules when it has under 50 words or
over half of its words stand in three-word windows found twice or more. The method measures the characters of words
inside n-grams of several lengths, and of lines, that stood earlier in the text, and holds each share against a bound.
What is said a second time counts, and what is said first does not: a header that ends a page too is no fault.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import filled, hashed, mixed, segment_sum, text_slices, words_of

MIN_WORDS = 50
#: n-gram length: largest share of word characters that may stand inside n-grams that were there before.
NGRAM_BOUNDS = {5: 0.25, 7: 0.22, 10: 0.20}
LINE_BOUND = 0.30
SYMBOLS = "[#*$%&|<>]"
BASE = np.uint64(0x9E3779B97F4A7C15)
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
COVERED = [f"later_{n}gram_chars" for n in NGRAM_BOUNDS] + ["later_line_chars"]
SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, " + ", ".join(f"{c} long" for c in COVERED) + ", kept boolean"


def repeated(key: np.ndarray, doc: np.ndarray, first: bool) -> np.ndarray:
    """Marks positions whose key is found earlier in the same document, and with ``first`` the earliest one too.

    ``doc`` ascends.
    """
    order = np.argsort(key, kind="stable")  # equal keys stay in the order of their places
    k, d = key[order], doc[order]
    same = (k[1:] == k[:-1]) & (d[1:] == d[:-1])
    mark = np.zeros(len(key), bool)
    mark[order[1:]] |= same
    if first:
        mark[order[:-1]] |= same
    return mark


def covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Marks the words of all n-grams that begin at the given positions."""
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + n, -1)
    return np.cumsum(edge[:-1]) > 0


def triples(codes: np.ndarray, distinct: int) -> np.ndarray:
    """A number for each window of three words, equal only for equal windows."""
    c = codes.astype(np.uint64)
    if distinct < 1 << 21:
        return (c[:-2] << np.uint64(42)) | (c[1:-1] << np.uint64(21)) | c[2:]
    pairs = np.unique((c[:-2] << np.uint64(32)) | c[1:-1], return_inverse=True)[1].astype(np.uint64)
    return (pairs << np.uint64(32)) | c[2:]


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """All counts of each text; every array has one value per text."""
    texts = filled(texts)
    rows = len(texts)
    codes, words, count = words_of(texts)
    doc = np.repeat(np.arange(rows), count)
    width = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)[codes]
    signs = pc.count_substring_regex(words, SYMBOLS).to_numpy(zero_copy_only=False).astype(np.int64)[codes]
    out = {"n_words": count, "word_chars": segment_sum(width, count), "n_symbols": segment_sum(signs, count)}

    def inside(key: np.ndarray, n: int, first: bool) -> np.ndarray:
        whole = np.flatnonzero(doc[: len(key)] == doc[n - 1 :]) if len(key) else np.zeros(0, np.int64)
        return covered(whole[repeated(key[whole], doc[whole], first)], n, len(codes))

    out["n_repeat_words"] = segment_sum(inside(triples(codes, len(words)), 3, True).astype(np.int64), count) if len(codes) > 2 else np.zeros(rows, np.int64)
    word = mixed(hashed(words))[codes]
    rolling = word
    for n in range(2, max(NGRAM_BOUNDS) + 1):
        with np.errstate(over="ignore"):
            rolling = rolling[:-1] * BASE + word[n - 1 :] if len(rolling) else rolling
        if n in NGRAM_BOUNDS:
            out[f"later_{n}gram_chars"] = segment_sum(np.where(inside(rolling, n, False), width, 0), count) if len(rolling) else np.zeros(rows, np.int64)

    lists = pc.split_pattern(texts, "\n")
    lines = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    line = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    real = pc.match_substring_regex(coded.dictionary, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)[line]
    chars = pc.utf8_length(coded.dictionary).to_numpy(zero_copy_only=False).astype(np.int64)[line]
    at = np.repeat(np.arange(rows), lines)
    seen = np.flatnonzero(real)
    later = np.zeros(len(line), bool)
    later[seen] = repeated(line[seen], at[seen], False)
    out["n_dup_lines"] = segment_sum(later.astype(np.int64), lines)
    out["later_line_chars"] = segment_sum(np.where(later, chars, 0), lines)
    out["line_chars"] = segment_sum(np.where(real, chars, 0), lines)
    return out


def judged(out: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    failed = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > 50 * out["n_words"])
    kept = ~failed & (out["later_line_chars"] <= LINE_BOUND * out["line_chars"])
    for n, bound in NGRAM_BOUNDS.items():
        kept &= out[f"later_{n}gram_chars"] <= bound * out["word_chars"]
    return out | {"base_failed": failed, "kept": kept}


def repetition_rules(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with counts, characters covered by repeats, base_failed and kept.

    A null text has no words and fails; a null key stays null; rows that repeat are judged each; other columns are
    ignored. Each row is judged by itself in one pass, without a shuffle.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                out = judged(measure(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(out[c]) for c in [*COUNTS, "base_failed", *COVERED, "kept"])], names=["doc_id", *COUNTS, "base_failed", *COVERED, "kept"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(judge, SCHEMA)
