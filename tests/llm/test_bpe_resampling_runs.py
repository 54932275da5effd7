"""Byte-level BPE against its library, resampling and periodic runs against plain versions."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__
from tidemark.llm import bpe, resampling, runs

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, key string, ids int, rank int, runs int, decoded int, _run int, _at int, _segment int, collapsed int"
LONG = "it's " * 200_000
ODD = [None, "", " ", "\n \n", "a", "'s", "x's's ''ve  I'll\n'd", "é’s 中文12３ ½　 x  \n\n  y", "<|endoftext|> 😀😀", "a b " * 300, LONG, "loop de " * 3]


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "k", 1, 2, 3, 4, 5, 6, 7, 8) for i, t in zip(ids, texts, strict=True)], SCHEMA)


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


# Operator 11


@pytest.fixture(scope="module")
def library():
    with open(bpe.default_ranks(), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def assert_same(library, texts):
    ids, count = bpe.codec(bpe.default_ranks()).encode(pa.array(texts, pa.string()))
    assert [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])] == library.encode_ordinary_batch([t or "" for t in texts])


@given(st.lists(st.text(alphabet=st.sampled_from("abst'redvlm19.,\n\t\x85 　 é中’²_😀"), max_size=30), min_size=1, max_size=8))
@settings(max_examples=400, deadline=None)
def test_bpe_equals_library(library, texts):
    assert_same(library, texts)


@given(st.lists(st.text(max_size=20), min_size=1, max_size=8))
@settings(max_examples=200, deadline=None)
def test_bpe_equals_library_on_any_text(library, texts):
    assert_same(library, texts)


def test_bpe_knows_every_code_point_and_long_slices(library):
    points = [chr(c) for c in (*range(0x3400), *range(0xA000, 0xAC00), *range(0xF900, 0x12600), *range(0x16800, 0x20000), *range(0x3401, 0x110000, 97)) if not 0xD800 <= c < 0xE000]
    assert_same(library, [x for c in points for x in (f"a{c}a", f"1{c} {c}.")])
    rng = random.Random(5)
    assert_same(library, ["a" * 30_000, " " * 5_000 + "x", "'s'" * 3_000, "".join(rng.choice("abcdefgh") for _ in range(30_000))])


def test_bpe_forgets_and_stays_right(library, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_SLICES", 3)
    own = bpe.Codec(bpe.default_ranks())
    for text in ("one two three four five", "six seven one two", "one"):
        assert own.encode(pa.array([text]))[0].tolist() == library.encode_ordinary(text)
        assert len(own.known) <= 8


def test_scan_of_functions_equals_a_walk():
    rng = np.random.default_rng(2)
    for n in (0, 1, 255, 256, 257, 5_000):
        symbol = rng.integers(0, 16, n).astype(np.uint8)
        state, want = bpe.AFTER, []
        for s in symbol:
            want.append(state)
            state = bpe.NEXT[s, state]
        assert bpe.states_before(symbol).tolist() == want


def test_bpe_query_and_round_trip(spark, library, tmp_path):
    ids = [*range(len(ODD) - 2), 3, None]  # an id twice, and none
    frame(spark, ODD, ids).write.parquet(str(tmp_path / "documents.parquet"))
    got = __spark_entry__.queries()["op11_byte_level_bpe"](spark, str(tmp_path)).collect()
    want = []
    for i, text in zip(ids, ODD, strict=True):
        own = library.encode_ordinary(text or "")
        want.append((i, len(own), sha(" ".join(map(str, own))), sha(text or "")))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    rows = bpe.encode(frame(spark, ODD, ids)).collect()
    for r, text in zip(rows, ODD, strict=True):
        raw = (text or "").encode()
        assert b"".join(library.decode_single_token_bytes(t) for t in r.ids) == raw
        assert r.byte_ends == np.cumsum([len(library.decode_single_token_bytes(t)) for t in r.ids]).tolist()
    assert bpe.encode(frame(spark, [])).collect() == [] and bpe.codec_digest(frame(spark, [])).collect() == []


def test_spans_of_tokens_keep_their_place(spark, library):
    text = "one 中文 two's"
    tokens = [library.decode_single_token_bytes(t) for t in library.encode_ordinary(text)]
    encoded = bpe.encode(frame(spark, [text, "", None]))
    for first, last in ((0, 2), (2, 5), (1, 1), (3, 99), (50, 60)):
        a, *blank = bpe.token_span(encoded, first, last).orderBy("key").collect()
        assert bytes(a.decoded) == b"".join(tokens[first:last]) and a.start == len(b"".join(tokens[:first]))
        assert [(r.start, bytes(r.decoded)) for r in blank] == [(0, b"")] * 2


def test_unknown_ids_are_errors(spark):
    for ids in ([1, 60_000], [-1], [None]):
        with pytest.raises(Exception, match="an id is"):
            bpe.decode(spark.createDataFrame([(1, ids)], "key long, ids array<int>")).collect()
    assert [bytes(r.decoded) for r in bpe.decode(spark.createDataFrame([(1, None), (2, [])], "key long, ids array<int>")).collect()] == [b"", b""]


# Operator 12


def plain_features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def plain_resample(docs, target):
    """Rows (doc_id, n_features, weight, score, rank) of pairs (doc_id, text)."""
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = Counter(), Counter()
    for total, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            total.update(map(bucket, plain_features(text)[1]))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10_000) / ((s[b] + 1) * (t.total() + 10_000)))) for b in range(10_000)]
    rows, able = [], []
    for i, text in docs:
        words, own = plain_features(text)
        weight = sum(gain[bucket(f)] for f in own) // len(own) if own else 0
        h = int(sha(f"7:{'' if i is None else i}")[:8], 16)
        rows.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        if len(words) >= 20:
            able.append(rows[-1])
    able.sort(key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1], r[2]))
    for k, row in enumerate(able[: 25 * len(able) // 100], 1):
        row[4] = k
    return sorted(map(str, rows))


def test_crc_of_pairs_is_put_together():
    rng = np.random.default_rng(1)
    left = [rng.bytes(int(k)) for k in rng.integers(0, 50, 3_000)]
    for most in (40, 2_000):
        right = [rng.bytes(int(k)) for k in rng.integers(0, most, 3_000)]
        crc = [np.array([zlib.crc32(x) for x in side], np.uint32) for side in (left, right)]
        got = resampling.shifted(crc[0], np.array(list(map(len, right)))) ^ crc[1]
        assert got.tolist() == [zlib.crc32(a + b) for a, b in zip(left, right, strict=True)]


@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from("aAzZ09 .\x00\x7f\x80é中_'`{"), max_size=25)), max_size=6))
@settings(max_examples=200, deadline=None)
def test_features_equal_plain(texts):
    one, two, count, pairs = resampling.features(pa.array(texts, pa.string()))
    a, b = np.concatenate([[0], np.cumsum(count)]), np.concatenate([[0], np.cumsum(pairs)])
    for k, text in enumerate(texts):
        words, every = plain_features(text)
        assert [*one[a[k] : a[k + 1]].tolist(), *two[b[k] : b[k + 1]].tolist()] == [zlib.crc32(f.encode()) % 10_000 for f in every]
        assert count[k] == len(words)


def test_resampling_of_all_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = __spark_entry__.queries()["op12_target_resampling"](spark, SF).collect()
    assert sorted(str(list(r)) for r in got) == plain_resample(docs, target)


def test_resampling_of_odd_documents(spark):
    texts = [*ODD, *[" ".join(f"w{k % 7} x{j}" for j in range(k % 40)) for k in range(200)], *["same text " * 12] * 30]
    ids = [None if k % 50 == 0 else k % 150 for k in range(len(texts))]
    target = frame(spark, ["w1 x2 W3 x4 loop", None])
    got = resampling.resample(frame(spark, texts, ids), target).collect()
    assert sorted(str(list(r)) for r in got) == plain_resample(list(zip(ids, texts, strict=True)), ["w1 x2 W3 x4 loop", None])
    assert resampling.resample(frame(spark, []), target).collect() == []
    assert len(resampling.resample(frame(spark, texts, ids), frame(spark, [])).collect()) == len(texts)


@pytest.mark.parametrize(("most", "segments"), [(200_000, 16), (100, 16), (100, None), (200_000, 1)])
def test_regular_sampling_ranks_exactly(spark, monkeypatch, most, segments):
    monkeypatch.setattr(resampling, "MOST_SAMPLES", most)
    monkeypatch.setattr(resampling, "SAMPLE_SEGMENT", 50)
    rng = random.Random(4)
    rows = [(rng.choice([5, 5, 5, rng.randrange(-999, 999)]), rng.randrange(50), 1, k) for k in range(3_000)]  # two thirds share a key
    df = spark.createDataFrame(rows, "a long, b long, _run int, rank_of long").repartition(7)
    got = resampling.ranks(df, ["a", "b"], segments=segments).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 3_001)) and sorted(r.rank_of for r in got) == list(range(3_000))
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r["rank"])] == sorted((a, b) for a, b, *_ in rows)
    assert resampling.ranks(df.limit(0), ["a"], segments=segments).collect() == []


def test_no_segment_gets_over_twice_its_share(spark, monkeypatch):
    kept = []
    real = resampling.stage
    monkeypatch.setattr(resampling, "stage", lambda df, name: kept.append(real(df, name)) or kept[-1])
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * 7919 % 20_011).alias("a")).repartition(8)
    assert resampling.ranks(df, ["a"], segments=8).count() == 20_000
    sizes = [r["count"] for r in kept[-1].groupBy("_segment").count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * 20_000 / 8


# Operator 13


def plain_runs(w):
    """All runs (start, length, period) of a list of words, by trying every period."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            if j > i and n >= max(6, 4 * q) and not any(w[i : i + n - p] == w[i + p : i + n] for p in range(1, q)):
                out.append((i, n, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


@given(st.lists(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 50)), max_size=4), min_size=1, max_size=4))
@settings(max_examples=300, deadline=None)
def test_runs_equal_plain(texts):
    words = [[x for pattern, n in text for x in (pattern * 50)[:n]] for text in texts]
    doc, start, length, period = runs.runs_of(np.array([x for w in words for x in w], np.int64), np.array(list(map(len, words))))
    for k, w in enumerate(words):
        own = doc == k
        assert list(zip(start[own].tolist(), length[own].tolist(), period[own].tolist(), strict=True)) == plain_runs(w)


def plain_digest(i, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if i is not None and n:
        g, rest = divmod(zlib.crc32(str(i).encode()), 10)
        if rest == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    found = plain_runs(w)
    dropped = {k for a, m, q in found for k in range(a + q, a + m)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return str((i, len(found), *top, sha("".join(f"{a},{m},{q}\n" for a, m, q in found)), sha(" ".join(x for k, x in enumerate(w) if k not in dropped))))


def test_run_query_over_all_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = __spark_entry__.queries()["op13_periodic_runs"](spark, SF).collect()
    short = {r.doc_id: r.text for r in docs if len(r.text or "") < 6_000}
    assert len(got) == len(docs) and len(short) > 0.9 * len(docs)
    assert sorted(str(tuple(r)) for r in got if r.doc_id in short) == sorted(plain_digest(i, t) for i, t in short.items())


def test_runs_of_odd_documents(spark, tmp_path):
    texts = [*[t for t in ODD if t != LONG], *["x y z " * 4, "\x0ba\x0ba \xa0 a a a a", "q " * 900]]
    ids = [None, 3, 3, *range(3, len(texts))]
    frame(spark, texts, ids).write.parquet(str(tmp_path / "documents.parquet"))
    got = __spark_entry__.queries()["op13_periodic_runs"](spark, str(tmp_path)).collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(plain_digest(i, t) for i, t in zip(ids, texts, strict=True))
    (long,) = runs.periodic_runs(frame(spark, [LONG])).collect()
    assert [tuple(r) for r in long.runs] == [(0, 200_000, 1)] and long.collapsed == "it's" and long.n_words == 200_000
    assert runs.periodic_runs(frame(spark, [])).collect() == [] and runs.run_digest(frame(spark, [])).collect() == []


def test_looped_texts_hold_the_loop(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    texts = [" ".join(f"w{k}" for k in range(i % 37)) for i in ids]
    got = runs.run_digest(frame(spark, texts, ids).withColumn("text", runs.looped(F.col("text"), F.col("doc_id")))).collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(plain_digest(i, t) for i, t in zip(ids, texts, strict=True))
    assert any(r.n_runs for r in got)
