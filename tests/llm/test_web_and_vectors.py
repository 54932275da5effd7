"""Vector, page, URL, mixture and pipeline operators against plain versions on small fixtures with odd rows."""

import base64
import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
from tests.llm.test_documents import BASE, plain_groups
from tidemark.llm import components, mixing, secrets, urls, vectors, warc
from tidemark.llm.tokens import default_tokenizer

SF = "/root/testdata/sf0.001"


# Operator 3


def plain_links(rows, cosine=0.98):
    sound = [i for i, (_, v, label) in enumerate(rows) if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    root, n = list(range(len(rows))), [0] * len(rows)

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sound:
        for j in sound:
            a, b = np.float64(rows[i][1]), np.float64(rows[j][1])
            a, b = a / np.abs(a).max(), b / np.abs(b).max()
            if i != j and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine:
                n[i] += 1
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, (key, *_) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), key), key)
    return sorted((rows[i][0], n[i], least[top(i)], rows[i][0] == least[top(i)]) for i in range(len(rows)))


VECTORS = "vec_id long, embedding array<float>, label int, extra string"


def vector_frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], VECTORS)


def test_vectors_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0, 0.0], 1), (2, [2.0, 0.0, 0.0], 1), (3, [1.0, 0.0, 0.0], 1), (4, [1.0, 0.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0, 0.0], 1), (7, [nan, 1.0, 0.0], 1), (8, [inf, 1.0, 0.0], 1), (9, [1.0, None, 0.0], 1), (10, [1.0, 0.1, 0.0], 1), (11, [1.0, 0.0], 1), (12, [], 1), (13, [5.0], 1), (14, [3.0], 1), (15, [1.0, 0.0, 0.0], 2)]
    got = sorted(tuple(r) for r in vectors.near_vectors(vector_frame(spark, rows)).collect())
    assert got == plain_links(rows)
    assert vectors.near_vectors(vector_frame(spark, [])).collect() == []


def test_vectors_of_any_scale_and_length(spark):
    """Double precision, components whose squares vanish or overflow, and lengths that the sample of two doesn't hold."""
    rng = np.random.default_rng(3)
    rows = [(1, [1.0, 0.0], 1), (2, [1e-60, 0.0], 1), (3, [1e300, 0.0], 1), (4, [1e-200, 1e-200], 1), (5, [0.0, 1.0], 1), (6, [1.0, 1.0000000001], 1)]
    for k in range(20):
        v = rng.normal(size=3 + k % 5)
        rows += [(10 + 3 * k, v.tolist(), 1), (11 + 3 * k, (v * 2).tolist(), 1), (12 + 3 * k, (v + 0.3 * rng.normal(size=len(v))).tolist(), 1)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, node string")
    got = sorted(tuple(r) for r in vectors.near_vectors(table, sample=2).collect())
    assert got == plain_links(rows)


def test_small_tables_have_a_real_grid(spark):
    """Cells that vectors lie in, and the share of all pairs that visits compare, on the 500 vectors of a small table."""
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").where("embedding is not null")
    x = vectors.unit(np.array([r.embedding for r in table.collect()]).ravel(), 64)
    left, right = (vectors.codebook(h, vectors.LEAST_WORDS) for h in (x[:, :32], x[:, 32:]))
    (n1, b1), (n2, b2) = vectors.bounds(x[:, :32], left), vectors.bounds(x[:, 32:], right)
    home = n1 * len(right) + n2
    assert len(np.unique(home)) > 8
    visited = np.zeros((len(x), len(left) * len(right)), bool)
    for q, a, b in vectors.multi_sequence(b1, b2, np.sqrt(2 - 2 * vectors.COSINE)):
        visited[q, a * len(right) + b] = True
    assert visited[np.arange(len(x)), home].all() and visited[:, home].mean() < 0.8


def test_traversal_visits_nearest_cells_first():
    rng = np.random.default_rng(9)
    left, right = rng.random((30, 7)), rng.random((30, 5))
    left[:, 0] = right[:, 3] = 0
    met = {q: [] for q in range(30)}
    for q, a, b in vectors.multi_sequence(left, right, 0.9):
        for x, y, z in zip(q, a, b, strict=True):
            met[x].append((np.square(left[x, y]) + np.square(right[x, z]), y, z))
    for q, cells in met.items():
        want = {(y, z) for y in range(7) for z in range(5) if np.square(left[q, y]) + np.square(right[q, z]) <= 0.81}
        assert [c[0] for c in cells] == sorted(c[0] for c in cells) and {c[1:] for c in cells} == want and len(cells) == len(want)


def test_recall_below_one_is_met(spark):
    """Against brute force on vectors with many near ones."""
    rng = np.random.default_rng(12)
    base = rng.normal(size=(60, 32))
    x = (base[:, None] + 0.12 * rng.normal(size=(60, 12, 32))).reshape(-1, 32)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    want, got = (sum(r[1] for r in out) for out in (plain_links(rows), vectors.near_vectors(vector_frame(spark, rows), recall=0.9).collect()))
    assert 0.9 * want <= got <= want


@pytest.mark.parametrize("recall", [1.0])
def test_vectors_find_all_links(spark, monkeypatch, recall):
    monkeypatch.setattr(vectors, "VECTORS_PER_CELL", 2)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(30, 16))
    rows = [(i, [float(x) for x in np.float32(base[rng.integers(30)] + rng.normal(size=16) * rng.choice([0, 0.02, 0.05, 0.08]))], int(rng.integers(3))) for i in range(250)]
    got = sorted(tuple(r) for r in vectors.near_vectors(vector_frame(spark, rows), recall=recall).collect())
    assert got == plain_links(rows)


def test_vectors_find_links_across_cells_for_both_ends(spark, monkeypatch):
    """Several codewords a half; pairs differ in one component or straight across the plane between two codewords."""
    monkeypatch.setattr(vectors, "VECTORS_PER_CELL", 16)
    rng = np.random.default_rng(11)
    x = rng.normal(size=(700, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    one = x[:150].copy()
    one[np.arange(150), rng.integers(0, 64, 150)] += 0.19 * rng.choice([-1, 1], 150)
    words = vectors.codebook(x[:, :32], 6)
    across = x[150:650].copy()
    near = (np.square(words).sum(axis=1) - 2 * across[:, :32] @ words.T).argsort(axis=1)
    way = words[near[:, 1]] - words[near[:, 0]]
    across[:, :32] += 0.19 * way / np.linalg.norm(way, axis=1, keepdims=True)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(np.float32(np.concatenate([x, one, across])))]
    want = plain_links(rows)
    assert sum(r[1] for r in want) > 1200
    assert sorted(tuple(r) for r in vectors.near_vectors(vector_frame(spark, rows)).collect()) == want


def test_cell_bound_is_never_over_the_distance():
    rng = np.random.default_rng(2)
    centres, x = rng.normal(size=(9, 6)), rng.normal(size=(200, 6))
    near, bound = vectors.bounds(x, centres)
    gaps = np.linalg.norm(x[:, None] - x[None], axis=2)
    for i in range(200):
        for j in range(200):
            assert bound[i, near[j]] <= gaps[i, j] + 1e-9


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}


# Operator 4


def plain_archive(rows, least=0):
    last = {}
    for key, _, html in rows:
        if key is not None:
            last[html or ""] = max(last.get(html or "", key), key)
    out = []
    for key, _, html in rows:
        data = (html or "").encode()
        to = last[html or ""] if key is not None and len(data) >= least and key < last[html or ""] else None
        out.append((key, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


PAGES = [(1, "a b\nc", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "http://x/é ", None), (4, "", ""), (None, "u", "<p>é</p>"), (5, "u", "x\r\n\r\ny" * 1000), (5, "u2", "z"), (6, "u3", "\r\n\r\n")]


def page_frame(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, extra int")


@pytest.mark.parametrize("least", [0, 5])
def test_archives_round_trip(spark, tmp_path, least):
    path = str(tmp_path / f"w{least}")
    got = sorted((tuple(r) for r in warc.archive_digest(page_frame(spark, PAGES), path, least).collect()), key=str)
    assert got == plain_archive(PAGES, least)
    assert warc.archive_digest(page_frame(spark, []), str(tmp_path / f"e{least}")).collect() == []


def test_archives_roll_and_are_deterministic(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    one, two = (warc.write_archives(pages, str(tmp_path / n), roll_bytes=5_000) for n in "ab")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect())) and one.count() > 4
    back = warc.read_archives(spark, str(tmp_path / "a")).where("record_type = 'response'")
    assert back.join(pages, "page_id").where(back.payload.cast("string") != pages.html).count() == 0
    name = one.first().file
    (tmp_path / "a" / name).write_bytes(b"changed")
    with pytest.raises(Exception, match="differs|Error|error"):
        warc.read_archives(spark, str(tmp_path / "a")).collect()


def test_reading_members_takes_linear_time():
    record = warc.gzipped(b"x" * 200)
    took = []
    for n in (4_000, 16_000):
        data, began = record * n, time.perf_counter()
        assert sum(1 for _ in warc.members(data)) == n
        took.append(time.perf_counter() - began)
    assert took[1] < 10 * took[0]
    with pytest.raises(ValueError, match="cut off"):
        list(warc.members(record[:-3]))
    big = bytes(np.random.default_rng(0).integers(0, 256, 200_000, dtype=np.uint8))
    assert list(warc.members(warc.gzipped(big) + record)) == [big, b"x" * 200]


def test_archives_by_hadoop_path_and_shards(spark, tmp_path):
    """A local path with one slash after its scheme, many repeats, null ids, columns named like the writer's own."""
    rows = [(i if i % 5 else None, f"u{i % 7}", "<p>hot</p>" if i % 3 == 0 else f"p{i}") for i in range(400)]
    frame = page_frame(spark, rows).withColumns({c: F.lit(1) for c in ("digest", "payload", "refers_to", "salt")})
    path = f"file:{tmp_path}/x"
    manifest = warc.write_archives(frame, path, shards=4)
    assert 1 < manifest.count() <= 4 and manifest.agg(F.sum("records")).first()[0] == 400
    got = sorted((tuple(r) for r in warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)
    assert got == plain_archive(rows)


def test_archive_of_a_long_page(spark, tmp_path):
    long = "<p>é long</p>" * 500_000  # over 5 MB
    got = sorted((tuple(r) for r in warc.archive_digest(page_frame(spark, [(1, "u", long), (2, "u", long)]), str(tmp_path / "l")).collect()), key=str)
    assert got == plain_archive([(1, "u", long), (2, "u", long)])


# Operator 5


def plain_url(url):
    if url is None or "://" not in url:
        return "", "", None
    after = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", after)[0]
    path = re.match(r"[^?#]*", after[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in urls.RULES if (host == r.host or host.endswith(f".{r.host}")) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.text), default=None)


URLS = [None, "", "nope", "http://A.Example.COM/en/x?y", "https://www.example.com/en/", "http://x.net/es/1", "http://net/fr/", "http://casinowin.example.org/en/1", "http://freebets.example.org/", "http://a://b/c", "http://x.com", "http://é\n.com/\n?", "://x.net:80/fr/#a", "http://x.net", "http://examplecom/en/"]


def test_url_rules_and_verdicts(spark):
    texts = [*URLS, *[r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]]
    frame = spark.createDataFrame([(i, u, "<p>free win bets for the casino</p>", 1) for i, u in enumerate(texts)], "page_id long, url string, html string, extra int")
    rows = {r.page_id: r for r in urls.judge_urls(frame).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        host, path, rule = plain_url(text)
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, rule and rule.text)
        assert rows[i].verdict == rule.verdict if rule else rows[i].verdict in ("allow", "block")
    assert rows[7].verdict == "block" and rows[8].verdict == "block"
    assert urls.judge_urls(frame.limit(0)).collect() == []


def test_verdicts_equal_plain_naive_bayes(spark):
    """Words, class counts and log odds written out, on the pages without a rule."""
    hosts = ["freebets.org", "freegifts.org", "casino-win.net", "winter.org", "é99.org", "newsdaily.org", "m.winbets.org", "x.org", "x.org"]
    paths = ["/en/1", "/newsbets/2?q", "/a-9", "", "/en/77"]
    pages = [(i, f"http://{h}{paths[i % 5]}", "<p>free bets win winter gifts news daily casino the the</p>") for i, h in enumerate(hosts)]
    frame = spark.createDataFrame([(*p, 1, 2) for p in pages], "page_id long, url string, html string, host string, part int")
    got = {r.page_id: r for r in urls.judge_urls(frame).collect()}
    counts = Counter("free bets win winter gifts news daily casino the the".split() * len(pages)) + Counter({s: urls.SEED_COUNT for s in urls.SEEDS})
    total = sum(counts.values())

    def words(text):
        return [w for run in re.findall(r"[0-9]+|[^\W\d_]+", text) for w in (["0"] if run[0].isdigit() else urls.segment(run, counts, total))]

    tokens = [words(h) + ["/" + w for w in words(re.match("[^?#]*", paths[i % 5])[0])] for i, h in enumerate(hosts)]
    seeded = [any(w in urls.SEEDS for w in words(h)) for h in hosts]
    classes = {k: Counter(t for ts, s in zip(tokens, seeded, strict=True) if s == k for t in ts) for k in (True, False)}
    whole = classes[True] + classes[False]
    p = lambda t, k: (classes[k][t] + urls.SMOOTHING * whole[t] / sum(whole.values())) / (sum(classes[k].values()) + urls.SMOOTHING)
    for i, ts in enumerate(tokens):
        odds = sum(np.log(p(t, True) / p(t, False)) for t in ts)
        assert got[i].rule is None and abs(got[i].log_odds - odds) < 1e-5 and got[i].verdict == ("block" if got[i].log_odds > 0 else "allow")
    assert got[0].verdict == got[6].verdict == "block" and got[3].verdict == "allow"


def labelled_pages(spark, n):
    """Pages of n hosts whose names run words together; those with winbig or hotdeal are unwanted, and no seed says so."""
    rng = random.Random(7)
    parts = (["winbig", "hotdeal"], ["garden", "school", "museum"], ["north", "river", "green", "daily"])
    hosts = [(f"{rng.choice(parts[k % 2])}{rng.choice(parts[2])}{rng.randrange(900)}.org", 1 - k % 2) for k in range(n)]
    text = "<p>" + " ".join("win big hot deal garden school museum north river green daily winbig hotdeal".split() * 3) + "</p>"
    return spark.createDataFrame([(k, f"http://{h}/{k}", text) for k, (h, _) in enumerate(hosts)], "page_id long, url string, html string"), hosts


def test_labels_of_hosts_teach_the_verdicts(spark):
    pages, hosts = labelled_pages(spark, 240)
    rows = [*hosts, (None, 1), (hosts[0][0], None), (hosts[1][0], 7), ("elsewhere.org", 1)]
    labels = spark.createDataFrame(rows, "host string, label int")
    (good, bad) = sorted(map(tuple, urls.held_out_agreement(pages, labels).collect()))
    assert good[0] == 0 and bad[0] == 1 and good[1] + bad[1] > 50
    assert good[2] >= 0.95 * good[1] and bad[2] >= 0.95 * bad[1]
    half = labels.where("crc32(host) % 2 = 0")
    got = {r.host: r.verdict for r in urls.judge_urls(pages, labels=half).collect()}
    assert sum((got[h] == "block") == bool(label) for h, label in hosts) >= 0.95 * len(hosts)
    blind = urls.judge_urls(pages, labels=labels.limit(0)).collect()
    assert {r.verdict for r in blind} == {"allow"} and {r.log_odds for r in blind} == {0.0}


def test_seed_labels_agree_with_the_default(spark):
    texts = [*URLS, *[r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]]
    pages = spark.createDataFrame([(i, u, "<p>free win bets for the casino</p>") for i, u in enumerate(texts)], "page_id long, url string, html string")
    labels = urls.seed_labels(pages)
    assert {r.host: r.label for r in labels.collect()} | {"casinowin.example.org": 1, "freebets.example.org": 1, "x.com": 0, "": 0} == {r.host: r.label for r in labels.collect()}
    assert sorted(urls.judge_urls(pages, labels=labels).collect()) == sorted(urls.judge_urls(pages).collect())


def test_words_in_every_host_are_dealt_in_parts(spark):
    df = spark.range(4_000).select("id", F.lit("com").alias("token"))
    joined = urls.salted(df, spark.createDataFrame([("com", 1.0), ("org", 2.0)], "token string, odds double"), "token", "id")
    assert sorted(r.id for r in joined.collect()) == list(range(4_000)) and joined.columns == ["token", "id", "odds"]
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "_part" in plan


def test_urls_of_very_long_names(spark):
    long = "news" * 200_000
    frame = spark.createDataFrame([(1, f"http://{long}.org/{long}", "<p>news</p>"), (2, "http://casino.org/" + "a/" * 100_000, None)], "page_id long, url string, html string")
    rows = {r.page_id: r for r in urls.judge_urls(frame).collect()}
    assert rows[1].host == f"{long}.org" and rows[1].verdict == "allow" and rows[2].verdict == "block"


def test_segmentation_is_the_likeliest_split():
    counts = {"free": 50, "bets": 40, "be": 500, "ts": 5, "freebet": 1, "the": 1000, "rapist": 3, "therapist": 30}
    assert urls.segment("freebets", counts, 2000) == ["free", "bets"]
    assert urls.segment("therapist", counts, 2000) == ["therapist"]
    assert urls.segment("", counts, 2000) == [] and "".join(urls.segment("zzqfreezz", counts, 2000)) == "zzqfreezz"


# Operator 2


def test_raking_meets_every_marginal(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.mix(docs).join(docs.select("doc_id", mixing.words_in(F.col("text")).alias("w")), "doc_id").toPandas()
    for dimension in mixing.DIMENSIONS:
        own = got.groupby(dimension).w.sum()
        own = own[own > 0]
        words = own * (1 + mixing.EVEN) / (own / own.max() + mixing.EVEN)
        expected = (got.w * got.probability).groupby(got[dimension]).sum()[own.index]
        assert np.allclose(words / words.sum(), expected / expected.sum(), atol=1e-4)
    assert got.probability.max() == 1.0 and got[got.w > 0].probability.min() > 0 and (got[got.w == 0].probability == 0).all()
    assert abs(got.sampled.mean() - got.probability.mean()) < 0.06 and got.converged.all()


CELLS = [("a", "x", "t", 10), ("a", "y", "t", 30), ("b", "x", "u", 40), ("b", "y", "t", 20), ("c", "y", "u", 0)]


def raked(spark, targets, **more):
    frame = spark.createDataFrame(CELLS, "_source string, _lang string, _topic string, words long")
    rows = [(d, v, s) for d, of in targets.items() for v, s in of.items()]
    return mixing.rake(frame, spark.createDataFrame(rows, "dimension string, value string, share double"), **more).collect()


@pytest.mark.parametrize("most_here", [0, 1000])
def test_raking_equals_plain_fitting(spark, most_here):
    targets = {"_source": {"a": 0.7, "b": 0.3, "c": 0.4}, "_lang": {"x": 0.5, "y": 0.5}}
    w = {c[:3]: c[3] / 100 for c in CELLS if c[3]}
    for _ in range(200):
        for i, k in enumerate(targets):
            share = {v: s for v, s in targets[k].items() if any(c[i] == v for c in w)}
            for v in {c[i] for c in w}:
                now = sum(x for c, x in w.items() if c[i] == v)
                w |= {c: x * share[v] / sum(share.values()) / now for c, x in w.items() if c[i] == v}
    out = raked(spark, targets, most_here=most_here)
    got = {(r._source, r._lang, r._topic): r.weight for r in out}
    assert got.keys() == w.keys() and all(abs(got[c] - w[c]) < 1e-5 for c in w) and all(r.converged for r in out)


@pytest.mark.parametrize("rounds", [2, 5, 40])
def test_raking_by_the_driver_equals_raking_by_joins(spark, rounds):
    for targets in ({"_source": {"a": 0.7, "b": 0.3}, "_lang": {"x": 0.5, "y": 0.5}, "_topic": {"t": 1.0, "u": 2.0}}, {"_lang": {"x": 0.0, "y": 3.0}}, {"_lang": {"z": 1.0}}, {}):
        here, joins = ({(r._source, r._lang, r._topic): r for r in raked(spark, targets, rounds=rounds, most_here=n)} for n in (1000, 0))
        assert here.keys() == joins.keys()
        for k, r in here.items():
            assert abs(r.weight - joins[k].weight) < 1e-12 and abs(r.ratio - joins[k].ratio) < 1e-9 and (r.converged, r.words) == (joins[k].converged, joins[k].words)


@pytest.mark.parametrize("most_here", [0, 1000])
def test_raking_says_where_targets_contradict(spark, most_here):
    out = raked(spark, {"_source": {"a": 0.1, "b": 0.9}, "_lang": {"x": 0.0, "y": 1.0}, "_topic": {"u": 0.9, "t": 0.1}}, rounds=4, most_here=most_here)
    assert out == [] or not any(r.converged for r in out)


def test_mixture_with_given_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    target = spark.createDataFrame([("en", 0.25), ("de", 0.75)], "value string, share double")
    got = mixing.mix(docs, {"lang": target}).join(docs.select("doc_id", mixing.words_in(F.col("text")).alias("w")), "doc_id").toPandas()
    mass = (got.w * got.probability).groupby(got.lang).sum()
    assert abs(mass["en"] / mass.sum() - 0.25) < 1e-3 and got[~got.lang.isin(["en", "de"])].probability.max() == 0


def test_mixture_odd_rows(spark):
    rows = [(1, None, None, None), (2, "", "en", "s"), (3, "a b", "en", "s"), (None, "c", "en", None), (3, "a b", "en", "s"), (4, "\n\t", "en", "s"), (5, "word " * 1_000_000, "en", "s")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, source string, weight int")
    got = mixing.mix(frame).collect()
    assert len(got) == 7 and not any(r.sampled or r.probability for r in got if r.doc_id in (1, 2, 4))
    assert len({(r.probability, r.sampled) for r in got if r.doc_id == 3}) == 1
    assert mixing.mix(frame.limit(0)).collect() == []
    own = {"probability": F.lit(7), "ratio": F.lit(8), "_draw": F.lit(9), "_SOURCE": F.lit(1), "topic": F.lit(2), "converged": F.lit(3)}
    drawn = mixing.sampled_documents(frame.withColumns(own))
    assert drawn.columns == [*frame.columns, *own] and all(r.probability == 7 and r._draw == 9 for r in drawn.collect())


def test_topics_of_plain_texts(spark):
    """Two kinds of texts in two languages: the kinds are the topics, not the languages."""
    rng = np.random.default_rng(6)
    kinds = {(lang, kind): [f"{lang}{kind}{i}" for i in range(30)] for lang in ("en", "de") for kind in ("sea", "sky")}
    rows = [(i, " ".join([*rng.choice(kinds[lang, kind], 40), *[f"{lang}the"] * 40]), lang, "s") for i, (lang, kind) in enumerate(sorted(kinds) * 40)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    of = {r[0]: sorted(kinds)[r[0] % 4] for r in rows}
    topics = {}
    for r in got:
        topics.setdefault(r.topic, set()).add(of[r.doc_id])
    assert len(topics) > 1 and all(len({lang for lang, _ in found}) < 2 or len({kind for _, kind in found}) < 3 for found in topics.values())
    assert all(len(found) < 4 for found in topics.values())


def many_texts(spark):
    """Over 2,000 texts of two kinds; the second kind is not among the 1,500 texts with the smallest hashes."""
    rng = np.random.default_rng(7)
    texts = [(" ".join(f"{kind}{k}" for k in rng.integers(0, 40, 30)), lang) for kind in ("sea", "sky") for lang in ("en", "de") for _ in range(900)]
    found = spark.createDataFrame(texts, "text string, lang string").withColumn("h", F.xxhash64("text", "lang")).orderBy("h").collect()
    least = sorted(r.h for r in found if r.text.startswith("sea"))[1500]
    kept = [(r.text, r.lang) for r in found if r.text.startswith("sea") or r.h > least]
    odd = [*kept[:50] * 3, ("", "en"), (None, "de"), (" \n", None), *((f"sea{k} sky{k}", None) for k in range(9)), *((f"rare{k} sea{k}", "fr") for k in range(20))]
    rows = [(i, t, lang, f"s{i % 2}") for i, (t, lang) in enumerate([*kept, *odd])]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def plain_topics(docs):
    """Topic of each document by k-means over all distinct texts, in one array."""
    rows = docs.select("doc_id", "text", F.coalesce("lang", F.lit("(none)")).alias("lang")).withColumn("h", F.xxhash64("text", "lang")).collect()
    once = sorted({r.h: r for r in rows if r.text and r.text.strip()}.values(), key=lambda r: r.h)
    n = mixing.word_places(pa.array([r.text for r in once]))
    idf = (np.log((len(n) + 1) / ((n > 0).sum(axis=0) + 1)) + 0.1).astype(np.float32)
    x = mixing.units(np.log1p(n) * idf)
    at = {v: np.array([r.lang == v for r in once]) for v in {r.lang for r in once}}
    fine = np.rint(x * np.float32(mixing.FINE)).astype(np.int64)
    mean = {v: fine[i].sum(axis=0) / i.sum() / mixing.FINE for v, i in at.items() if i.sum() >= mixing.LEAST_OF_LANG}
    whole = fine.sum(axis=0) / len(fine) / mixing.FINE
    x = np.rint(mixing.units(x - np.array([mean.get(r.lang, whole) for r in once], np.float32)) * np.float32(mixing.FINE)).astype(np.int64)
    near = lambda c: (x @ np.rint(mixing.units(c.astype(float)) * (mixing.FINE // 2)).astype(np.int64).T).argmax(axis=1)
    centres = x[: mixing.TOPICS]
    for _ in range(10):
        found = near(centres)
        centres = np.array([x[found == k].sum(axis=0) if (found == k).any() else c for k, c in enumerate(centres)])
    of = {r.h: f"topic {k}" for r, k in zip(once, near(centres), strict=True)}
    return {r.doc_id: of.get(r.h, "(none)") for r in rows}


def test_topics_are_fitted_on_every_text(spark):
    docs = many_texts(spark)
    expected = plain_topics(docs)
    got = {r.doc_id: r.topic for r in mixing.mix(docs).collect()}
    assert got == expected
    sky = {got[r.doc_id] for r in docs.where("text like 'sky%'").collect()}
    assert not sky & {got[r.doc_id] for r in docs.where("text like 'sea%' and text not like '%sky%' and lang in ('en', 'de')").collect()}
    assert {r.doc_id: r.topic for r in mixing.mix(docs.repartition(7)).collect()} == expected


def test_pipeline_draws_by_topics_of_every_text(spark):
    import corpus_pipeline as pipeline

    docs = many_texts(spark).withColumn("n_chars", F.length("text").cast("long"))
    topics = spark.createDataFrame(list(plain_topics(docs).items()), "doc_id long, _topic string")
    unit = (F.xxhash64(F.lit(mixing.SEED), "doc_id", "text").cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    own = docs.join(topics, "doc_id").select("doc_id", F.col("source").alias("_source"), F.coalesce("lang", F.lit("(none)")).alias("_lang"), "_topic", mixing.words_in(F.col("text")).alias("words"), unit.alias("unit"))
    chances = mixing.probabilities(own.groupBy(*mixing.CELL).agg(F.sum("words").alias("words")))
    expected = {r.doc_id for r in own.join(chances, mixing.CELL).where("words > 0 and unit < probability").collect()}
    before = {r.doc_id: r for r in docs.collect()}
    got = {r.doc_id: r for r in pipeline.mix_sources(spark, docs, SF).collect()}
    assert set(got) == expected and 0 < len(got) < len(before) and all(before[i] == r for i, r in got.items())


# Pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    own = {r.doc_id: r for r in docs.collect()}
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        rows = {r.doc_id: r for r in out.collect()}
        assert rows and set(rows) <= set(own)
        if name == "secret scan":
            assert set(rows) == set(own)
            assert any(rows[i].text != own[i].text for i in own) and all(rows[i].n_chars == len(rows[i].text) for i in own if rows[i].text != own[i].text)
        else:
            assert all(rows[i] == own[i] for i in rows)
    assert [n for n, _ in pipeline.STAGES] == ["quality classifier", "near-duplicates", "secret scan", "mixture", "packing"]


def plain_redaction(text):
    """The text with its secrets replaced, by Python's own regex."""
    rules = [*BASE, *((r.kind, re.compile(r.pattern), r.group, r.least) for r in secrets.RULES if not r.base)]
    spans = sorted((m.start(), n, m.end(), kind) for n, (kind, p, group, least) in enumerate(rules) for m in p.finditer(text) if len(m[group]) >= least)
    out, at = [], 0
    for start, _, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_pipeline_against_brute_force(spark, tmp_path):
    """Each stage on its own input: the classifier's verdicts, groups of all pairs, redaction by re, cell shares, token ids."""
    import corpus_pipeline as pipeline

    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in pipeline.STAGES[:-1]:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        found[name] = ({r.doc_id: r for r in before.collect()}, {r.doc_id: r for r in docs.collect()})
    before, after = found["quality classifier"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    right = [(i in after) == bool(labels[i]) for i in before if labels.get(i) in (0, 1)]
    assert np.mean(right) > 0.97 and all(after[i] == before[i] for i in after)
    before, after = found["near-duplicates"]
    order = sorted(before)
    groups = plain_groups([before[i].text for i in order])
    assert sorted(after) == [order[n] for n, g in enumerate(groups) if n == g]
    before, after = found["secret scan"]
    assert {i: r.text for i, r in after.items()} == {i: r.text and plain_redaction(r.text) for i, r in before.items()}
    before, after = found["mixture"]
    drawn = {r.doc_id: r for r in mixing.mix(spark.createDataFrame(list(before.values()), docs.schema)).collect()}
    assert set(after) == {i for i, r in drawn.items() if r.sampled} and all(after[i] == before[i] for i in after)
    tokenizer = Tokenizer.from_file(default_tokenizer())
    rows = pipeline.STAGES[-1][1](spark, docs, SF).collect()
    length = {i: len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for i, r in after.items()}
    got = Counter()
    for r in rows:
        got[r.doc_id] += r.length
    fill = Counter()
    for r in rows:
        fill[r.sequence_id] += r.length
    assert got == length and max(fill.values()) <= 1024 and len(fill) <= -(-sum(length.values()) // 1024) + 2


def test_pipeline_on_odd_rows(spark, tmp_path):
    import corpus_pipeline as pipeline

    texts = [None, "", "a b c", "a b c", "token = abcdefghijklmnop " * 5, "word " * 30]
    spark.createDataFrame([(i, t, None if i % 2 else "en", None, None) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(5, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in rows} <= {2, 4, 5}
    empty = tmp_path / "none"
    spark.read.parquet(str(tmp_path / "documents.parquet")).limit(0).write.parquet(str(empty / "documents.parquet"))
    spark.read.parquet(str(tmp_path / "labels.parquet")).limit(0).write.parquet(str(empty / "labels.parquet"))
    assert pipeline.run(spark, str(empty)).collect() == []


def test_every_operator_has_one_query():
    names = [n for n in __spark_entry__.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 11))
    assert "pipeline" in __spark_entry__.queries()
