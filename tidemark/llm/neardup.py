"""Operator 1: near-duplicate documents by improved consistent weighted sampling over TF-IDF shingles.

1. Equal texts (by two 64-bit hashes) form a class with a number; one text of each class goes on, so copies are never
   paired.
2. Document frequencies of all five-word shingles of all documents are counted in a sketch of ``SKETCH`` counters. Its
   width is fixed and its error is a fixed share of the number of documents, so weights behave alike at every size.
3. A shingle weighs its count in the text times an inverse document frequency between 1 and ``1 + IDF_SHARE``. The
   bound keeps near copies near however large their group is (the frequency of what they share grows with the group).
4. Consistent weighted samples give each text a signature, and ``BANDS`` bands of it give buckets.
5. Stars: in each bucket every text is paired with the bucket's first text, and the pair is verified by the weighted
   Jaccard similarity of whole texts. This is one pair for a text and band, however large the bucket.
6. Buckets whose texts are then in one component are done. In the others the texts outside the largest component are
   held against all texts of the bucket that are in other components: signatures first, block by block, then the whole
   texts of the pairs that are left, each sent once to a cell of at most ``CELL`` texts a side.
7. Connected components of the verified links are the groups.

No pair is left out by a cap. Two filters are probable, not certain: a pair at a similarity of 0.8 shares no bucket in
one case of 4,600 (less above it), and in step 6 pairs with fewer than ``least_equal`` equal samples are not verified;
with 0 all pairs of a bucket that are in different components are.
Texts without a word have no shingles and are linked with nothing but equal texts are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import filled, hashed, mixed, stage, text_slices, unused, words_of
from tidemark.llm.components import components

WORDS = 5
SIMILARITY = 0.8
SKETCH = 1 << 17
IDF_SHARE, IDF_FLOOR = 0.05, 1e-3
BANDS, ROWS = 16, 4
SAMPLES = BANDS * ROWS
#: Equal samples (of 64) below which a pair is not verified in step 6 unless told otherwise; at 0.8 one in 100,000 has fewer.
LEAST_EQUAL = 36
#: Parts that a bucket, or the pairs of one text, are dealt in, so that no task gets a whole large one.
SALTS = 32
BLOCK, CELL = 1024, 256
BASE = np.uint64(0x9E3779B97F4A7C15)

_rng = np.random.default_rng(20240229)
_uniform = lambda: _rng.random(1 << 16)
R = (-np.log(_uniform() * _uniform() + 1e-12)).astype(np.float32)  # Gamma(2, 1)
INVERSE_R = (1 / R).astype(np.float32)
LOG_C = np.log(-np.log(_uniform() * _uniform() + 1e-12)).astype(np.float32)
BETA = _uniform().astype(np.float32)
MULTIPLIERS = _rng.integers(1, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, shingle (48-bit hash) and its count, for the distinct shingles of each text, ascending.

    Words are compared without case. A text of one to four words is one shingle.
    """
    codes, words, count = words_of(pc.utf8_lower(filled(texts)))
    word = mixed(hashed(words))[codes]
    doc = np.repeat(np.arange(len(texts)), count)
    with np.errstate(over="ignore"):
        window = word[: max(len(word) - WORDS + 1, 0)]
        for j in range(1, WORDS):
            window = window * BASE + word[j : j + len(window)]
        at = np.flatnonzero(doc[: len(window)] == doc[WORDS - 1 :]) if len(window) else np.zeros(0, np.int64)
        short = np.flatnonzero((count > 0) & (count < WORDS))
        start = (np.cumsum(count) - count)[short]
        few = count[short].astype(np.uint64)
        for j in range(WORDS - 1):
            there = count[short] > j
            few[there] = few[there] * BASE + word[start[there] + j]
    key = np.concatenate([doc[at], short]).astype(np.uint64) << np.uint64(48) | mixed(np.concatenate([window[at], few])) >> np.uint64(16)
    key.sort()
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    times = np.diff(np.append(first, len(key)))
    key = key[first]
    return (key >> np.uint64(48)).astype(np.int64), key & np.uint64((1 << 48) - 1), times


def document_frequency(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Counters of the sketch over all documents, and the number of documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(SKETCH, np.int64), 0
        for batch in batches:
            for part in text_slices(batch):
                total += np.bincount((shingles(part.column("text"))[1] & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
                rows += part.num_rows
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(total[at], rows))], names=["bucket", "n"])

    counted = docs.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    bucket, n = counted.column("bucket").to_numpy(), counted.column("n").to_numpy()
    total = np.zeros(SKETCH, np.int64)
    total[bucket[bucket >= 0]] = n[bucket >= 0]
    return total, int(n[bucket < 0].sum())


def inverse_frequency(total: np.ndarray, documents: int) -> np.ndarray:
    """Weight of each counter, 1 (in every document) to ``1 + IDF_SHARE`` (in one of 1,000 or fewer).

    What the average counter holds is taken off, as rare shingles share a counter.
    """
    share = np.clip((total - total.mean()) / max(documents, 1), IDF_FLOOR, 1)
    return (1 + IDF_SHARE * np.log(share) / np.log(IDF_FLOOR)).astype(np.float32)


def signatures(texts: pa.Array, idf: np.ndarray) -> list[bytes | None]:
    """Samples of each text, 16 bits of each; None for a text without words."""
    doc, shingle, times = shingles(texts)
    found: list[bytes | None] = [None] * len(texts)
    if not len(doc):
        return found
    log_weight = np.log(times * idf[(shingle & np.uint64(SKETCH - 1)).astype(np.int64)]).astype(np.float32)
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    out = np.empty((len(first), SAMPLES), np.float32)
    low = np.uint64(0xFFFF)
    for k in range(SAMPLES):
        with np.errstate(over="ignore"):
            h = shingle * MULTIPLIERS[k]
        r_at = (h >> np.uint64(48)).astype(np.int64)
        beta = BETA[(h >> np.uint64(20) & low).astype(np.int64)]
        level = np.floor(log_weight * INVERSE_R[r_at] + beta)
        out[:, k] = np.minimum.reduceat(LOG_C[(h >> np.uint64(34) & low).astype(np.int64)] + R[r_at] * (beta - level - 1), first)
    short = (mixed(out.view(np.uint32).astype(np.uint64)) >> np.uint64(48)).astype("<u2")
    for d, row in zip(doc[first].tolist(), short, strict=True):
        found[d] = row.tobytes()
    return found


def as_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, SAMPLES)


def bands_of(signature: np.ndarray) -> np.ndarray:
    """The samples of each band as one number; equal only where all of them are."""
    return np.ascontiguousarray(signature).view("<u8").reshape(-1, BANDS)


def bucket_hashes(signature: np.ndarray) -> np.ndarray:
    """The bucket of each band of each signature."""
    with np.errstate(over="ignore"):
        return mixed(bands_of(signature) + np.arange(1, BANDS + 1, dtype=np.uint64) * BASE).view(np.int64)


def band_rows(reps: DataFrame) -> DataFrame:
    """Rows (bucket, node): one for each band of each signature."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                h = bucket_hashes(as_matrix(batch.column("signature")))
                yield pa.RecordBatch.from_arrays([pa.array(h.reshape(-1)), pa.array(np.repeat(batch.column("node").to_numpy(), BANDS))], names=["bucket", "node"])

    return reps.select("node", "signature").mapInArrow(cut, "bucket long, node long")


class Weights:
    """Shingle weights by counter, and the comparison of two texts (shingles ascending, with counts and weights)."""

    def __init__(self, idf: np.ndarray, similarity: float):
        self.idf, self.similarity = idf, similarity

    def of(self, shingle: np.ndarray) -> np.ndarray:
        return self.idf[(shingle & np.uint64(SKETCH - 1)).astype(np.int64)].astype(np.float64)

    def described(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, float]]:
        """For each text its shingles, their counts, their weights, and the sum of weighted counts."""
        doc, shingle, times = shingles(texts)
        weight = self.of(shingle)
        edge = np.searchsorted(doc, np.arange(len(texts) + 1))
        return [(shingle[x:y], times[x:y], weight[x:y], float((weight[x:y] * times[x:y]).sum())) for x, y in zip(edge[:-1], edge[1:], strict=True)]

    def jaccard(self, a: tuple, b: tuple) -> float:
        """Weighted Jaccard similarity of two described texts; 0 where one has no shingles."""
        if not len(a[0]) or not len(b[0]):
            return 0.0
        at = np.minimum(np.searchsorted(a[0], b[0]), len(a[0]) - 1)
        hit = a[0][at] == b[0]
        shared = float((b[2][hit] * np.minimum(b[1][hit], a[1][at[hit]])).sum())
        return shared / (a[3] + b[3] - shared)

    def linked(self, a: tuple, b: tuple) -> bool:
        return self.jaccard(a, b) >= self.similarity - 1e-9


def bucket_members(bands: DataFrame) -> DataFrame:
    """Rows (bucket, node, anchor) of all buckets with two texts or more.

    A bucket is dealt in parts; the anchor of a text is the first of its part, and that of such a first text is the
    first of the bucket. So no task gets a whole large bucket, and the anchors hold it together.
    """
    part, whole = Window.partitionBy("bucket", "salt"), Window.partitionBy("bucket")
    dealt = bands.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)))
    local = dealt.select("bucket", "node", F.min("node").over(part).alias("anchor"), F.count("*").over(part).alias("n"))
    first = local.where("node = anchor").select("bucket", "node", F.min("node").over(whole).alias("anchor"), F.sum("n").over(whole).alias("n"))
    return local.where("node <> anchor").select("bucket", "node", "anchor").unionByName(first.where("n > 1").select("bucket", "node", "anchor"))


def texts_of(nodes: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows (node, signature, text): one text of each class, taken from the rows with the class's own id, not from its
    copies."""
    wanted = classes.join(nodes.distinct(), "node", "left_semi").select("node", "signature", "key1", "key2", F.col("class_id").alias("doc_id"), "rows")
    key = ["doc_id", "key1", "key2"]
    once = docs.join(wanted.where("rows = 1"), key).select("node", "signature", "text")
    again = wanted.where("rows > 1")  # rows that repeat id and text
    if again.isEmpty():
        return once
    return once.unionByName(docs.join(again, key).groupBy("node", "signature").agg(F.first("text").alias("text")))


def star_links(pairs: DataFrame, texts: DataFrame, held: Broadcast) -> DataFrame:
    """Those of the pairs (a, b) whose whole texts have the similarity.

    Each text b is sent to its a; the pairs of one a are dealt in parts, so no task gets them all.
    """
    dealt = pairs.select("a", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int").alias("part"), "b")
    wanted = dealt.select("a", "part", F.lit(1).alias("role"), F.col("b").alias("node")).unionByName(dealt.select("a", "part").distinct().withColumns({"role": F.lit(0), "node": F.col("a")}))
    rows = wanted.join(texts.select("node", "text"), "node").repartition("a", "part").sortWithinPartitions("a", "part", "role")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            for part in text_slices(batch):
                ok = []
                for role, mine in zip(part.column("role").to_pylist(), held.value.described(part.column("text")), strict=True):
                    own = mine if role == 0 else own
                    ok.append(role == 1 and held.value.linked(own, mine))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("node")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return rows.select("a", "part", "role", "node", "text").mapInArrow(compare, "a long, b long")


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, from sorted batches."""
    kept: pa.Table | None = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        now = now if kept is None else pa.concat_tables([kept, now])
        if not now.num_rows:
            continue
        key = np.stack([now.column(k).to_numpy() for k in keys])
        cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist()]
        for x, y in zip(cuts[:-1], cuts[1:], strict=True):
            yield now.slice(x, y - x)
        kept = now.slice(cuts[-1])
    if kept is not None:
        yield kept


BLOCK_KEY = ["bucket", "block", "part"]
MEMBERS = "cell long, band int, role int, node long, component long, main long"


def candidates(run: pa.Table, band: int, least_equal: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the pairs (outsider, member) of a run that are in different components, whose signatures agree, and that
    share no earlier band than this one; two outsiders meet once. Pairs that agree most come first. The third array says
    how many samples of each pair are equal."""
    node, comp, main = (run.column(c).to_numpy() for c in ("node", "component", "main"))
    signature = as_matrix(run.column("signature").combine_chunks())
    bands = bands_of(signature)
    outside = run.column("role").to_numpy() == 1
    out, own = np.flatnonzero(outside), np.flatnonzero(~outside)
    found = []
    for x in range(0, len(out), 64):
        some = out[x : x + 64]
        ok = (comp[some][:, None] != comp[own][None, :]) & ((comp[own] == main[own])[None, :] | (node[some][:, None] < node[own][None, :]))
        i, j = np.nonzero(ok)
        i, j = some[i], own[j]
        for y in range(0, len(i), 50_000):
            u, v = i[y : y + 50_000], j[y : y + 50_000]
            equal = (signature[u] == signature[v]).sum(axis=1)
            keep = np.flatnonzero(equal >= least_equal)
            keep = keep[(bands[u[keep]] == bands[v[keep]]).argmax(axis=1) == band]
            found.append(np.stack([u[keep], v[keep], equal[keep]]))
    u, v, equal = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    order = np.argsort(-equal, kind="stable")
    return u[order], v[order], equal[order]


def involved(run: pa.Table, least_equal: int) -> Iterator[pa.RecordBatch]:
    """The texts of a block that are in a pair to verify, once for each cell (of at most about ``CELL`` texts a side) that
    holds such a pair of theirs."""
    there = np.flatnonzero(bucket_hashes(as_matrix(run.column("signature").slice(0, 1).combine_chunks()))[0] == run.column("bucket")[0].as_py())
    u, v, _ = candidates(run, int(there[0]), least_equal) if len(there) else (np.zeros(0, np.int64),) * 3
    if not len(u):
        return
    node, comp, main = (run.column(c).to_numpy() for c in ("node", "component", "main"))
    side = [-(-len(np.unique(x)) // CELL) for x in (u, v)]
    at_u, at_v = (mixed(node[x].view(np.uint64)) % np.uint64(n) for x, n in zip((u, v), side, strict=True))
    seed = BASE
    for k in BLOCK_KEY:
        seed = mixed(seed ^ np.array([run.column(k)[0].as_py()], np.int64).view(np.uint64)) + BASE
    cell = mixed(seed ^ (at_u * np.uint64(side[1]) + at_v + np.uint64(1))).view(np.int64)
    rows = np.unique(np.concatenate([np.stack([cell, np.ones_like(cell), u]), np.stack([cell, np.zeros_like(cell), v])], axis=1), axis=1)
    at = rows[2]
    yield pa.RecordBatch.from_arrays([pa.array(rows[0]), pa.array(np.full(len(at), there[0], np.int32)), pa.array(rows[1].astype(np.int32)), *map(pa.array, (node[at], comp[at], main[at]))], names=[c.split()[0] for c in MEMBERS.split(", ")])


def open_cells(members: DataFrame, found: DataFrame, reps: DataFrame, least_equal: int) -> DataFrame:
    """Cells of texts to verify, from the buckets whose texts are in several components.

    A bucket of n texts, m of them outside its largest component, is cut in n / ``BLOCK`` blocks of members and
    m / ``BLOCK`` parts of outsiders; an outsider is sent to each block and a member to each part, with signatures only.
    """
    named = members.select("bucket", "node").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    per = named.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    several = per.groupBy("bucket").agg(F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("most"), F.count("*").alias("components")).where("components > 1")
    several = several.select("bucket", F.col("most.component").alias("main"), F.ceil(F.col("n") / BLOCK).alias("blocks"), F.ceil((F.col("n") - F.col("most.n")) / BLOCK).alias("parts"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    rows = named.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS))).join(several, ["bucket", "salt"]).join(reps.select("node", "signature"), "node")
    span = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    member = F.transform(span("parts"), lambda p: F.struct(F.lit(0).alias("role"), F.expr("pmod(xxhash64(node), blocks)").alias("block"), p.alias("part")))
    outsider = F.transform(span("blocks"), lambda b: F.struct(F.lit(1).alias("role"), b.alias("block"), F.expr("pmod(xxhash64(1, node), parts)").alias("part")))
    sent = rows.withColumn("to", F.explode(F.when(F.col("component") == F.col("main"), member).otherwise(F.concat(member, outsider)))).select("bucket", "to.*", "node", "component", "main", "signature")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, BLOCK_KEY):
            yield from involved(run, least_equal)

    return sent.repartition(*BLOCK_KEY).sortWithinPartitions(*BLOCK_KEY).mapInArrow(compare, MEMBERS)


def cell_links(cells: DataFrame, texts: DataFrame, held: Broadcast, least_equal: int) -> DataFrame:
    """Links (a, b) among the pairs of each cell, whose texts are sent there once; pairs that agree most go first.

    Pairs that are by then in one component are skipped, as they can't change the groups. Pairs that fail leave no row.
    """
    rows = cells.join(texts, "node")
    columns = ["cell", "band", "role", "node", "component", "main", "signature", "text"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ["cell"]):
            root: dict[int, int] = {}

            def top(x: int) -> int:
                while root.get(x, x) != x:
                    x = root[x]
                return x

            node, comp, links = run.column("node").to_pylist(), run.column("component").to_pylist(), []
            known = held.value.described(run.column("text").combine_chunks())
            u, v, _ = candidates(run, run.column("band")[0].as_py(), least_equal)
            for i, j in zip(u.tolist(), v.tolist(), strict=True):
                x, y = top(comp[i]), top(comp[j])
                if x != y and held.value.linked(known[i], known[j]):
                    root[max(x, y)] = min(x, y)
                    links.append((node[i], node[j]))
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in links], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return rows.select(*columns).repartition("cell").sortWithinPartitions("cell").mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, least_equal: int = LEAST_EQUAL) -> DataFrame:
    """Rows doc_id, class_id, component_id, kept: one for each document.

    ``least_equal`` of 0 verifies every pair that shares a bucket and isn't in one component yet; more skips pairs with
    fewer equal samples of 64.

    ``class_id`` is the smallest doc_id with an equal text, ``component_id`` the smallest doc_id of the near-duplicate
    group, and ``kept`` marks that document. A null text is empty; empty texts and texts without a word form classes of
    equal texts and are linked with nothing else. A null doc_id joins no class: its row has null ids and is kept. Rows
    that repeat in full are answered alike. Other columns are ignored.
    """
    return judged(docs, similarity, least_equal).select("doc_id", "class_id", "component_id", "kept")


KEYS = {"key1": lambda text: F.xxhash64(text), "key2": lambda text: F.xxhash64(F.lit(1), text)}


def judged(docs: DataFrame, similarity: float = SIMILARITY, least_equal: int = LEAST_EQUAL) -> DataFrame:
    """The rows of ``near_duplicates`` with key1 and key2, hashes of the text, and ``group``, one value for each group."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumns({name: of(F.col("text")) for name, of in KEYS.items()})
    held = docs.sparkSession.sparkContext.broadcast(Weights(inverse_frequency(*document_frequency(rows)), similarity))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", *KEYS)), pa.array(signatures(part.column("text"), held.value.idf), pa.binary())], names=["doc_id", *KEYS, "signature"])

    signed = stage(rows.mapInArrow(sign, "doc_id long, key1 long, key2 long, signature binary"), "signatures")
    own = signed.where("doc_id is not null").groupBy(*KEYS, "doc_id").agg(F.count("*").alias("rows"), F.first("signature").alias("signature"))
    classes = own.groupBy(*KEYS).agg(F.min(F.struct("doc_id", "rows")).alias("least"), F.first("signature").alias("signature"))
    classes = stage(classes.select(F.monotonically_increasing_id().alias("node"), *KEYS, F.col("least.doc_id").alias("class_id"), F.col("least.rows").alias("rows"), "signature"), "classes")
    reps = classes.where("signature is not null").select("node", "signature")
    members = stage(bucket_members(band_rows(reps)), "buckets")
    texts = stage(texts_of(members.select("node"), rows, classes), "texts")
    links = stage(star_links(members.where("node <> anchor").select(F.col("anchor").alias("a"), F.col("node").alias("b")).distinct(), texts, held), "links")
    found = components(links)
    cells = stage(open_cells(members, found, reps, least_equal), "cells")
    if not cells.isEmpty():
        found = components(links.unionByName(stage(cell_links(cells, texts, held, least_equal), "links")))
    held.destroy()
    found = found.join(classes.select("node", "class_id"), "node")
    lowest = found.groupBy("component").agg(F.min("class_id").alias("component_id"))
    groups = found.join(lowest, "component").select("node", "component", "component_id")
    named = classes.select("node", *KEYS, "class_id").join(groups, "node", "left")
    named = stage(named.select(*KEYS, "class_id", F.coalesce("component", "node").alias("group"), F.coalesce("component_id", "class_id").alias("component_id")), "groups")
    out = signed.select("doc_id", *KEYS).join(named, [*KEYS], "left")
    known = F.col("doc_id").isNotNull()
    return out.select("doc_id", F.when(known, F.col("class_id")).alias("class_id"), F.when(known, F.col("component_id")).alias("component_id"), F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), *KEYS, "group")


def without_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, least_equal: int = LEAST_EQUAL) -> DataFrame:
    """One document of each near-duplicate group, that with the smallest doc_id, with all columns of ``docs``.

    Documents without a doc_id stay. Rows are told apart by doc_id and text, so unlike texts under one doc_id all stay.
    Where several texts of a group have its smallest doc_id, that with the smallest hash stays; where rows repeat a kept
    id and text, one of them stays.
    """
    found = judged(docs, similarity, least_equal).where("kept and doc_id is not null")
    texts = found.groupBy("group", "doc_id", *KEYS).agg(F.count("*").alias("rows"))
    id_, one, two = (unused(docs, n) for n in ("_id", "_key1", "_key2"))
    least = texts.groupBy("group").agg(F.min(F.struct("key1", "key2", "doc_id", "rows")).alias("least"))
    keep = stage(least.select(F.col("least.doc_id").alias(id_), F.col("least.key1").alias(one), F.col("least.key2").alias(two), "least.rows"), "kept")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    named = docs.withColumns({id_: F.col("doc_id").cast("long"), one: KEYS["key1"](text), two: KEYS["key2"](text)})
    pair = [id_, one, two]
    stay = named.join(keep.select(*pair), pair, "left_semi")
    if not keep.where("rows > 1").isEmpty():
        again = keep.where("rows > 1").select(*pair)
        # which of the rows stays is decided by their other columns, not by the order in which they are met
        first = F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("row")
        stay = stay.join(again, pair, "left_anti").select(*docs.columns).unionByName(stay.join(again, pair, "left_semi").groupBy(*pair).agg(first).select("row.*"))
    return stay.select(*docs.columns).unionByName(named.where(F.col(id_).isNull()).select(*docs.columns))
