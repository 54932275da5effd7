"""Operator 3: embedding near-duplicates over an inverted multi-index.

Unit vectors are cut in two halves and each half has a codebook, fitted on a bounded sample; the two nearest codewords
name the cell of a vector, so two small codebooks make a fine product grid. Every vector is indexed and every vector is
a query. For a query, a cell has a lower bound on the distance to anything inside it (the distances of both halves to
the bisecting planes of their codewords). A multi-sequence traversal visits the cells of a query from the lowest bound
on and stops where the target recall is reached: at recall 1 that is the distance that belongs to the cosine, beyond
which no link can lie; below 1 it is the bound within which that share of the links among the sample was found. A query
visits its own cell and those that come after it, since the other end of a link visits no less: a pair is met from the
end in the earlier cell and counts for both. What is found is verified in double precision.

Equal vectors of a label are one class with a number and a count. Cells with many vectors are cut into blocks, so no task
gets all vectors of a cell. Links are counted where they are found; only a spanning forest of each block leaves it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage
from tidemark.llm.components import components, local_forest

COSINE = 0.98
#: Most vectors that the codebooks are fitted on: those with the smallest hashes.
SAMPLE = 4096
VECTORS_PER_CELL = 64
#: Codewords of a half: at least these, and at most a quarter of the sample, as a codeword needs points. Cells that are
#: large all the same are cut into blocks.
LEAST_WORDS = 4
#: Links among the sample from which a recall below 1 is calibrated; with fewer the traversal goes as far as for 1.
LEAST_LINKS = 50
RECALL = 1.0
#: Codewords closer than this have no plane that double precision can place; both regions are visited.
LEAST_GAP = 1e-3
PLACED_AT_ONCE = 1_000
INDEX_BLOCK, QUERY_BLOCK = 1024, 4096
SEED = 20240302


def codebook(points: np.ndarray, words: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's algorithm from evenly spaced sample points; words that lose all points stay where they are."""
    centres = points[np.linspace(0, len(points) - 1, min(words, len(points))).astype(int)].copy()
    for _ in range(rounds):
        near = (np.square(centres).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)
        for k in np.unique(near):
            centres[k] = points[near == k].mean(axis=0)
    return np.unique(centres, axis=0)


def unseen(dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Codebooks for vectors of a length that the sample doesn't hold: random directions, the same in every process."""
    rng = np.random.default_rng((SEED, dim))
    halves = (rng.normal(size=(LEAST_WORDS, n)) for n in (dim // 2, dim - dim // 2))
    return tuple(h / np.sqrt(2 * np.square(h).sum(axis=1, keepdims=True)) for h in halves)


def unit(flat: np.ndarray, dim: int) -> np.ndarray:
    """Unit vectors in double precision; components are scaled first, so that squares neither vanish nor overflow."""
    x = flat.astype(np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.square(x).sum(axis=1, keepdims=True))


def bounds(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest codeword of each point, and a lower bound on its distance to each codeword's region."""
    d = np.square(points).sum(axis=1, keepdims=True) - 2 * points @ centres.T + np.square(centres).sum(axis=1)
    near = d.argmin(axis=1)
    gap = np.sqrt(np.maximum(np.square(centres).sum(axis=1)[:, None] - 2 * centres @ centres.T + np.square(centres).sum(axis=1), 0))
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = (d - d[np.arange(len(d)), near][:, None]) / (2 * gap[near])
    plane[gap[near] < LEAST_GAP] = 0
    plane[np.arange(len(d)), near] = 0
    return near, np.maximum(plane, 0)


def multi_sequence(left: np.ndarray, right: np.ndarray, radius: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Query, left word and right word of the cells within the radius, each query's nearest cell first.

    Both lists of a query are sorted by bound. For each left word the next right word waits; the nearest waiting cell is
    visited and its left word moves on. All queries take a step at a time and drop out where their nearest cell is
    beyond the radius.
    """
    first, second = left.argsort(axis=1, kind="stable"), right.argsort(axis=1, kind="stable")
    l2, r2 = (np.square(np.take_along_axis(x, order, 1)) for x, order in ((left, first), (right, second)))
    limit = radius * radius
    l2 = l2[:, : max(1, int((l2 <= limit).sum(axis=1).max(initial=0)))]
    r2 = np.concatenate([r2, np.full((len(r2), 1), np.inf)], axis=1)
    at, waiting, query = np.zeros(l2.shape, np.int64), l2 + r2[:, :1], np.arange(len(l2))
    while len(query):
        i = waiting[query].argmin(axis=1)
        near = waiting[query, i] <= limit
        query, i = query[near], i[near]
        j = at[query, i]
        yield query, first[query, i], second[query, j]
        at[query, i] = j + 1
        waiting[query, i] = l2[query, i] + r2[query, j + 1]


def stop_radius(points: np.ndarray, labels: list, books: tuple[np.ndarray, np.ndarray], cosine: float, recall: float) -> float:
    """How far cells are visited: at recall 1 the distance of the cosine, else what held that share of the sample's links."""
    whole = float(np.sqrt(2 - 2 * cosine))
    if recall < 1:
        half = points.shape[1] // 2
        (n1, b1), (n2, b2) = bounds(points[:, :half], books[0]), bounds(points[:, half:], books[1])
        kind = np.unique([str(x) for x in labels], return_inverse=True)[1]
        found = []
        for x in range(0, len(points), 512):
            i, j = np.nonzero((points[x : x + 512] @ points.T >= cosine) & (kind[x : x + 512][:, None] == kind[None, :]))
            i, j = i[i + x != j] + x, j[i + x != j]
            found.append(np.sqrt(np.square(b1[i, n1[j]]) + np.square(b2[i, n2[j]])))
        far = np.concatenate(found)
        if len(far) >= LEAST_LINKS:
            whole = min(whole, float(np.quantile(far, recall, method="higher")))
    return whole + 1e-7


def near_vectors(table: DataFrame, cosine: float = COSINE, recall: float = RECALL, sample: int = SAMPLE) -> DataFrame:
    """Rows vec_id, n_links, component_id, kept from (vec_id, embedding, label): one for each row.

    Only vectors of one label and one length are compared. Vectors that are null, empty, zero or hold null or non-finite
    components, and those with a null label, link with nothing. Rows that repeat an id are counted each; a null id is
    answered with a null component and kept. ``recall`` is the target of the visits (1, the default: complete). Other
    columns are ignored.
    """
    kind = "float" if dict(table.dtypes)["embedding"] == "array<float>" else "double"
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"), F.col("label").alias("label"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.coalesce(F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = rows.withColumns({"key1": F.when(sound, F.xxhash64("label", "embedding")), "key2": F.when(sound, F.xxhash64(F.lit(1), "label", "embedding"))})
    classes = rows.where("key1 is not null").groupBy("key1", "key2", "label", "embedding").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("n"))
    classes = stage(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    drawn = classes.orderBy("key1", "key2").limit(sample).select("embedding", "label").toArrow()
    points: dict[int, tuple[list, list]] = {}
    for v, label in zip(drawn.column("embedding").to_pylist(), drawn.column("label").to_pylist(), strict=True):
        own, labels = points.setdefault(len(v), ([], []))
        own.append(v)
        labels.append(label)
    size = F.size("embedding")
    shape = classes.where(size.isin(*points)).groupBy(size.alias("dim")).agg(F.count("*").alias("n"), F.approx_count_distinct("label").alias("labels")).collect() if points else []
    books: dict[int, tuple[np.ndarray, np.ndarray, float]] = {}
    for dim, n, labels in shape:
        if dim > 1:
            own = unit(np.array(points[dim][0], np.float64).ravel(), dim)
            words = int(np.clip(np.ceil(np.sqrt(n / max(labels, 1) / VECTORS_PER_CELL)), LEAST_WORDS, max(LEAST_WORDS, sample // 4)))
            pair = tuple(codebook(half, words) for half in (own[:, : dim // 2], own[:, dim // 2 :]))
            books[dim] = (*pair, stop_radius(own, points[dim][1], pair, cosine, recall))
    held = table.sparkSession.sparkContext.broadcast(books)
    whole_radius = float(np.sqrt(2 - 2 * cosine)) + 1e-7

    def place(batches: Iterator[pa.RecordBatch], carried: list[str]) -> Iterator[pa.RecordBatch]:
        """Each vector once in its own cell (role 0), and its query there (role 1) and in each later cell it visits (role 2)."""
        for batch in batches:
            size = batch.column("embedding").value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(size).tolist():
                whole = batch.filter(pa.array(size == dim))
                for part in (whole.slice(x, PLACED_AT_ONCE) for x in range(0, whole.num_rows, PLACED_AT_ONCE)):
                    at = own = np.arange(part.num_rows)
                    home = cell = np.zeros(part.num_rows, np.int64)
                    if dim > 1:
                        left, right, radius = held.value[dim] if dim in held.value else (*unseen(dim), whole_radius)
                        points = unit(part.column("embedding").flatten().to_numpy(), dim)
                        (n1, b1), (n2, b2) = bounds(points[:, : dim // 2], left), bounds(points[:, dim // 2 :], right)
                        home = n1 * len(right) + n2
                        at, n1, n2 = (np.concatenate(x) for x in zip(*multi_sequence(b1, b2, radius), strict=True))
                        cell = n1 * len(right) + n2
                        later = cell >= home[at]
                        at, cell = at[later], cell[later]
                    role = np.concatenate([np.zeros(len(own), np.int32), np.where(cell == home[at], 1, 2).astype(np.int32)])
                    at, cell = np.concatenate([own, at]), np.concatenate([home, cell])
                    part = part.select(carried)
                    for x in range(0, len(at), 10_000):
                        now = part.take(pa.array(at[x : x + 10_000]))
                        yield pa.RecordBatch.from_arrays([*now.columns, pa.array(cell[x : x + 10_000]), pa.array(np.full(now.num_rows, dim, np.int32)), pa.array(role[x : x + 10_000])], names=[*carried, "cell", "dim", "role"])

    plain = classes.select("node", "label", "embedding", "n")
    types = dict(plain.dtypes)

    def placed(*carried: str) -> DataFrame:
        names = list(carried)
        return plain.mapInArrow(lambda batches: place(batches, names), ", ".join([*(f"{c} {types[c]}" for c in names), "cell long, dim int, role int"]))

    key = ["label", "dim", "cell"]
    load = placed("label").groupBy(key).agg(F.ceil(F.count_if(F.col("role") == 0) / INDEX_BLOCK).alias("blocks"), F.ceil(F.count_if(F.col("role") > 0) / QUERY_BLOCK).alias("parts"))
    load = stage(load.where("blocks > 0"), "cell-loads")
    span = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    met = placed("node", "label", "embedding", "n").join(load, key)
    met = met.withColumn("part", F.explode(F.when(F.col("role") == 0, span(F.col("parts"))).otherwise(F.array(F.expr("pmod(xxhash64(node), parts)")))))
    met = met.withColumn("block", F.explode(F.when(F.col("role") > 0, span(F.col("blocks"))).otherwise(F.array(F.expr("pmod(xxhash64(node), blocks)")))))
    keys = [*key, "block", "part"]
    dealt = met.withColumn("group", F.xxhash64(*keys)).select("group", *keys, "role", "node", "n", "embedding").repartition("group").sortWithinPartitions("group", *keys)

    def linked(run: pa.Table) -> Iterator[pa.RecordBatch]:
        role = run.column("role").to_numpy()
        node, n = run.column("node").to_numpy(), run.column("n").to_numpy()
        x = unit(run.column("embedding").combine_chunks().flatten().to_numpy(), run.column("dim")[0].as_py())
        a, q = np.flatnonzero(role == 0), np.flatnonzero(role > 0)
        if not len(a) or not len(q):
            return
        hits = (x[q] @ x[a].T >= cosine) & (node[q][:, None] != node[a][None, :])
        qi, ai = np.nonzero(hits)
        if len(qi):
            u, v = local_forest(node[q][qi], node[a][ai])
            met, far = role[q][qi] == 2, np.zeros(len(a), np.int64)  # the other end of these pairs doesn't come here
            total = np.zeros(len(q), np.int64)
            np.add.at(total, qi, n[a][ai])
            np.add.at(far, ai[met], n[q][qi[met]])
            ends, total = np.concatenate([node[q], node[a]]), np.concatenate([total, far])
            ends, total = ends[total > 0], total[total > 0]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([ends, u])), pa.array(np.concatenate([np.zeros(len(ends), np.int64), v])), pa.array(np.concatenate([total, np.zeros(len(u), np.int64)]))], names=["a", "b", "links"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            now = now if kept is None else pa.concat_tables([kept, now])
            group = now.column("group").to_numpy()
            cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist()]
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                yield from linked(now.slice(x, y - x))
            kept = now.slice(cuts[-1])
        if kept is not None and kept.num_rows:
            yield from linked(kept)

    found = stage(dealt.select("group", "role", "node", "n", "embedding", "dim").mapInArrow(search, "a long, b long, links long"), "vector-links")
    held.destroy()
    counts = found.where("links > 0").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    groups = components(found.where("links = 0").select("a", "b"))
    groups = groups.join(classes.select("node", "least_id"), "node")
    lowest = groups.groupBy("component").agg(F.min("least_id").alias("component_id"))
    plain = classes.select("node", "key1", "key2", "n", "least_id")
    named = plain.join(counts, "node", "left").join(groups.join(lowest, "component").select("node", "component_id"), "node", "left")
    links = F.coalesce("links", F.lit(0)) + F.col("n") - 1
    named = stage(named.select("key1", "key2", links.alias("n_links"), F.coalesce("component_id", "least_id").alias("component_id")), "vector-groups")
    out = rows.select("vec_id", "key1", "key2").join(named, ["key1", "key2"], "left")
    own = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.coalesce(F.col("vec_id") == own, F.lit(True)).alias("kept"))


#: SQL for the result over (vec_id, embedding, label), by comparing all pairs of a label.
ORACLE = """
WITH RECURSIVE sound AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
lowest AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT e.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, least(e.vec_id, coalesce(w.low, e.vec_id)) AS component_id,
  e.vec_id = least(e.vec_id, coalesce(w.low, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN counts c ON c.a = e.vec_id LEFT JOIN lowest w ON w.a = e.vec_id
"""
