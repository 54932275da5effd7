"""Connected components of a graph that may be larger than any machine: alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage

MOST_ROUNDS = 60
#: Edges that a task gathers before it contracts them (16 bytes each).
AT_ONCE = 1 << 20


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the smallest of its component within the links (a, b)."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a partition as stars, so that fewer rounds are needed over all of them."""
    a, b, held = [], [], 0

    def stars() -> pa.RecordBatch:
        u, v = local_forest(np.concatenate(a), np.concatenate(b))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    for batch in batches:
        a.append(batch.column(0).to_numpy())
        b.append(batch.column(1).to_numpy())
        held += batch.num_rows
        if held > AT_ONCE:
            yield stars()
            a, b, held = [], [], 0
    if held:
        yield stars()


def merged(edges: DataFrame, n: int) -> DataFrame:
    """``n`` edges contracted where they lie, dealt by their first end to tasks of about ``AT_ONCE`` and contracted again."""
    here = edges.mapInArrow(contracted, "u long, v long")
    return here.repartition("u").coalesce(-(-n // AT_ONCE) or 1).mapInArrow(contracted, "u long, v long")


def settled(star: DataFrame) -> tuple[bool, int]:
    """Whether each node is either a centre or points at one centre, so that the stars are the components; their edges."""
    ends = star.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("out")), F.struct(F.col("v").alias("node"), F.lit(0).alias("out")))).alias("e")).select("e.*")
    per = ends.groupBy("node").agg(F.sum("out").alias("out"), F.min("out").alias("centre"))
    open_nodes, edges = per.agg(F.count_if(F.expr("out > 1 or (out = 1 and centre = 0)")), F.sum("out")).first()
    return not open_nodes, edges or 0


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) from edges (a, b) of long ids; the component is the smallest id reachable.

    Nodes without an edge to another node are left out; edges that repeat, loops and nulls do no harm. Every round is
    written to the shared folder; a task holds at most about ``AT_ONCE`` edges, and of a hub only its smallest neighbour
    is gathered. ``edges`` should be a written table, as it is read twice.
    """
    least = lambda e: e.groupBy("u").agg(F.min("v").alias("m"))
    known = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a is not null and b is not null and a <> b")
    star = stage(merged(known, known.count()), "edges")
    for _ in range(MOST_ROUNDS):
        done, n = settled(star)
        if done:
            break
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = least(both).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.join(least(large), "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        star = stage(merged(small, n), "edges")
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    return star.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(star.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
