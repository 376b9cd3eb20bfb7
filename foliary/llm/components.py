"""Connected components by alternating star contractions, as DataFrames.

Only edges are shuffled; each round sends neighbours to the smallest vertex
they know, larger ones through a large star, smaller ones through a small
star, until nothing changes. Up to ONE_TASK edges (2 MiB) are settled by one
task instead, with the same result. No vertex list, edge list or component reaches
the driver, and the minimum per vertex is combined before the shuffle, so a
vertex with a third of all edges stays cheap. Joins leave room for Spark to
split a hot vertex.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliary.llm.common import discard, few, hold, materialise

#: Edges that one task settles.
ONE_TASK = 1 << 17


def _star(edges: DataFrame, keep) -> DataFrame:
    """For each vertex u with smallest neighbour m (itself included): edges from the kept neighbours to m."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return edges.join(least, "u").where(keep).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least.where("u <> m").select("u", F.col("m").alias("v")))


def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All edges (u, v) of a task to (u, v): each vertex and the smallest it reaches. Labels sink along edges until they rest."""
    hold("components")
    held = list(batches)
    if not sum(b.num_rows for b in held):
        return
    u, v = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("u", "v"))
    names, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(names))
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        for ends in (label[a], label[b], a, b):
            np.minimum.at(label, ends, low)
        while not np.array_equal(label[label], label):
            label = label[label]
        if np.array_equal(before, label):
            break
    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(names[label])], ["u", "v"])


def connected_components(edges: DataFrame, most_rounds: int = 60, one_task: int = ONE_TASK, rows: int | None = None) -> DataFrame:
    """(vertex, component): the smallest vertex reachable, for each vertex that an edge (a, b) names.

    Null ends and edges from a vertex to itself are left out; repeated edges
    count once. A vertex without another is not returned. ``rows`` says about
    how many edges there are, if that is known.
    """
    once = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("a is not null and b is not null and a <> b").distinct()
    now = materialise(once if rows is None else few(once, rows, ONE_TASK))
    n = now.count()
    if n <= one_task:
        before, now = now, materialise(now.coalesce(1).mapInArrow(settled, now.schema))
        discard(before)
        return now.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
    mark = None
    for _ in range(most_rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, F.col("v") > F.col("u")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        small = _star(large, F.col("v") < F.col("u")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        before, now = now, materialise(small)
        discard(before)
        fresh = now.agg(F.count("*").alias("n"), F.expr("coalesce(bit_xor(xxhash64(u, v)), 0)").alias("x"), F.expr("coalesce(sum(pmod(xxhash64(v, u), 1000003)), 0)").alias("s")).first()
        if tuple(fresh) == mark:
            break
        mark = tuple(fresh)
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("vertex"), F.col("v").alias("component")).union(now.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct())
