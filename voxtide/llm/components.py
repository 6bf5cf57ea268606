"""Connected components of an edge table by alternating large and small stars.

Each task first turns its edges into a forest of stars (at most an edge a vertex).
Then each round links every vertex to the smallest vertex of its neighbourhood,
first towards larger neighbours, then among smaller ones.  Edge counts never
grow.  Rounds are written to the checkpoint folder, so a lost executor costs one
round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtide.llm.common import materialize

#: Edges that a task contracts at once.
FOREST = 1_000_000


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each vertex of the edges and the smallest vertex that they join it to."""
    vertex, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[:len(a)], at[len(a):]
    label = np.arange(len(vertex))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        for end in (a, b):
            np.minimum.at(new, label[end], least)
            np.minimum.at(new, end, least)
        new = new[new]
        if (new == label).all():
            return vertex, vertex[label]
        label = new


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def star(parts):
        a, b = _stars(*(np.concatenate(c) for c in zip(*parts)))
        return pa.RecordBatch.from_arrays([pa.array(a[a != b]), pa.array(b[a != b])], ["a", "b"])

    parts, size = [], 0
    for batch in batches:
        parts.append(tuple(batch.column(i).to_numpy() for i in (0, 1)))
        size += batch.num_rows
        if size >= FOREST:
            yield star(parts)
            parts, size = [], 0
    if size:
        yield star(parts)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges come as (larger, smaller)."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    met = edges.join(least, "a")
    return met.where("b > least").select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges between bigint vertices → (vertex, root): every vertex that
    has an edge to another, and the smallest vertex of its component, which has
    its own row too."""
    edges, seen = materialize(edges.where("a <> b").mapInArrow(_forest, "a bigint, b bigint").distinct(), "components"), None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").bitwiseAND(F.lit((1 << 40) - 1)))).first()
        if mark == seen:
            break
        seen = mark
        edges = materialize(_small_star(_large_star(edges)), "components")
    return edges.select(F.col("a").alias("vertex"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("vertex"), F.col("b").alias("root")).distinct())
