"""Connected components of a graph given by its edges, as Spark jobs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickflow.scratch import new_folder

# Edges that one task contracts: 16 bytes each.
TASK_EDGES = 1_000_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) with the components of the edges a-b."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = np.arange(len(nodes))
    left, right = ends[: len(a)], ends[len(a) :]
    while True:
        # Hook the larger root below the smaller one, then shorten all paths.
        x, y = root[left], root[right]
        apart = x != y
        if not apart.any():
            break
        left, right, x, y = left[apart], right[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            shorter = root[root]
            if (shorter == root).all():
                break
            root = shorter
    low = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[low], nodes[root[low]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a partition's components as stars, far fewer rows for dense parts."""
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if held:
        a, b = forest(*(np.concatenate(x) for x in zip(*held, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every node that is
    not a root itself, from edges ``a``, ``b`` (long).

    Edges are first contracted within partitions of about ``TASK_EDGES``. If there are more
    than one, large-star and small-star steps alternate until nothing changes, which takes
    about the logarithm of the longest path. Each step joins nodes with their smallest
    neighbour, so a node with very many neighbours is split by the skew join and never
    gathered; edges are written to the shared folder after each round, which cuts the
    lineage."""
    spark = edges.sparkSession

    def written(frame: DataFrame) -> tuple[DataFrame, tuple]:
        path = new_folder(spark, "components")
        frame.write.parquet(path)
        back = spark.read.schema("a long, b long").parquet(path)
        state = back.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return back, tuple(state)

    raw, state = written(edges.select("a", "b"))
    parts = -(-state[0] // TASK_EDGES) or 1
    contracted = raw.coalesce(parts).mapInArrow(_contract, "a long, b long")
    if parts == 1:
        stars, _ = written(contracted)
        return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))

    # Edges lead from the larger node to the smaller.
    stars, state = written(contracted.distinct())
    while state[0]:
        # Large star: larger neighbours go to the smallest of all neighbours.
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Small star: a node and its smaller neighbours go to the smallest of them.
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        own = F.struct("a", F.col("m").alias("b"))
        other = F.struct(F.col("b").alias("a"), F.col("m").alias("b"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(own, other)).alias("e"))
            .select("e.a", "e.b")
            .where("a != b")
            .distinct()
        )
        before = state
        stars, state = written(small)
        if state == before:
            break
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
