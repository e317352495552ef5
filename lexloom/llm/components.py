"""Connected components of an undirected graph given as a table of edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .skew import lookup


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the edges of one batch: every node with its root, the least node.

    Batches are of bounded size, and so is the state; what batches leave
    unjoined is joined by the rounds that follow.
    """
    for batch in batches:
        a, b = batch["a"].to_numpy(zero_copy_only=False), batch["b"].to_numpy(zero_copy_only=False)
        nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
        parent = list(range(len(nodes)))

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for x, y in zip(at[: len(a)].tolist(), at[len(a) :].tolist(), strict=True):
            x, y = find(x), find(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        root = np.array([find(x) for x in range(len(nodes))], np.int64)
        keep = root != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(nodes[root[keep]])], ["a", "b"])


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``; component is the least node reachable.

    Edges are contracted by union-find inside batches; then large-star and
    small-star rounds alternate until nothing changes.  Each round moves a
    number of rows of the order of the edges, with partial minima before the
    shuffle, and is written to a shared table.  A node with very many edges
    gets its minimum by broadcast (:func:`skew.lookup`).
    """
    edges = edges.where("a <> b")
    now = scratch.table(edges.mapInArrow(_forest, "a bigint, b bigint"), "forest")
    before, n = None, now.count()
    while True:
        # Large star: to each neighbour above a node goes the least of the node's neighbourhood.
        both = now.union(now.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("c")).select("u", F.least("u", "m").alias("m"), "c")
        large = lookup(both.where("v > u"), ["u"], least, "c", 2 * n, 2 * n).select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b")
        # Small star: a node and its lower neighbours go to the least of them.
        low = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
        low = scratch.table(low, "large")
        least = low.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("c"))
        small = lookup(low, ["u"], least, "c", 2 * n, 2 * n).select("u", "v", "m")
        after = small.select(F.col("v").alias("a"), F.col("m").alias("b")).union(small.select("u", "m")).where("a <> b").distinct()
        scratch.drop(now)
        now = scratch.table(after, "small")
        scratch.drop(low)
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before, n = mark, mark[0]
    # All edges now lead from a node to its component.
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b"), F.col("b")).distinct())
