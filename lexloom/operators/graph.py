"""Depth-limited collection over a category graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.shared import cut

#: Nodes after which no further level is begun.
MAX_NODES = 5000


def collect(edges: DataFrame, seeds: DataFrame, max_depth: int, max_nodes: int | None = None) -> DataFrame:
    """``node, depth`` of all nodes within ``max_depth`` steps, each at its least depth.

    ``edges (parent, child)``, ``seeds (node)``.  One join a level, and an
    anti-join against the nodes already met; breadth first, so that the result
    does not depend on an order of visits.  Each level is computed once, into
    the shared folder, so that the plan doesn't grow with the depth.  With
    ``max_nodes`` no level is begun once more nodes have been met.
    """
    levels = [cut(seeds.select("node").distinct())]
    for _ in range(max_depth):
        if max_nodes is not None and sum(x.count() for x in levels) > max_nodes:
            break
        step = edges.join(levels[-1], F.col("parent") == F.col("node"), "left_semi").select(F.col("child").alias("node")).distinct()
        for known in levels:
            step = step.join(known, "node", "left_anti")
        levels.append(cut(step))
        if levels[-1].isEmpty():
            break
    found = levels[0].withColumn("depth", F.lit(0))
    for depth, level in enumerate(levels[1:], 1):
        found = found.unionByName(level.withColumn("depth", F.lit(depth)))
    return found


def members(categories: DataFrame, pages: DataFrame) -> DataFrame:
    """Distinct titles of the pages of collected categories; ``pages (parent, title)``."""
    return categories.join(pages, categories["node"] == pages["parent"]).select("title").distinct()


def from_api(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges and pages of landed rows ``parent, title, ns``: 14 is a category, 0 a page, others go."""
    edges = rows.where("ns = 14").select("parent", F.col("title").alias("child"))
    return edges, rows.where("ns = 0").select("parent", "title")
