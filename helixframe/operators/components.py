"""Connected components of an edge table by alternating large-star and small-star steps, with forests of its parts before them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.operators.scratch import cut_lineage

#: Edges of a part, whose forest one task makes, on average.
PART_EDGES = 1 << 20


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _least_neighbour(directed: DataFrame) -> DataFrame:
    """Each directed edge (u, v) with m: the least of u and all its neighbours. The minimum is combined before the shuffle."""
    least = directed.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return directed.join(least, "u")


def _forest(edges: DataFrame, parts: int) -> DataFrame:
    """(u, v): each node with the smallest node that it reaches by the edges of a part. Edges are dealt to parts by both ends."""

    def roots(table: pa.Table) -> pa.Table:
        nodes, place = np.unique(np.concatenate([table.column(c).to_numpy() for c in "uv"]), return_inverse=True)
        a, b = place[: table.num_rows], place[table.num_rows :]
        root = np.arange(len(nodes))
        while True:
            a, b = root[a], root[b]
            a, b = a[a != b], b[a != b]
            if not len(a):
                break
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root[root] != root).any():
                root = root[root]
        below = root != np.arange(len(nodes))
        return pa.table({"u": nodes[below], "v": nodes[root[below]]})

    part = F.pmod(F.xxhash64("u", "v"), F.lit(parts)).cast("int")
    return edges.select(F.col("u").cast("long"), F.col("v").cast("long"), part.alias("part")).groupBy("part").applyInArrow(roots, "u long, v long")


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", part_edges: int | None = None) -> DataFrame:
    """(node, component) for each node of an edge; component is the smallest node that can be reached.

    Edges are undirected; repeated edges and self loops are allowed, edges with a null end are ignored. Each round
    makes every tree shallower, so that the number of rounds grows with the logarithm of the longest path. No row
    list per node is ever gathered: a node's minimum is aggregated and joined back. part_edges, for nodes that are whole numbers: edges are
    dealt to parts of so many first, each of which becomes a forest in a task; one part needs no round.
    """
    clean = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")
    nodes = cut_lineage(clean.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    stars = cut_lineage(clean.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = _state(stars)
    for _ in range(2 if part_edges else 0):  # forests have fewer edges than nodes, and may fit one part then
        if parts := -(-before[0] // part_edges):
            stars = cut_lineage(_forest(stars, parts).distinct())
            before = _state(stars) if parts > 1 else (0,)
    while before[0]:
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least_neighbour(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        joined = _least_neighbour(down)
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        stars = cut_lineage(small)
        after = _state(stars)
        if after == before:
            break
        before = after
    roots = stars.groupBy("u").agg(F.min("v").alias("v"))
    return nodes.join(roots, nodes["node"] == roots["u"], "left").select("node", F.coalesce("v", "node").alias("component"))
