"""Connected components: of few edges on the driver, of more by alternating large and small stars on the cluster."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkscan.llm.common import cut

#: Up to so many edges (8 MB) go to the driver: there a round costs no shuffles. Both ways give the same.
GATHERED = 1 << 19


def components(edges: DataFrame, roots: bool = False) -> DataFrame:
    """(node, root) for all nodes of ``edges`` (u, v: long); the roots, the least of their component, only with ``roots``.

    ``edges`` is read more than once: a written table, or little more than one.
    """
    if edges.count() <= GATHERED:
        return _gathered(edges, roots)
    stars = _stars(edges)
    return cut(stars.union(stars.select("root", "root").distinct())) if roots else stars


def _gathered(edges: DataFrame, roots: bool) -> DataFrame:
    found = edges.where("u <> v").select("u", "v").toArrow()
    node, root = least_reachable(found["u"].to_numpy(), found["v"].to_numpy())
    kept = slice(None) if roots else node != root
    table = pa.table({"node": pa.array(node[kept], pa.int64()), "root": pa.array(root[kept], pa.int64())})
    return cut(edges.sparkSession.createDataFrame(table, "node long, root long"))


def least_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All nodes, sorted, and the least node of each one's component.

    Roots hook on to their least neighbour, then all nodes jump to their root. In two rounds a root gains
    another or is hooked itself, so there are O(log n) of them.
    """
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return nodes, nodes[root]
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]


def _stars(edges: DataFrame) -> DataFrame:
    now = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(now)
    while True:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = cut(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        now = cut(small.distinct())
        after = _state(now)
        if after == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = after


def _state(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.shiftright(h, 20)), F.expr("bit_xor(xxhash64(u, v))")).first())
