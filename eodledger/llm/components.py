"""Connected components of a graph that is only ever a table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eodledger.session import stored


def forest(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the trees of ``a[i]`` and ``b[i]`` for every i; every node then points at its root.

    ``parent`` is such a flat forest already. The root of a tree is its smallest node.
    """
    while len(a):
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            break
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while (up := parent[parent]).tobytes() != parent.tobytes():
            parent = up
    return parent


def components(nodes: DataFrame, edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node: the smallest node reachable over ``edges (u, v)``.

    Two steps alternate: every larger neighbour of a node is tied to the smallest node around it,
    then every node and its smaller neighbours to their smallest. The edges end as stars around
    the roots, after a number of rounds that grows with the logarithm of the longest chain. Each
    round is a minimum per node, combined before its exchange, and one join, in which adaptive
    execution can split the neighbours of a frequent node; its edges are written to the shared
    folder, so a lost executor costs one round at most. Only two numbers reach the driver.
    """
    now = stored(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(now)
    for _ in range(most_rounds):
        if not state[0]:
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("w"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("w").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("w"))
        tied = large.join(low, "u")
        small = tied.filter("v <> w").select(F.col("v").alias("u"), F.col("w").alias("v")).unionByName(
            low.select("u", F.col("w").alias("v"))
        ).distinct()
        now = stored(small, "edges")
        if (after := _state(now)) == state:
            break
        state = after
    else:
        raise RuntimeError("components did not settle")
    return nodes.join(now.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left").select(
        "node", F.coalesce("root", "node").alias("root")
    )


def _state(edges: DataFrame) -> tuple:
    """Count and sum of hashes of the edges: equal for equal sets of edges."""
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]
