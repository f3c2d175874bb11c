"""Connected components of a large graph by alternating star contractions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import drop, stored


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest index reachable from each of ``n`` nodes by the links ``a[k] - b[k]``."""
    low = np.arange(n)
    while len(a):
        x, y = low[a], low[b]
        apart = x != y
        if not apart.any():
            break
        a, b = a[apart], b[apart]
        x, y = x[apart], y[apart]
        np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(higher := low[low], low):
            low = higher
    return low


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; component is its smallest node.

    Each round links all larger neighbours of a node to the smallest one around it, then all
    smaller ones; rounds are as many as the logarithm of the longest path, each is two
    aggregates and two sort-merge joins over the links, which only become fewer.  Nothing but
    one row of digests per round reaches the driver, no side of a join passes through it.  Nulls and loops are ignored.
    """
    links = stored(edges.where("a is not null and b is not null and a <> b")
                   .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    seen = _digest(links)
    while seen[0]:
        both = links.union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least.hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(small_least.hint("merge"), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(small_least.select("u", F.col("m").alias("v"))).distinct())
        following = stored(small, "links")
        now = _digest(following)
        drop(links)
        links = following
        if now == seen:
            break
        seen = now
    roots = links.select(F.col("v").alias("node")).distinct()
    return (links.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(roots.select("node", F.col("node").alias("component"))))


def _digest(links: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(links.agg(F.count("*"), F.bit_xor(h), F.sum(h.bitwiseAND(F.lit((1 << 40) - 1)))).first())
