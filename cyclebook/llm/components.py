"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclebook.llm.shared import staged


def local_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(member, smallest member) for each component of the links a-b, without the smallest itself.

    A block of links shrinks to fewer rows than it has members, and connects the same ones.
    """
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
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
    member = label != np.arange(len(nodes))
    return nodes[member], nodes[label[member]]


def _unfinished(edges: DataFrame) -> bool:
    """Whether some node has two parents, or a parent itself has one."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    roles = ends.groupBy("n").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return bool(roles.filter("up > 1 or (up = 1 and down > 0)").limit(1).take(1))


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node in ``links(a, b)``; component is the smallest node reachable.

    Null ends and loops link nothing; repeated links count once. An empty table has no nodes.
    Each round is a few equi-joins and grouped minima on the links; a node with very many links
    is a skewed join side, which adaptive execution splits. The links of a round are written to
    the shared folder, so a lost executor never restarts the loop.
    """
    edges = staged(
        links.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while _unfinished(edges):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = staged(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(low.select("u", F.col("m").alias("v"))).distinct())
        edges = staged(small, "small-star")
    children = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return children.unionAll(edges.select(F.col("v").alias("node"),
                                          F.col("v").alias("component")).distinct())
