"""Connected components of a graph kept in Spark."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def connected(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node that an edge (``a``, ``b``) touches.

    Alternates two steps until nothing changes: every node hands its larger neighbours to the smallest one it knows,
    then its smaller ones. Each step is a grouping and a join; a node with many neighbours needs only their minimum.
    Rounds grow with the logarithm of the longest path. The edges of each round are written to the shared folder.
    """
    both = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = written(both, "edges")
    mark = _mark(now)
    for _ in range(max_rounds):
        now = written(_small_star(_large_star(now)), "edges")
        after = _mark(now)
        if after == mark:
            break
        mark = after
    else:
        raise RuntimeError("the components did not settle")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked with its smallest neighbour (or itself)."""
    around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # written, so that the join stands between two plain shuffles and a node with very many neighbours can be split
    least = written(around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    larger = edges.select(F.col("b").alias("a"), F.col("a").alias("v"))
    return larger.join(least, "a").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked with the smallest of them."""
    least = written(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    smaller = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return smaller.unionByName(own).where("a != b").distinct()


def roots(n: int, i: np.ndarray, j: np.ndarray) -> list[int]:
    """The smallest node that each of ``n`` nodes is connected with, for the edges of one unit of work."""
    up = list(range(n))

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in zip(i.tolist(), j.tolist()):
        a, b = find(a), find(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]
