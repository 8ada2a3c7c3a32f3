"""Connected components of a graph that is a table of edges."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guidepost.plans import apart
from guidepost.sources.scratch import snapshot


class Forest:
    """Union-find over the numbers below ``size``; a root is the smallest number of its tree."""

    def __init__(self, size: int):
        self.parent = np.arange(size)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            while True:
                up = self.parent[self.parent]
                if np.array_equal(up, self.parent):
                    break
                self.parent = up
            a, b = self.parent[a], self.parent[b]
            apart_ = a != b
            if not apart_.any():
                return
            pairs = np.unique(np.stack([a[apart_], b[apart_]]), axis=1)
            a, b = pairs
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


def _rewired(edges: DataFrame) -> DataFrame:
    """One round over edges (high, low): each node's neighbours below it hang on the least of
    them, then each node's neighbours above it hang on its least neighbour."""

    def least(df: DataFrame) -> DataFrame:
        smallest = df.groupBy("high", apart("high")).agg(F.min("low").alias("least"))
        return smallest.select(F.col("high").alias("node"), "least")

    def oriented(df: DataFrame, a: str, b: str) -> DataFrame:
        return df.where(F.col(a) != F.col(b)).select(
            F.greatest(a, b).alias("high"), F.least(a, b).alias("low")
        )

    below = edges.join(least(edges), F.col("high") == F.col("node"))
    small = oriented(below, "low", "least").union(oriented(below, "high", "least")).distinct()
    small = snapshot(small, "component-edges")
    both = small.union(small.select(F.col("low").alias("high"), F.col("high").alias("low")))
    around = both.join(least(both), F.col("high") == F.col("node")).where("low > high")
    target = F.least("least", "high")
    return around.select(F.col("low").alias("high"), target.alias("low")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """For edges (high, low) with high > low: node and root, the least node of its component.

    A row for each node that is not a root itself. Rounds go on until every node
    hangs on its root; their number grows with the logarithm of the longest path. Each round is a
    stored table.
    """
    edges = snapshot(edges.distinct(), "component-edges")
    while True:
        inner = edges.select(F.col("low").alias("high")).join(edges, "high", "left_semi")
        several = edges.groupBy("high").count().where("count > 1")
        if not inner.limit(1).count() and not several.limit(1).count():
            return edges.select(F.col("high").alias("node"), F.col("low").alias("root"))
        edges = snapshot(_rewired(edges), "component-edges")
