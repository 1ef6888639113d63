"""Connected components: of index pairs inside a task (numpy), and of an edge table (Spark joins)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskrank.session import cut_lineage


class Forest:
    """Components of the nodes 0..n-1; links are added in bulk and forgotten."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            a, b = self.root[a], self.root[b]
            open_ = a != b
            if not open_.any():
                return
            a, b = a[open_], b[open_]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(u, v): every node `u` that is not the smallest of its component, and that smallest node `v`.

    Large-star and small-star steps alternate until the edges are stars: each node's neighbours are attached to its
    smallest one.  Only edges are moved, nothing is gathered per node, and each round is written before the next.
    """
    edges = cut_lineage(_distinct(edges))
    now = _state(edges)
    while now[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _distinct(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select("u", "v", "m")
        small = _distinct(small.select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
            .alias("e")).select("e.u", "e.v"))
        edges = cut_lineage(small)
        before, now = now, _state(edges)
        if now == before:
            break
    return edges
