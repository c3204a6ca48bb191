"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import cut


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: the smallest node reachable, for every node with an edge (of type long, not null).

    Large-star and small-star steps in turn (Kiveris et al., 2014): every node hands its larger neighbours, then its
    smaller ones, to the smallest node it sees. The number of edges never grows, the rounds grow with the logarithm
    of the longest path, and a node with many neighbours costs one row for each, never pairs of them.
    """
    star = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct())
    state = _state(star)
    while state[0]:
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # The sums are written first: with plain shuffles on both sides, Spark can split a hub's rows in the joins.
        least = cut(both.groupBy("u").agg(F.min("v").alias("m")))
        large = cut(both.join(least, "u").where("v > u")
                    .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        least = cut(large.groupBy("u").agg(F.min("v").alias("m")))
        small = (large.join(least, "u")
                 .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u > v").distinct())
        star = cut(small)
        before, state = state, _state(star)
        if state == before:
            break
    roots = star.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return star.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def union(roots: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``roots`` (each entry's smallest known companion, its own index at first) after joining i[k] with j[k]."""
    while True:
        a, b = roots[i], roots[j]
        open_ = a != b
        if not open_.any():
            return roots
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(roots, np.maximum(a, b), np.minimum(a, b))
        while (up := roots[roots]).tobytes() != roots.tobytes():
            roots = up
