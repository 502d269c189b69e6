"""Connected components of an edge list, by alternating star contractions.

Each round links every node's larger neighbours to its smallest one, and then its smaller neighbours and itself to the
smallest of those. Edges never get more than twice as many, hot nodes only take part in aggregations and joins, and the
number of rounds grows with the logarithm of the longest path. Every round's edges are stored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize

_ROUNDS = 100


def _directed(edges: DataFrame) -> DataFrame:
    """Edges with u > v, none twice, no loops."""
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``(id, component)`` of every node with an edge to another one: ``component`` is the smallest id it is connected with."""
    edges = materialize(_directed(edges.select(F.col(u).cast("long").alias("u"), F.col(v).cast("long").alias("v"))), "edges")
    state = _state(edges)
    for _ in range(_ROUNDS):
        if not state[0]:
            break
        edges = materialize(_directed(_small_star(_directed(_large_star(edges)))), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    nodes = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return nodes.union(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes over the edges ``(i, j)``."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        np.minimum.at(new, label[i], least)
        np.minimum.at(new, label[j], least)
        new = new[new]
        if (new == label).all():
            return label
        label = new
