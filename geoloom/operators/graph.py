"""Connected components of an edge table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.runtime import cut


def min_labels(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest reachable node per node: neighbours' minimum, then pointer jumping."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        if np.array_equal(new, label):
            return label
        label = new


def components(edges: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, node, root): smallest node of each node's component, for nodes with edges.

    ``edges`` has keys, ``u`` and ``v`` (bigint).
    """
    edges = cut(edges.filter("u != v").select(*keys, F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    return star_components(edges, keys)


def star_components(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Alternating large-star and small-star contraction (Kiveris et al., 2014).

    Each half round is a minimum per node (a partial aggregate) and one join back to
    the edges; edges never outgrow their first number.  ``edges`` has u > v.
    """
    mark = None
    while True:
        both = edges.unionByName(edges.select(*keys, F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(*keys, "u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, [*keys, "u"]).filter("v > u").select(*keys, F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        least = large.groupBy(*keys, "u").agg(F.min("v").alias("m"))
        small = large.join(least, [*keys, "u"]).select(
            *keys, F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select(*keys, "e.u", "e.v").filter("u != v").distinct()
        edges = cut(small)
        # A star forest maps onto itself, so an unchanged table means the end.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64(*keys, "u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    leaves = edges.select(*keys, F.col("u").alias("node"), F.col("v").alias("root"))
    roots = edges.select(*keys, F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return leaves.unionByName(roots)


