"""Connected components of an edge table by alternating star operations (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Copies of each node's minimum in a join; a hub's edges are dealt over as many keys, and AQE splits further.
SALTS = 8


def _least_neighbour(pairs: DataFrame) -> DataFrame:
    """(u, v, m): each pair with m, the least of u and all its partners."""
    salted = pairs.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    least = (
        pairs.groupBy("u").agg(F.min("v").alias("m"))
        .select(F.col("u").alias("k"), F.least("u", "m").alias("m"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("t"))
    )
    return salted.join(least, (salted.u == least.k) & (salted.s == F.col("t").cast("long"))).select("u", "v", "m")


def _state(edges: DataFrame) -> tuple:
    h: Column = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(h)).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``; root is the least node of its component.

    Each round hooks larger neighbours (large star), then smaller ones (small star), to the least
    neighbour, until nothing changes. Edges and labels stay distributed; only a count and a
    checksum come to the driver. No edges give an empty table.
    """
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least_neighbour(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _least_neighbour(large)
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        now = cut(small.where("u <> v").distinct(), instead_of=now)
        if (after := _state(now)) == state:
            break
        state = after
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
