"""Connected components of a link table, by alternating large and small stars.

Every round is a minimum per node (partly aggregated before its shuffle) and
an equi-join that adaptive execution can split, so a hub that holds a third of
all links is no single task. Rounds grow with the logarithm of the longest
path. Each round is cut from its lineage in the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltlake.session import checkpoint_dir


def _smallest(arcs: DataFrame) -> DataFrame:
    """``(u, v)`` with the smallest of u and all its v beside each."""
    least = arcs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return arcs.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from the larger to the smaller end."""
    stars = _smallest(edges)
    rest = stars.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = stars.groupBy("u").agg(F.first("m").alias("v"))
    return rest.union(own).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)``: the smallest
    node that its links reach. Links to itself and nulls are left out."""
    checkpoint_dir(edges.sparkSession)
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()

    def state(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    before = state(edges)
    while before[0]:
        edges = _small_star(_large_star(edges).distinct()).checkpoint()
        now = state(edges)
        if now == before:
            break
        before = now
    # at the end each node points to its component's smallest, which has no arc of its own
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
