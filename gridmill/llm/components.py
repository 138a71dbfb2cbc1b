"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmill.llm.common import stage


def _pairs(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger node ``u`` to the smaller ``v``, without loops."""
    return edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).distinct()


def _to_smallest(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Link neighbours to the smallest of a node's neighbourhood.

    Both ways: larger neighbours of every node, over all its edges. Otherwise: the node and its
    smaller neighbours.
    """
    if both_ways:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges
    least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = around.join(least, "u")
    if both_ways:
        return _pairs(joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
    return _pairs(
        joined.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    )


def _mark(edges: DataFrame) -> tuple:
    """What tells two sets of edges apart."""
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 2**40)).first()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the edges ``u, v``: the smallest node it reaches.

    Rounds of linking to the smallest neighbour, first among the larger and then among the smaller
    neighbours, until the edges form stars; each round at least brings nodes closer to their smallest,
    so it ends. Every round is written to the shared folder.
    """
    held = stage(_pairs(edges), "components")
    before = _mark(held)
    while True:
        held = stage(_to_smallest(_to_smallest(held, True), False), "components")
        after = _mark(held)
        if after == before:
            break
        before = after
    roots = held.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return held.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
