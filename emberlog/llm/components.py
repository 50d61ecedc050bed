"""Connected components of a graph given as edges, by repeated contraction in tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common


def _scramble(x: Column) -> Column:
    """A bijection of longs, so that the order by which nodes contract does not follow chains of ids."""
    x = x.bitwiseXOR(F.shiftleft(x, 21))
    x = x.bitwiseXOR(F.shiftrightunsigned(x, 35))
    return x.bitwiseXOR(F.shiftleft(x, 4))


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every node of edges(a, b): nodes have the same root just if a path joins them.

    In each round every node points to the least of itself and its neighbours; edges and earlier
    nodes move to where they point. A round leaves at most half of the nodes that still have
    neighbours, so rounds grow with the logarithm of the nodes. Tables are written between rounds.
    """
    edges = common.saved(edges.where("a <> b").distinct(), "edges")
    live = edges.select(_scramble(F.col("a")).alias("a"), _scramble(F.col("b")).alias("b"))
    live = live.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    both = live.select("a").union(live.select("b")).distinct()
    at = both.select(F.col("a").alias("node"), F.col("a").alias("root"))
    old = []
    while not live.isEmpty():
        to = live.select(F.explode(F.array(F.struct("a", F.col("a").alias("t")), F.struct(F.col("b").alias("a"), F.col("a").alias("t")))).alias("p"))
        to = common.saved(to.groupBy("p.a").agg(F.min("p.t").alias("t")), "pointers")
        at = at.join(to, at["root"] == to["a"], "left").select("node", F.coalesce("t", "root").alias("root"))
        at = common.saved(at, "roots")
        moved = live.join(to.withColumnRenamed("t", "x"), "a").select("b", "x").join(to.select(F.col("a").alias("b"), F.col("t").alias("y")), "b")
        live = moved.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        live = common.saved(live, "edges")
        common.drop(*old, to)
        old = [at, live]
    ids = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("node", _scramble(F.col("id")))
    return ids.join(at, "node").select("id", "root")
