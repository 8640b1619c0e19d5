"""Connected components of links, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.session import materialised, sent

#: Bytes that a row of one node takes.
NODE_BYTES = 72


def components(links: DataFrame) -> DataFrame:
    """(node, label): each node of ``links`` (a, b) with the smallest node that it can reach."""
    pointed = smallest(links)
    return pointed.unionByName(pointed.select(F.col("label").alias("node"), "label").distinct())


def smallest(links: DataFrame) -> DataFrame:
    """(node, label): the nodes of ``links`` (a, b) that can reach a smaller one, with the smallest.

    Alternating large-star and small-star steps (Kiveris et al., 2014): every step points a
    node's larger, then its smaller neighbours at the smallest one, so stars grow until each
    node has one edge up or only edges down. Each step is an aggregation by node and a join back,
    which shuffles no edges while they are few, cut by a written table.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v")
    n = 2 * edges.count()  # steps never add to the nodes
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = _star(both, F.col("v") > F.col("u"), n)
        edges = _star(edges, F.lit(True), n)
        ends = edges.select("u", "v").unpivot([], ["u", "v"], "end", "node")
        uses = ends.groupBy("node").agg(F.count_if(F.col("end") == "u").alias("n"), F.max("end").alias("last"))
        if uses.filter("n > 1 or (n = 1 and last = 'v')").isEmpty():
            break
    # Every edge now points at its component's smallest node.
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))


def _star(edges: DataFrame, kept: Column, n: int) -> DataFrame:
    """Points the ``kept`` neighbours v of u, and u, at the smallest of u and its neighbours; there
    are at most ``n`` nodes."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    out = edges.join(sent(least, n, 2 * NODE_BYTES), "u")
    moved = F.struct(F.when(kept, F.col("v")).alias("u"), F.col("m").alias("v"))
    own = F.struct("u", F.col("m").alias("v"))
    return materialised(out.select(F.inline(F.array(moved, own))).filter("u <> v").distinct(), "star")
