"""Connected components of a graph of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.session import stage


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (x, y); the component is its smallest node.

    Large-star hangs each node's larger neighbours on its smallest, small-star its
    smaller ones; a few rounds, logarithmic in the graph's width, leave one star per
    component. Each round is two hash aggregates and two joins over the links left,
    written to the shared folder; a hub with very many neighbours only ever enters
    partial aggregates and joins that can be split. Nulls and loops are left out.
    """
    edges = stage(_down(links.select(F.col("x").alias("u"), F.col("y").alias("v"))), "links")
    state = _state(edges)
    while True:
        both = edges.union(edges.select("v", "u"))
        lowest = both.groupBy("u").agg(F.least("u", F.min("v")).alias("low"))
        large = _down(both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("low").alias("v")))
        lowest = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        edges = stage(_down(small.union(lowest.select("u", F.col("low").alias("v")))), "links")
        before, state = state, _state(edges)
        if state == before:
            roots = edges.select(F.col("v").alias("node")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                roots.select("node", F.col("node").alias("component"))
            )


def _down(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller node."""
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _state(edges: DataFrame) -> tuple:
    mark = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.bit_xor(mark), F.sum(F.shiftright(mark, 24))).first())
