"""Connected components of a graph that is given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratum.llm.common import Scratch


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def _least(links: DataFrame, scratch: Scratch) -> DataFrame:
    """u, m: the smallest neighbour of each node, as a written table.

    The join with it then has nothing but a shuffle on either side, so that Spark can deal a
    node with very many links out to several tasks.
    """
    return scratch.keep(links.groupBy("u").agg(F.min("v").alias("m")), "least")


def _large_star(both: DataFrame, least: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    least = least.select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame, least: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def _round(edges: DataFrame, scratch: Scratch) -> DataFrame:
    links = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both, scratch)
    large = scratch.keep(_large_star(both, least), "large")
    links = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
    lowest = _least(links, scratch)
    small = scratch.keep(_small_star(links, lowest), "edges")
    for done in (least, large, lowest):
        scratch.drop(done)
    return small


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """node, root: every node that has a link, but for the roots themselves; root is the smallest node it reaches.

    Alternating star contraction: the rounds grow with the logarithm of the largest
    component's size.  Minima are combined before the shuffle, written and joined back, so the
    join's tasks can share a node with very many links.  Each round is a written table in the
    shared folder.
    ``edges`` has two columns a, b; order, repeats and loops do not matter, nulls are left out.
    """
    a, b = edges.columns
    edges = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    edges = scratch.keep(edges, "edges")
    state = _state(edges)
    while state[0]:
        step = _round(edges, scratch)
        scratch.drop(edges)
        edges, before, state = step, state, _state(step)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
