"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.scratch import Scratch


def connected(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, component`` for every node of the edges ``a, b``; the component is its smallest node.

    Each half round attaches the neighbours of a node to the smallest node among them, which needs a
    number of rounds that grows with the logarithm of the largest component. The smallest neighbour
    of every node is written first: the join that follows then has a plain table on either side, so
    adaptive execution can split a node with very many neighbours. Edges never become more than the
    input has. Edges with a null end, self links and repeats are dropped; no edges give no rows.
    """
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = scratch.keep(links.where("a is not null and b is not null and a > b").distinct(), "links")
    state = _state(links)
    while state[0]:
        links = _small_star(_large_star(links, scratch), scratch)
        links = scratch.keep(links, "links")
        before, state = state, _state(links)
        if state == before:
            break
    # Without further change every edge leads to the smallest node.
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _state(links: DataFrame) -> tuple:
    """Number of edges and an order-free digest of them."""
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    return tuple(links.agg(F.count("*"), digest).first())


def _large_star(links: DataFrame, scratch: Scratch) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    least = scratch.keep(least, "least")
    moved = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return scratch.keep(moved.where("a > b").distinct(), "half")


def _small_star(links: DataFrame, scratch: Scratch) -> DataFrame:
    least = scratch.keep(links.groupBy("a").agg(F.min("b").alias("least")), "least")
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.where("a > b").unionByName(least.select("a", F.col("least").alias("b"))).distinct()
