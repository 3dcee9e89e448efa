"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knockwatch.llm.store import cut


def _state(edges: DataFrame) -> tuple:
    """Row count and a digest that tells one edge set from another."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame, every_step: bool = True) -> DataFrame:
    """``a, b`` (any comparable type) → ``node, component``: the smallest node reachable.

    Links may repeat, point either way or from a node to itself; nodes without a link to
    another node, and links with a null end, give no row. Each step keeps at most as many
    edges as there were; the number of steps grows with the logarithm of the longest chain.
    The smallest neighbour of each node is a stored table of its own, so that the join with
    it has plain shuffles (or a broadcast of a known size) and a node with very many links
    can be split. Without ``every_step`` only that table of the first half of a step and the
    step's result are stored: half as many files, for callers whose links are stars already.
    """
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    valid = links["a"].isNotNull() & links["b"].isNotNull() & (links["a"] != links["b"])
    edges = cut(ordered.filter(valid).distinct())
    state = _state(edges)
    while state[0]:
        large = _large_star(edges)
        edges = cut(_small_star(cut(large), cut) if every_step else _small_star(large, lambda table: table))
        before, state = state, _state(edges)
        if state == before:
            break
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    """Point every larger neighbour of a node at the node's smallest neighbour or itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = cut(both.groupBy("a").agg(F.least("a", F.min("b")).alias("least")))
    moved = both.filter("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.distinct()


def _small_star(edges: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Point a node and its smaller neighbours at the smallest of them."""
    smallest = keep(edges.groupBy("a").agg(F.min("b").alias("least")))
    moved = edges.join(smallest, "a").filter("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(smallest.select("a", F.col("least").alias("b"))).distinct()
