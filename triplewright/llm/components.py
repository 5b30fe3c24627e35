"""Connected components of an edge table by alternating star operations.

Each round rewires every edge towards the smallest neighbour seen, first among all
neighbours, then among the smaller ones, until each component is a star around its smallest
node. Minima are partial aggregates; rows of a hub meet its one minimum in a join that
adaptive execution may split. Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplewright.session import materialize


def _state(edges: DataFrame) -> tuple:
    """Number and order-free digest of all edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select("b", "a"))
    smallest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    # Repeats go with the distinct of the small star that follows.
    return both.join(smallest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    smallest = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(smallest, "a")
    across = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return across.union(smallest.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes with an edge; the component is its smallest node.

    ``edges`` has columns a and b without nulls; directions, repeats and loops don't matter.
    """
    current = materialize(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    state = _state(current)
    while state[0]:
        current = materialize(_small_star(_large_star(current)), "edges")
        before, state = state, _state(current)
        if state == before:
            break
    leaves = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaves.union(roots)
