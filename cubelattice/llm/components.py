"""Connected components by alternating large-star and small-star steps.

Edges stay distributed: every step is an aggregation of each node's smallest neighbour, joined back on
the node. The minima are stored before they are joined, so both inputs of each join are plain
exchanges and adaptive execution may split a hub's partition. Rounds grow with the logarithm of the
longest chain; the tables of the rounds are removed at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubelattice.llm.common import intermediate, written


def _minima(edges: DataFrame) -> DataFrame:
    return written(edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    joined = both.filter("b > a").join(_minima(both), "a")
    return written(joined.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them. Edges point from large to small."""
    least = _minima(edges)
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b")
    return written(moved.union(least.select("a", F.col("m").alias("b"))).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links of whole numbers -> (node, component): the smallest node that each node reaches.

    Nodes without a link to another node do not appear. Rows with a null end are ignored; direction,
    repeats and self-links do not matter; an empty input gives an empty result."""
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), (F.isnull("a") | F.isnull("b")).alias("n"))
    with intermediate(edges.sparkSession) as keep:
        now = written(pairs.filter("not n and a > b").select("a", "b").distinct())
        before, state = None, _state(now)
        while state != before and state[0]:
            now = _small_star(_large_star(now))
            before, state = state, _state(now)
        roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
        return keep(now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots))
