"""Interval labels of a tree: a node's number in depth-first order, and the last number below it.

A subtree is a range of numbers, so facts that are stored in the order of their territory's number are read by a range that
Parquet's row groups skip on, and the ancestors of a node are those whose range holds its number. Numbers are made without
a sort of the whole tree: sizes of subtrees by counting ancestors, places among siblings by running sums per parent, and
numbers by adding both along a node's ancestors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cubelattice.functions.expr import ancestor_paths, path_depth
from cubelattice.operators.analytics import EXACT, annual
from cubelattice.sources.warehouse import NotFoundError, Warehouse


def intervals(territories: DataFrame) -> DataFrame:
    """(territory_id, pre, last, depth): numbers from 0 in depth-first order, siblings in order of their paths."""
    nodes = territories.select("territory_id", "parent_id", "path")
    above = nodes.select("territory_id", F.explode(ancestor_paths(F.col("path"))).alias("path"))
    sized = nodes.join(above.groupBy("path").agg(F.count("*").alias("size")), "path")
    before = F.sum("size").over(Window.partitionBy("parent_id").orderBy("path").rowsBetween(Window.unboundedPreceding, -1))  # siblings
    steps = sized.select("path", (F.coalesce(before, F.lit(0)) + F.col("parent_id").isNotNull().cast("int")).alias("step"))
    pre = above.join(steps, "path").groupBy("territory_id").agg(F.sum("step").alias("pre"))
    return sized.join(pre, "territory_id").select("territory_id", "pre", (F.col("pre") + F.col("size") - 1).alias("last"), path_depth(F.col("path")).alias("depth"))


def write_in_tree_order(wh: Warehouse, facts: DataFrame, path: str) -> None:
    """Facts with ``pre`` (null without territory), in ranges and row groups of it inside a matrix."""
    rows = facts.join(intervals(wh.territories).select("territory_id", "pre"), "territory_id", "left")
    order = ["matrix_id", "pre", "time_period_id", "natural_key"]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("matrix_id").parquet(path)


def subtree(facts: DataFrame, tree: DataFrame, territory_id: int) -> DataFrame:
    """Facts, as written, of a territory and all below it: one range of numbers."""
    row = tree.filter(F.col("territory_id") == territory_id).select("pre", "last").first()
    if row is None:
        raise NotFoundError(f"no territory {territory_id}")
    return facts.filter(F.col("pre").between(row["pre"], row["last"]))


def aggregates(wh: Warehouse, code: str, year: int, value_id: int | None = None) -> DataFrame:
    """``analytics.aggregate`` of every territory at once: per parent and level below it all five numbers. Facts are
    aggregated per territory before they go to its ancestors, of which there are as many as levels."""
    rows = annual(wh, code, value_id).filter(F.col("year") == year)
    own = rows.groupBy("territory_id", "level", "path").agg(F.sum(F.col("value").cast(EXACT)).cast(EXACT).alias("total"), F.count("value").alias("known"), F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("n"))
    spread = own.select("level", "total", "known", "low", "high", "n", F.explode(ancestor_paths(F.col("path"))).alias("parent"), "path").filter("parent != path")
    total = F.sum("total").cast("double")
    found = spread.groupBy("parent", "level").agg(
        total.alias("sum_value"), F.round(total / F.nullif(F.sum("known"), F.lit(0)), 4).alias("avg_value"), F.min("low").alias("min_value"), F.max("high").alias("max_value"), F.sum("n").alias("fact_count"), F.count("*").alias("child_count")
    )
    return found.join(wh.territories.select(F.col("path").alias("parent"), F.col("code").alias("parent_code")), "parent").drop("parent")
