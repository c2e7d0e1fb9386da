"""Catalog views, sync views and persisted aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cubelattice.functions.expr import iso_period, normalize_label, percent
from cubelattice.sources.warehouse import Warehouse


def v_matrices(wh: Warehouse) -> DataFrame:
    rows = wh.matrices.join(wh.contexts.select("context_id", F.col("code").alias("context_code"), F.col("path").alias("context_path")), "context_id", "left")
    return rows.select("matrix_code", "name_ro", "name_en", "context_code", "context_path", F.get("periodicity", F.lit(0)).alias("first_periodicity"), "year_from", "year_to", "has_uat", "has_county", "sync_status")


def v_territories(wh: Warehouse) -> DataFrame:
    parents = wh.territories.select(F.col("territory_id").alias("parent_id"), F.col("code").alias("parent_code"), F.col("name").alias("parent_name"))
    return wh.territories.join(parents, "parent_id", "left").select("code", "name", normalize_label(F.col("name")).alias("name_normalized"), "level", "path", "parent_code", "parent_name")


def v_contexts(wh: Warehouse) -> DataFrame:
    below = wh.contexts.filter("parent_id is not null").groupBy(F.col("parent_id").alias("context_id")).agg(F.count("*").alias("child_count"))
    own = wh.matrices.groupBy("context_id").agg(F.count("*").alias("matrix_count"))
    rows = wh.contexts.join(below, "context_id", "left").join(own, "context_id", "left")
    return rows.select("code", "name_ro", "level", F.coalesce("child_count", F.lit(0)).alias("child_count"), F.coalesce("matrix_count", F.lit(0)).alias("matrix_count"))


def v_time_periods(wh: Warehouse) -> DataFrame:
    return wh.time_periods.select("time_period_id", iso_period(F.col("year"), F.col("quarter"), F.col("month")).alias("iso_period"), "periodicity", "label_ro", "label_en")


def v_units(wh: Warehouse) -> DataFrame:
    return wh.units.select("unit_id", "code", "symbol", "name_ro", "name_en", normalize_label(F.col("name_ro")).alias("name_normalized"))


def v_unresolved_labels(wh: Warehouse) -> DataFrame:
    """Labels that nothing could be found for, the newest first."""
    return wh.label_mappings.filter("target is null").orderBy(F.desc("created_at")).select("label_original", "label_normalized", "context_type", "context_hint", "reason", "created_at")


def v_sync_checkpoints(wh: Warehouse, now: str) -> DataFrame:
    """Chunks with their matrix, and whether their retry is due."""
    rows = wh.chunks.join(wh.matrices.select("matrix_id", "matrix_code"), "matrix_id")
    waiting = F.coalesce(F.to_timestamp("next_retry_at") > F.to_timestamp(F.lit(now)), F.lit(False))
    return rows.select("chunk_id", "matrix_code", "chunk_hash", "status", "cells_returned", "error_message", "retry_count", "next_retry_at", waiting.alias("is_waiting"))


def tasks_page(wh: Warehouse, limit: int, offset: int = 0) -> DataFrame:
    """Tasks, the newest first."""
    return wh.tasks.orderBy(F.desc("created_at"), F.desc("task_id")).offset(offset).limit(limit).select("task_id", "matrix_id", "status", "created_at")


def tasks_by_status(wh: Warehouse) -> DataFrame:
    """Tasks per status with the oldest and newest: running, pending, then the others."""
    found = wh.tasks.groupBy("status").agg(F.count("*").alias("task_count"), F.min("created_at").alias("oldest"), F.max("created_at").alias("newest"))
    rank = F.when(F.col("status") == "RUNNING", 1).when(F.col("status") == "PENDING", 2).otherwise(3)
    return found.select(rank.alias("status_rank"), "status", "task_count", "oldest", "newest").orderBy("status_rank", "status")


def v_sync_tasks(wh: Warehouse, now: str) -> DataFrame:
    rows = wh.tasks.join(wh.matrices.select("matrix_id", "matrix_code"), "matrix_id")
    locked = F.coalesce(F.to_timestamp("locked_until") > F.to_timestamp(F.lit(now)), F.lit(False))
    return rows.select("task_id", "matrix_code", "status", percent(F.col("chunks_completed"), F.col("chunks_total")).alias("progress_pct"), locked.alias("is_locked"), "created_at")


def v_task_summary(wh: Warehouse) -> DataFrame:
    return wh.tasks.groupBy("status").agg(F.count("*").alias("task_count"), F.sum("chunks_total").alias("chunks_total"), F.sum("chunks_completed").alias("chunks_completed"), F.sum("rows_inserted").alias("rows_inserted"), F.sum("rows_updated").alias("rows_updated"))


def v_failed_chunks(wh: Warehouse, now: str) -> DataFrame:
    """Failed chunks by time of their next try, those without one first; whether it has come. Chunks are numbered inside
    the day of their next try (those without one inside a class of their number), and earlier days are added."""
    rows = wh.chunks.filter(F.col("status").isin("FAILED", "EXHAUSTED")).join(wh.matrices.select("matrix_id", "matrix_code"), "matrix_id")
    due = F.col("next_retry_at").isNull() | (F.to_timestamp("next_retry_at") <= F.to_timestamp(F.lit(now)))
    rows = rows.withColumns({"day": F.coalesce(F.substring("next_retry_at", 1, 10), F.lit("")), "part": F.when(F.col("next_retry_at").isNull(), F.floor(F.col("chunk_id") / 100_000)).otherwise(0)})
    sizes = rows.groupBy("day", "part").agg(F.count("*").alias("n"))  # a row per day, and per 100,000 chunks without one
    before = sizes.select("day", "part", F.coalesce(F.sum("n").over(Window.orderBy("day", "part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("day", "part").orderBy(F.asc_nulls_first("next_retry_at"), "chunk_id"))
    placed = rows.withColumn("inside", inside).join(before, ["day", "part"])
    return placed.select("chunk_id", "matrix_code", "chunk_hash", "retry_count", "error_message", (due & (F.col("status") == "FAILED")).alias("ready_to_retry"), (F.col("inside") + F.col("before")).cast("int").alias("place"))


def v_matrix_sync_status(wh: Warehouse) -> DataFrame:
    """Per matrix: its latest task, its facts, its history, and one status out of them."""
    latest = wh.tasks.withColumn("n", F.row_number().over(Window.partitionBy("matrix_id").orderBy(F.desc("created_at"), F.desc("task_id")))).filter("n = 1")
    latest = latest.select("matrix_id", F.col("status").alias("task_status"), percent(F.col("chunks_completed"), F.col("chunks_total"), 1, None).alias("progress_pct"))
    years = wh.time_periods.select("time_period_id", "year")
    coverage = wh.statistics.join(years, "time_period_id").groupBy("matrix_id").agg(F.count("*").alias("fact_count"), F.countDistinct("territory_id").alias("territory_count"), F.min("year").alias("min_year"), F.max("year").alias("max_year"))
    history = wh.tasks.groupBy("matrix_id").agg(F.count("*").alias("task_count"), F.count_if(F.col("status") == "COMPLETED").alias("completed"), F.count_if(F.col("status") == "FAILED").alias("failed"))
    rows = wh.matrices.join(latest, "matrix_id", "left").join(coverage, "matrix_id", "left").join(history, "matrix_id", "left")
    has = F.coalesce("fact_count", F.lit(0)) > 0
    status = (
        F.when(F.col("task_status").isin("PENDING", "PLANNING", "RUNNING"), "SYNCING")
        .when(has & (F.col("task_status") == "COMPLETED"), "SYNCED")
        .when(has, "PARTIAL")
        .when(F.col("task_status") == "FAILED", "FAILED")
        .otherwise("NOT_SYNCED")
    )
    return rows.select("matrix_code", status.alias("status"), "task_status", "progress_pct", F.coalesce("fact_count", F.lit(0)).alias("fact_count"), "territory_count", "min_year", "max_year", F.coalesce("task_count", F.lit(0)).alias("task_count"), F.coalesce("completed", F.lit(0)).alias("completed"), F.coalesce("failed", F.lit(0)).alias("failed"))


def sync_status(wh: Warehouse, has_data: bool | None = None) -> DataFrame:
    """Matrices with their number of facts, filtered by having any."""
    counts = wh.statistics.groupBy("matrix_id").agg(F.count("*").alias("fact_count"))
    rows = wh.matrices.join(counts, "matrix_id", "left").select("matrix_code", "sync_status", F.coalesce("fact_count", F.lit(0)).alias("fact_count"))
    return rows if has_data is None else rows.filter((F.col("fact_count") > 0) == has_data)


def status_counts(wh: Warehouse) -> DataFrame:
    """One row: matrices per sync status, and those with facts."""
    kinds = ("PENDING", "SYNCING", "SYNCED", "FAILED", "STALE")
    having = wh.statistics.select("matrix_id").distinct().withColumn("has", F.lit(True))
    rows = wh.matrices.join(having, "matrix_id", "left")
    return rows.agg(F.count("*").alias("total"), F.count_if(F.coalesce("has", F.lit(False))).alias("with_data"), *[F.count_if(F.col("sync_status") == k).alias(k.lower()) for k in kinds])


def next_task(wh: Warehouse, now: str) -> DataFrame:
    """The task that a worker would claim: highest priority, then oldest, among pending and expired ones."""
    open_ = (F.col("status") == "PENDING") | (F.col("status").isin("PLANNING", "RUNNING") & (F.to_timestamp("locked_until") < F.to_timestamp(F.lit(now))))
    return wh.tasks.filter(open_).orderBy(F.desc("priority"), "created_at", "task_id").limit(1).select("task_id", "matrix_id", "status", "priority")


def mv_national(wh: Warehouse) -> DataFrame:
    """Per matrix, year and periodicity, over facts of the nation or of no territory."""
    rows = wh.statistics.join(wh.time_periods.select("time_period_id", "year", "periodicity"), "time_period_id").join(wh.territories.select("territory_id", "level"), "territory_id", "left")
    exact = F.sum(F.col("value").cast("decimal(38,6)")).cast("double")
    return rows.filter("level = 'NATIONAL' or territory_id is null").groupBy("matrix_id", "year", "periodicity").agg(
        F.count("*").alias("fact_count"), exact.alias("sum_value"), F.round(exact / F.count("value"), 4).alias("avg_value"), F.min("value").alias("min_value"), F.max("value").alias("max_value"), F.count_if(F.col("value").isNull()).alias("null_count")
    )


def mv_nuts2(wh: Warehouse) -> DataFrame:
    rows = wh.statistics.join(wh.time_periods.filter("periodicity = 'ANNUAL'").select("time_period_id", "year"), "time_period_id").join(wh.territories.filter("level = 'NUTS2'").select("territory_id", F.col("code").alias("territory_code")), "territory_id")
    return rows.groupBy("matrix_id", "territory_code", "year").agg(F.count("*").alias("fact_count"), F.sum(F.col("value").cast("decimal(38,6)")).cast("double").alias("sum_value"))


def mv_matrix_stats(wh: Warehouse) -> DataFrame:
    """Distinct members per matrix; a matrix without facts has one null row, so its null count is 1. Facts are aggregated by
    period and by territory in one pass before anything is joined, so no task gets a matrix's facts."""
    sets = wh.statistics.groupingSets([["matrix_id", "time_period_id"], ["matrix_id", "territory_id"]], "matrix_id", "time_period_id", "territory_id")
    by_period = F.grouping("territory_id") == 1
    cells = sets.agg(F.count("natural_key").alias("n"), F.count_if(F.col("value").isNull()).alias("nulls"), by_period.alias("by_period"))
    of = lambda c: F.sum(F.when(F.col("by_period"), F.col(c))).alias(c)
    periods = cells.groupBy("matrix_id", "time_period_id").agg(of("n"), of("nulls"), F.count("territory_id").alias("places"))
    found = periods.join(wh.time_periods.select("time_period_id", "year"), "time_period_id", "left").groupBy("matrix_id").agg(
        F.sum("n").alias("fact_count"), F.sum("places").alias("territory_count"), F.count("time_period_id").alias("period_count"), F.min("year").alias("min_year"), F.max("year").alias("max_year"), F.sum("nulls").alias("nulls")
    )
    whole = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    rows = wh.matrices.select("matrix_id", "matrix_code").join(found, "matrix_id", "left")
    return rows.select("matrix_code", whole("fact_count"), whole("territory_count"), whole("period_count"), "min_year", "max_year", F.coalesce("nulls", F.lit(1)).alias("null_count"))


def stored_views(wh: Warehouse) -> dict[str, DataFrame]:
    """The aggregates that ``sinks.refresh`` stores, by name."""
    return {"mv_national_timeseries": mv_national(wh), "mv_annual_nuts2": mv_nuts2(wh), "mv_matrix_stats": mv_matrix_stats(wh)}
