"""Stored aggregates that are kept up to date by what has changed.

A state is what a group of facts adds to any of the three aggregates: counts, an exact sum, the extremes, and the set of its
territories as bitmaps. States are stored per matrix, so an upsert makes those of the matrices that it has touched anew,
from their facts alone, and the aggregates are merged from states, which are as many as periods and regions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubelattice.sources.warehouse import Warehouse

NATION, ELSEWHERE = 0, -1
EXACT = "decimal(38,6)"


def states(wh: Warehouse, facts: DataFrame) -> DataFrame:
    """(matrix_id, time_period_id, place, bucket, n, known, total, low, high, members) of facts. A place is a region
    (NUTS2) by its number, the nation (or no territory), or elsewhere; members are the bits of one bucket of territories."""
    rows = facts.join(wh.territories.select("territory_id", "level"), "territory_id", "left")
    place = F.when((F.col("level") == "NATIONAL") | F.col("territory_id").isNull(), NATION).when(F.col("level") == "NUTS2", F.col("territory_id")).otherwise(ELSEWHERE)
    keyed = rows.select("matrix_id", "time_period_id", place.alias("place"), F.bitmap_bucket_number("territory_id").alias("bucket"), F.bitmap_bit_position("territory_id").alias("bit"), "value")
    return keyed.groupBy("matrix_id", "time_period_id", "place", "bucket").agg(
        F.count("*").alias("n"), F.count("value").alias("known"), F.sum(F.col("value").cast(EXACT)).cast(EXACT).alias("total"), F.min("value").alias("low"), F.max("value").alias("high"), F.bitmap_construct_agg("bit").alias("members")
    )


def national(wh: Warehouse, held: DataFrame) -> DataFrame:
    """``views.mv_national`` from states."""
    rows = held.filter(F.col("place") == NATION).join(wh.time_periods.select("time_period_id", "year", "periodicity"), "time_period_id")
    total = F.sum("total").cast("double")
    return rows.groupBy("matrix_id", "year", "periodicity").agg(
        F.sum("n").alias("fact_count"), total.alias("sum_value"), F.round(total / F.nullif(F.sum("known"), F.lit(0)), 4).alias("avg_value"), F.min("low").alias("min_value"), F.max("high").alias("max_value"), (F.sum("n") - F.sum("known")).alias("null_count")
    )


def regional(wh: Warehouse, held: DataFrame) -> DataFrame:
    """``views.mv_nuts2`` from states."""
    rows = held.filter(F.col("place") > 0).join(wh.time_periods.filter("periodicity = 'ANNUAL'").select("time_period_id", "year"), "time_period_id")
    places = wh.territories.filter("level = 'NUTS2'").select(F.col("territory_id").alias("place"), F.col("code").alias("territory_code"))
    return rows.join(places, "place").groupBy("matrix_id", "territory_code", "year").agg(F.sum("n").alias("fact_count"), F.sum("total").cast("double").alias("sum_value"))


def matrix_stats(wh: Warehouse, held: DataFrame) -> DataFrame:
    """``views.mv_matrix_stats`` from states: territories are counted in the united bitmaps."""
    dated = held.join(wh.time_periods.select("time_period_id", "year"), "time_period_id")
    counts = dated.groupBy("matrix_id").agg(F.sum("n").alias("fact_count"), F.count_distinct("time_period_id").alias("period_count"), F.min("year").alias("min_year"), F.max("year").alias("max_year"), (F.sum("n") - F.sum("known")).alias("nulls"))
    united = held.filter("bucket is not null").groupBy("matrix_id", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("members")).alias("places"))
    places = united.groupBy("matrix_id").agg(F.sum("places").alias("territory_count"))
    rows = wh.matrices.select("matrix_id", "matrix_code").join(counts, "matrix_id", "left").join(places, "matrix_id", "left")
    whole = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return rows.select("matrix_code", whole("fact_count"), whole("territory_count"), whole("period_count"), "min_year", "max_year", F.coalesce("nulls", F.lit(1)).alias("null_count"))
