"""Time series, summaries and coverage of one matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubelattice.functions.expr import is_descendant, iso_period, percent
from cubelattice.operators import filters as flt
from cubelattice.sources.warehouse import NotFoundError, Warehouse

ORDER = ("year", "quarter", "month", "natural_key")


def series(
    wh: Warehouse,
    code: str,
    *,
    territory_id: int | None = None,
    territory_code: str | None = None,
    path_prefix: str | None = None,
    siruta: str | None = None,
    level: str | None = None,
    year_from: int | None = None,
    year_to: int | None = None,
    periodicity: str | None = None,
    classes: str | dict | None = None,
    include_all: bool = False,
) -> DataFrame:
    """Facts of a matrix with their period, territory and unit; only TOTAL values unless told otherwise."""
    facts = flt.class_filter(wh, wh.facts(code), classes, include_all)
    periods = flt.years(wh.time_periods, year_from, year_to)
    if periodicity is not None:
        periods = periods.filter(F.col("periodicity") == periodicity)
    places = wh.territories.select("territory_id", F.col("code").alias("territory_code"), F.col("name").alias("territory_name"), "level", "path", "siruta_code")
    asked = [
        None if territory_id is None else F.col("territory_id") == territory_id,
        None if territory_code is None else F.col("territory_code") == territory_code,
        None if path_prefix is None else flt.text_prefix(F.col("path"), path_prefix),
        None if siruta is None else F.col("siruta_code") == siruta,
        None if level is None else F.col("level") == level,
    ]
    asked = [a for a in asked if a is not None]
    for a in asked:
        places = places.filter(a)
    units = wh.units.select("unit_id", F.col("code").alias("unit_code"), "symbol")
    joined = facts.join(periods, "time_period_id").join(places, "territory_id", "inner" if asked else "left").join(units, "unit_id", "left")
    return joined.select(
        "natural_key", "matrix_id", "territory_id", "territory_code", "territory_name", "level", "path", "year", "quarter", "month", "periodicity", "unit_code", "symbol",
        iso_period(F.col("year"), F.col("quarter"), F.col("month")).alias("x"), F.col("value").alias("y"), "value_status", "label_ro", "label_en", "class_ids",
    )


def page(rows: DataFrame, limit: int, cursor: dict | None = None) -> DataFrame:
    """The next ``limit`` + 1 rows in order of period and key; the extra row tells that more follow.

    The cursor holds all four sort values, so sub-annual pages skip nothing."""
    at = {"quarter": F.coalesce("quarter", F.lit(99)), "month": F.coalesce("month", F.lit(99)), "year": F.col("year"), "natural_key": F.col("natural_key")}
    if cursor is not None:
        rows = rows.filter(flt.after([(at[c], cursor[c] if cursor[c] is not None else 99, True) for c in ORDER]))
    return rows.orderBy(*[F.asc_nulls_last(c) for c in ORDER]).limit(limit + 1)


def by_territory(rows: DataFrame) -> DataFrame:
    """One series per territory: its points in order of period."""
    return rows.groupBy("territory_code").agg(_points())


def by_classification(wh: Warehouse, rows: DataFrame) -> DataFrame:
    """One series per combination of classification values and territory."""
    values = wh.class_values.select("value_id", F.concat_ws("=", "type_code", "code").alias("named"))
    names = rows.select("class_ids").distinct().select("class_ids", F.explode("class_ids").alias("value_id")).join(values, "value_id")
    names = names.groupBy("class_ids").agg(F.array_join(F.sort_array(F.collect_list("named")), ";").alias("classes"))
    named = rows.join(names, "class_ids", "left").withColumn("classes", F.coalesce("classes", F.lit("")))
    return named.groupBy("territory_code", "classes").agg(_points())


def _points():
    points = F.sort_array(F.collect_list(F.struct("year", F.coalesce("quarter", F.lit(0)).alias("q"), F.coalesce("month", F.lit(0)).alias("m"), "natural_key", "x", "y")))
    return F.array_join(F.transform(points, lambda p: F.concat(p["x"], F.lit("="), F.coalesce(p["y"].cast("decimal(20,2)").cast("string"), F.lit("null")))), ",").alias("points")


def summary(wh: Warehouse, code: str) -> DataFrame:
    """Counts, range, mean and sum of all values, nulls and years: one row, one pass over the facts."""
    rows = wh.facts(code).join(wh.time_periods.select("time_period_id", "year"), "time_period_id")
    exact = F.sum(F.col("value").cast("decimal(38,6)"))
    return rows.agg(
        F.count("*").alias("total_count"),
        F.count_if(F.col("value").isNull()).alias("null_count"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.round(exact.cast("double") / F.count("value"), 4).alias("avg_value"),
        exact.cast("double").alias("sum_value"),
        F.min("year").alias("min_year"),
        F.max("year").alias("max_year"),
    )


def levels(wh: Warehouse, code: str) -> DataFrame:
    """Facts and distinct territories per territory level."""
    places = wh.territories.select("territory_id", "level")
    return wh.facts(code).join(places, "territory_id").groupBy("level").agg(F.count("*").alias("fact_count"), F.countDistinct("territory_id").alias("territory_count"))


def periodicities(wh: Warehouse, code: str) -> DataFrame:
    """Facts, distinct periods and year range per periodicity."""
    rows = wh.facts(code).join(wh.time_periods, "time_period_id")
    return rows.groupBy("periodicity").agg(F.count("*").alias("fact_count"), F.countDistinct("time_period_id").alias("period_count"), F.min("year").alias("min_year"), F.max("year").alias("max_year"))


def completeness(wh: Warehouse) -> DataFrame:
    """Share of facts with a value, per matrix with facts."""
    return wh.statistics.groupBy("matrix_id").agg(F.count("*").alias("total"), F.count("value").alias("with_value"), percent(F.count("value"), F.count("*"), 2).alias("completeness"))


def saved(wh: Warehouse, query_id: int, limit: int | None = None) -> DataFrame:
    """Run a stored filter: path below, level, any of the values, years and periodicity; at most ``limit`` rows, in
    order of period and key."""
    spec = wh.saved.filter(F.col("query_id") == query_id).first()
    if spec is None:
        raise NotFoundError(f"no saved query {query_id}")
    facts = wh.facts(spec["matrix_code"])
    if spec["value_ids"]:
        facts = flt.any_class(facts, spec["value_ids"])
    periods = flt.years(wh.time_periods, spec["year_from"], spec["year_to"])
    if spec["periodicity"]:
        periods = periods.filter(F.col("periodicity") == spec["periodicity"])
    places, how = wh.territories, "left"
    if spec["territory_path"]:
        places, how = places.filter(is_descendant(F.col("path"), spec["territory_path"])), "inner"
    if spec["territory_level"]:
        places, how = places.filter(F.col("level") == spec["territory_level"]), "inner"
    rows = facts.join(periods, "time_period_id").join(places.select("territory_id", F.col("code").alias("territory_code")), "territory_id", how)
    rows = rows if limit is None else rows.orderBy(*[F.asc_nulls_last(c) for c in ORDER]).limit(limit)
    return rows.select("natural_key", "territory_code", iso_period(F.col("year"), F.col("quarter"), F.col("month")).alias("x"), F.col("value").alias("y"), "value_status")

