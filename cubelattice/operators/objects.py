"""Nested result objects: a matrix with its context, flags and dimensions, and an option with what it refers to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubelattice.operators.catalog import last_update
from cubelattice.sources.warehouse import Warehouse


def as_json(df: DataFrame, key: str) -> DataFrame:
    """(key, body): each row as one JSON text; nulls are written."""
    return df.select(key, F.to_json(F.struct(*[c for c in df.columns if c != key]), {"ignoreNullFields": "false"}).alias("body"))


def _names(ro: str, en: str) -> Column:
    return F.struct(F.col(ro).alias("ro"), F.col(en).alias("en"))


def matrix_objects(wh: Warehouse) -> DataFrame:
    """One row per matrix: code, and nested names, context, periodicities, years, flags, dimensions in order, status."""
    above = wh.contexts.select("context_id", F.struct("code", "path", _names("name_ro", "name_en").alias("names")).alias("context"))
    shown = F.struct(F.col("dim_index").alias("index"), _names("label_ro", "label_en").alias("labels"), F.col("dimension_type").alias("type"), F.col("type_code").alias("classification"), F.col("option_count").alias("options"))
    dims = wh.dimensions.groupBy("matrix_id").agg(F.sort_array(F.collect_list(shown)).alias("dimensions"))
    rows = wh.matrices.join(above, "context_id", "left").join(dims, "matrix_id", "left")
    years = F.when(F.col("year_from").isNotNull(), F.struct(F.col("year_from").alias("from"), F.col("year_to").alias("to")))
    flags = F.struct(F.col("has_uat").alias("uat"), F.col("has_county").alias("county"))
    none = F.array().cast(dims.schema["dimensions"].dataType)
    return rows.select("matrix_code", F.col("matrix_id").alias("id"), _names("name_ro", "name_en").alias("names"), "context", F.col("periodicity").alias("periodicities"), years.alias("years"), flags.alias("flags"), F.coalesce("dimensions", none).alias("dimensions"), last_update().alias("updated"), F.col("sync_status").alias("status"))


def options_of(wh: Warehouse, code: str) -> DataFrame:
    """(dim_index, label, territory_id, time_period_id, value_id, unit_id): the options of a matrix's dimensions, each with the
    one entry that it stands for."""
    own = wh.facts(code)
    dims = wh.dimensions.join(wh.matrices.filter(F.col("matrix_code") == code).select("matrix_id"), "matrix_id").select("dim_index", "dimension_type", "type_code")
    of = lambda kind: dims.filter(F.col("dimension_type") == kind)
    none = F.lit(None).cast("int")

    def entry(rows: DataFrame, label: str, **ids: str) -> DataFrame:
        return rows.select("dim_index", F.col(label).alias("label"), *[(F.col(ids[c]) if c in ids else none).alias(c) for c in ("territory_id", "time_period_id", "value_id", "unit_id")])

    places = entry(own.select("territory_id").distinct().join(wh.territories, "territory_id").crossJoin(F.broadcast(of("TERRITORIAL"))), "name", territory_id="territory_id")  # a dimension or none
    periods = entry(own.select("time_period_id").distinct().join(wh.time_periods, "time_period_id").crossJoin(F.broadcast(of("TEMPORAL"))), "label_ro", time_period_id="time_period_id")
    values = entry(own.select(F.explode("class_ids").alias("value_id")).distinct().join(wh.class_values, "value_id").join(of("CLASSIFICATION"), "type_code"), "name_ro", value_id="value_id")
    units = entry(own.select("unit_id").distinct().join(wh.units, "unit_id").crossJoin(F.broadcast(of("UNIT_OF_MEASURE"))), "name_ro", unit_id="unit_id")
    return places.unionByName(periods).unionByName(values).unionByName(units)


def option_objects(wh: Warehouse, code: str) -> DataFrame:
    """One row per option: its dimension and label, and the reference: the first of territory, period, classification value
    and unit that the option has."""
    rows = options_of(wh, code)
    kinds = {
        "TERRITORY": (wh.territories, "territory_id", F.col("code"), F.col("name"), F.col("level")),
        "TIME_PERIOD": (wh.time_periods, "time_period_id", F.col("periodicity"), F.col("label_ro"), F.col("year").cast("string")),
        "CLASSIFICATION": (wh.class_values, "value_id", F.col("code"), F.col("name_ro"), F.col("type_code")),
        "UNIT": (wh.units, "unit_id", F.col("code"), F.col("name_ro"), F.col("symbol")),
    }
    for kind, (table, key, entry_code, entry_name, detail) in kinds.items():
        found = F.struct(F.lit(kind).alias("type"), F.col(key).alias("id"), entry_code.alias("code"), entry_name.alias("name"), detail.alias("detail"))
        rows = rows.join(table.select(key, found.alias(kind)), key, "left")
    return rows.select("dim_index", "label", F.coalesce(*kinds).alias("reference"))
