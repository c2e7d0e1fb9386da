"""The driver's order tables as a statistical cube.

Every measure is summed first at its finest grain (customer or nation, month, classification), then
spread to its ancestors, periods and TOTAL members and summed again, so the spreading sees aggregated
rows only. All of it is lazy: a query over one matrix reads that matrix's source tables alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cubelattice.functions.expr import natural_key
from cubelattice.functions.labels import period_label_en, period_label_ro
from cubelattice.sources.catalog_rows import CLASS_VALUES, STATIC
from cubelattice.sources.derived import DERIVED
from cubelattice.sources.warehouse import Warehouse

MONEY = "decimal(18,2)"


def cube(spark: SparkSession, sf_dir: str) -> Warehouse:
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")

    def catalog(name: str) -> DataFrame:
        fixed = inline(spark, *STATIC[name])
        return fixed.union(DERIVED[name](read).select(*fixed.columns)) if name in DERIVED else fixed

    tables = {name: lambda name=name: catalog(name) for name in STATIC}
    return Warehouse(spark, tables | {"territories": lambda: territories(read), "time_periods": lambda: time_periods(read), "statistics": lambda: statistics(read)})


def inline(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few literal rows as an inline table, which needs no Python worker."""

    def literal(x) -> str:
        if isinstance(x, list):
            return f"array({', '.join(map(literal, x))})"
        if isinstance(x, str):
            return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return "NULL" if x is None else str(x)

    columns = [c.split(" ") for c in schema.split(", ")]
    values = ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows)
    shown = ", ".join(f"CAST({n} AS {k}) AS {n}" for n, k in columns)
    return spark.sql(f"SELECT {shown} FROM VALUES {values} AS t({', '.join(n for n, _ in columns)})")


def territories(read) -> DataFrame:
    region = read("region").select("r_regionkey", "r_name")
    nation = read("nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("r"))
    macro = F.col("r") % 2
    path = F.concat(F.lit("W.M"), macro.cast("string"), F.lit(".R"), F.col("r").cast("string"))

    def rows(df: DataFrame, ident: Column, code: Column, name: Column, level: str, parent: Column, at: Column) -> DataFrame:
        return df.select(ident.cast("int").alias("territory_id"), code.alias("code"), name.alias("name"), F.lit(level).alias("level"), parent.cast("int").alias("parent_id"), at.alias("path"), F.when(F.lit(level == "LAU"), code.substr(2, 10)).alias("siruta_code"))

    def coded(letter: str, key: Column) -> Column:
        return F.concat(F.lit(letter), key.cast("string"))

    world = rows(region.limit(1), F.lit(1), F.lit("W"), F.lit("World"), "NATIONAL", F.lit(None), F.lit("W"))
    keyed = region.withColumn("r", F.col("r_regionkey"))
    macros = keyed.select(macro.alias("m")).distinct()
    first = rows(macros, F.col("m") + 2, coded("M", F.col("m")), F.concat(F.lit("Macro "), F.col("m").cast("string")), "NUTS1", F.lit(1), coded("W.M", F.col("m")))
    second = rows(keyed, F.col("r") + 10, coded("R", F.col("r")), F.col("r_name"), "NUTS2", macro + 2, path)
    third_path = F.concat(path, coded(".N", F.col("n_nationkey")))
    third = rows(nation, F.col("n_nationkey") + 100, coded("N", F.col("n_nationkey")), F.col("n_name"), "NUTS3", F.col("r") + 10, third_path)
    people = read("customer").select("c_custkey", "c_name", F.col("c_nationkey").alias("n_nationkey")).join(nation, "n_nationkey")
    local = rows(people, F.col("c_custkey") + 100_000, coded("C", F.col("c_custkey")), F.col("c_name"), "LAU", F.col("n_nationkey") + 100, F.concat(third_path, coded(".C", F.col("c_custkey"))))
    return reduce(DataFrame.unionByName, [world, first, second, third, local])


def year_id(y: Column) -> Column:
    return (y * 10_000).cast("int")


def quarter_id(y: Column, m: Column) -> Column:
    return (y * 10_000 + F.ceil(m / 3) * 100).cast("int")


def month_id(y: Column, m: Column) -> Column:
    return (y * 10_000 + 1_000 + m).cast("int")


def time_periods(read) -> DataFrame:
    dates = [read("orders").select(F.col("o_orderdate").alias("d")), read("lineitem").select(F.col("l_shipdate").alias("d")), read("events").select(F.col("ts").alias("d"))]
    months = reduce(DataFrame.union, [d.select(F.year("d").alias("y"), F.month("d").alias("m")).distinct() for d in dates]).distinct()
    none = F.lit(None).cast("int")
    y, m = F.col("y"), F.col("m")
    quarter = F.ceil(m / 3).cast("int")
    rows = [
        months.select(year_id(y).alias("time_period_id"), y.alias("year"), none.alias("quarter"), none.alias("month"), F.lit("ANNUAL").alias("periodicity")).distinct(),
        months.select(quarter_id(y, m).alias("time_period_id"), y.alias("year"), quarter.alias("quarter"), none.alias("month"), F.lit("QUARTERLY").alias("periodicity")).distinct(),
        months.select(month_id(y, m).alias("time_period_id"), y.alias("year"), none.alias("quarter"), m.alias("month"), F.lit("MONTHLY").alias("periodicity")),
    ]
    found = reduce(DataFrame.unionByName, rows)
    start = F.make_date("year", F.coalesce("month", (F.col("quarter") - 1) * 3 + 1, F.lit(1)), F.lit(1))
    end = F.last_day(F.make_date("year", F.coalesce("month", F.col("quarter") * 3, F.lit(12)), F.lit(1)))
    return found.withColumns({"period_start": start, "period_end": end, "label_ro": period_label_ro(), "label_en": period_label_en()})


def class_id(kind: str, code: Column) -> Column:
    found = F.lit(None).cast("int")
    for value_id, type_code, value, _, _ in CLASS_VALUES:
        if type_code == kind and value != "TOTAL":
            found = F.when(code == value, value_id).otherwise(found)
    return found


def total_id(kind: str) -> Column:
    return F.lit(next(v for v, t, c, _, _ in CLASS_VALUES if t == kind and c == "TOTAL"))


def _spread(df: DataFrame, matrix: int, unit: int, amount: Column) -> DataFrame:
    """Rows (territories, periods, classes: arrays; the measure) -> facts, one per cell. Rows without territories have none:
    Spark loses the columns beside the explosion of an array that is a constant."""
    place = F.explode_outer("territories") if "territories" in df.columns else F.lit(None).cast("int")
    cells = df.select(place.alias("territory_id"), "periods", "classes", "amount")
    cells = cells.select("territory_id", F.explode("periods").alias("time_period_id"), "classes", "amount")
    cells = cells.select("territory_id", "time_period_id", F.explode("classes").alias("class_ids"), "amount")
    if matrix == 1:  # localities have totals only, and no months
        cells = cells.filter((F.col("territory_id") < 100_000) | (F.col("class_ids") == F.array(total_id("ORDER_STATUS"))) & (F.col("time_period_id") % 10_000 == 0))
    facts = cells.groupBy("territory_id", "time_period_id", "class_ids").agg(amount.cast("double").alias("value"))
    return _fact(facts, matrix, unit, F.col("value"), F.lit(None).cast("string"))


def _fact(df: DataFrame, matrix: int, unit: int, value: Column, status: Column) -> DataFrame:
    return df.select(
        F.lit(matrix).alias("matrix_id"),
        natural_key(F.lit(matrix), F.col("territory_id"), F.col("time_period_id"), F.lit(unit), F.col("class_ids")).alias("natural_key"),
        F.col("territory_id").cast("int"),
        F.col("time_period_id").cast("int"),
        F.lit(unit).alias("unit_id"),
        value.alias("value"),
        status.alias("value_status"),
        "class_ids",
    )


def statistics(read) -> DataFrame:
    nation = read("nation").select(F.col("n_nationkey"), F.col("n_regionkey").alias("r"))
    chain = [F.lit(1), F.col("r") % 2 + 2, F.col("r") + 10, F.col("n_nationkey") + 100]
    y, m = F.col("y"), F.col("m")
    orders = read("orders").select("o_custkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), "o_orderstatus", F.col("o_totalprice").cast(MONEY).alias("price"))
    fine = orders.groupBy("o_custkey", "y", "m", "o_orderstatus").agg(F.sum("price").alias("price"), F.count("*").alias("n"))
    customer = read("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment")
    placed = fine.join(customer, "o_custkey").join(nation, "n_nationkey")
    status = class_id("ORDER_STATUS", F.col("o_orderstatus"))

    value = placed.select(
        F.array(*chain, F.col("o_custkey") + 100_000).alias("territories"),
        F.array(year_id(y), month_id(y, m)).alias("periods"),
        F.array(F.array(total_id("ORDER_STATUS")), F.array(status)).alias("classes"),
        F.col("price").alias("amount"),
    )
    first = _spread(value, 1, 1, F.sum("amount"))

    segment = class_id("SEGMENT", F.col("c_mktsegment"))
    counts = placed.groupBy("n_nationkey", "r", "y", "o_orderstatus", "c_mktsegment").agg(F.sum("n").alias("amount"))
    counts = counts.select(
        F.array(*chain).alias("territories"),
        F.array(year_id(y)).alias("periods"),
        F.array(*[F.array(a, b) for a in (total_id("ORDER_STATUS"), status) for b in (total_id("SEGMENT"), segment)]).alias("classes"),
        "amount",
    )
    second = _spread(counts, 2, 2, F.sum("amount"))

    lines = read("lineitem").select("l_suppkey", F.year("l_shipdate").alias("y"), F.month("l_shipdate").alias("m"), "l_returnflag", F.col("l_quantity").cast(MONEY).alias("quantity"))
    lines = lines.groupBy("l_suppkey", "y", "m", "l_returnflag").agg(F.sum("quantity").alias("amount"))
    supplier = read("supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
    shipped = lines.join(supplier, "l_suppkey").join(nation, "n_nationkey").groupBy("n_nationkey", "r", "y", "m", "l_returnflag").agg(F.sum("amount").alias("amount"))
    shipped = shipped.select(
        F.array(*chain).alias("territories"),
        F.array(year_id(y), quarter_id(y, m)).alias("periods"),
        F.array(F.array(total_id("RETURN_FLAG")), F.array(class_id("RETURN_FLAG", F.col("l_returnflag")))).alias("classes"),
        "amount",
    )
    third = _spread(shipped, 3, 3, F.sum("amount"))

    events = read("events").select(F.year("ts").alias("y"), F.month("ts").alias("m"), "event_type", F.col("value").cast(MONEY).alias("amount"))
    events = events.groupBy("y", "m", "event_type").agg(F.sum("amount").alias("amount")).select(
        F.array(month_id(y, m)).alias("periods"),
        F.array(F.array(total_id("EVENT_TYPE")), F.array(class_id("EVENT_TYPE", F.col("event_type")))).alias("classes"),
        "amount",
    )
    fourth = _spread(events, 4, 2, F.sum("amount"))

    gaps = placed.groupBy("n_nationkey", "y").agg(F.sum("price").cast("double").alias("value"))
    gaps = gaps.select((F.col("n_nationkey") + 100).alias("territory_id"), year_id(y).alias("time_period_id"), F.array().cast("array<int>").alias("class_ids"), "value", ((F.col("n_nationkey") + 100 + y) % 7 == 0).alias("gap"))
    fifth = _fact(gaps, 5, 1, F.when(~F.col("gap"), F.col("value")), F.when(F.col("gap"), "missing"))
    return reduce(DataFrame.unionByName, [first, second, third, fourth, fifth])


def csv_lines(wh: Warehouse, code: str) -> DataFrame:
    """A matrix's facts as the lines of one CSV response of the source, header first."""
    own = wh.dimensions.join(wh.matrices.filter(F.col("matrix_code") == code).select("matrix_id"), "matrix_id").filter("dimension_type != 'UNIT_OF_MEASURE'")
    facts = wh.facts(code).join(wh.territories.select("territory_id", F.col("name").alias("territory")), "territory_id", "left").join(wh.time_periods.select("time_period_id", F.col("label_ro").alias("period")), "time_period_id")
    values = wh.class_values.select("value_id", "type_code", F.col("name_ro").alias("value_name"))
    cells = facts.join(own.select("matrix_id", "dim_index", "dimension_type", "type_code"), "matrix_id")
    named = cells.withColumn("value_id", F.explode_outer(F.when(F.col("dimension_type") == "CLASSIFICATION", F.col("class_ids")).otherwise(F.array(F.lit(None).cast("int")))))
    named = named.join(values, ["value_id", "type_code"], "left")
    cell = F.when(F.col("dimension_type") == "TERRITORIAL", F.col("territory")).when(F.col("dimension_type") == "TEMPORAL", F.col("period")).otherwise(F.col("value_name"))
    rows = named.withColumn("cell", cell).groupBy("matrix_id", "natural_key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("cell").isNotNull(), F.struct("dim_index", "cell")))), lambda c: c["cell"]), ", ").alias("cells"), F.first("value").alias("value"), F.first("value_status").alias("value_status"))
    shown = F.coalesce(F.col("value").cast("decimal(20,2)").cast("string"), F.when(F.col("value_status") == "missing", ":").otherwise(""))
    lines = rows.select("matrix_id", F.lit(1).alias("response"), (F.xxhash64("natural_key").bitwiseAND(F.lit((1 << 62) - 1)) + 1).alias("line_no"), F.concat_ws(", ", "cells", shown).alias("line"))
    head = inline(wh.spark, [(wh.matrix_id(code), 1, 0, "antet, Valoare"), (wh.matrix_id(code), 1, 7, "  ")], "matrix_id int, response int, line_no bigint, line string")
    return lines.unionByName(head)
