"""Comparisons, trends, rankings, distributions, roll-ups, correlation, pivots and indicators.

Comparison, trends, rankings, distribution and aggregation take all classification values unless
``totals_only`` is set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cubelattice.functions.expr import is_descendant, js_round, strength
from cubelattice.operators import filters as flt
from cubelattice.operators.selection import quantiles
from cubelattice.sources.scratch import stored
from cubelattice.sources.warehouse import Warehouse

EXACT = "decimal(38,6)"


def annual(wh: Warehouse, code: str, value_id: int | None = None, totals_only: bool = False) -> DataFrame:
    """Yearly facts with territory columns."""
    facts = wh.facts(code)
    if value_id is not None:
        facts = flt.any_class(facts, [value_id])
    if totals_only:
        facts = flt.all_classes_in(wh, facts, [flt.TOTAL])
    periods = wh.time_periods.filter("periodicity = 'ANNUAL'").select("time_period_id", "year")
    places = wh.territories.select("territory_id", F.col("code").alias("territory_code"), F.col("name").alias("territory_name"), "level", "path", "parent_id")
    return facts.join(periods, "time_period_id").join(places, "territory_id")


def compare(wh: Warehouse, code: str, territory_ids: list[int], year: int | None = None, value_id: int | None = None) -> DataFrame:
    """Ranked values of 2 to 10 territories with the range over all of them; the latest year by default."""
    if not 2 <= len(territory_ids) <= 10:
        raise ValueError("2 to 10 territories are compared")
    rows = annual(wh, code, value_id).filter(F.col("territory_id").isin(territory_ids))
    if year is None:
        year = rows.agg(F.max("year")).first()[0]
    rows = rows.filter(F.col("year") == F.lit(year))
    exact = F.sum(F.col("value").cast(EXACT)).cast("double")
    over_all = rows.agg(F.min("value").alias("min_value"), F.max("value").alias("max_value"), F.round(exact / F.nullif(F.count("value"), F.lit(0)), 4).alias("avg_value"), (F.max("value") - F.min("value")).alias("range_value"))
    ranked = ranked_rows(rows.select("natural_key", "territory_code", "value")).crossJoin(F.broadcast(over_all))  # one row
    return ranked.select("natural_key", "territory_code", F.lit(year).cast("int").alias("year"), "value", F.col("rank").cast("int").alias("rank"), "min_value", "max_value", "avg_value", "range_value")


def trends(wh: Warehouse, code: str, territory_id: int | None = None, year_from: int | None = None, year_to: int | None = None, value_id: int | None = None, level: str | None = None) -> DataFrame:
    """Year-over-year change of every series (territory, unit, classification combination)."""
    rows = flt.years(annual(wh, code, value_id), year_from, year_to)
    if territory_id is not None:
        rows = rows.filter(F.col("territory_id") == territory_id)
    if level is not None:
        rows = rows.filter(F.col("level") == level)
    before = F.lag("value").over(Window.partitionBy("territory_id", "unit_id", "class_ids").orderBy("year"))
    rows = rows.withColumn("prev_value", before)
    change = F.col("value") - F.col("prev_value")
    return rows.select("natural_key", "territory_code", "year", "value", "prev_value", js_round(change, 2).alias("yoy_change"), js_round(change / F.nullif(F.abs("prev_value"), F.lit(0.0)) * 100, 2).alias("yoy_percent"))


def overall_trend(wh: Warehouse, code: str, value_id: int | None = None, level: str | None = None) -> DataFrame:
    """First and last known value of every series, their change and its direction."""
    rows = annual(wh, code, value_id).filter("value is not null")
    if level is not None:
        rows = rows.filter(F.col("level") == level)
    ends = rows.groupBy("territory_code", "unit_id", "class_ids").agg(
        F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.min_by("value", "year").alias("first_value"), F.max_by("value", "year").alias("last_value")
    )
    change = F.col("last_value") - F.col("first_value")
    return ends.select(
        "territory_code",
        F.array_join("class_ids", ",").alias("classes"),
        "first_year",
        "last_year",
        "first_value",
        "last_value",
        js_round(change, 2).alias("change"),
        js_round(change / F.nullif(F.abs("first_value"), F.lit(0.0)) * 100, 2).alias("change_percent"),
        F.when(change > 0, "up").when(change < 0, "down").otherwise("stable").alias("direction"),
    )


BOUNDS = 200


def rankings(wh: Warehouse, code: str, year: int, level: str | None = None, value_id: int | None = None, descending: bool = True, after_rank: int | None = None, limit: int | None = None) -> DataFrame:
    """Rank, percentile and quartile over the whole year; pages are cut by rank afterwards."""
    rows = annual(wh, code, value_id).filter(F.col("year") == year)
    if level is not None:
        rows = rows.filter(F.col("level") == level)
    ranked = ranked_rows(rows.select("natural_key", "territory_code", "value"), descending)
    if after_rank is not None:
        ranked = ranked.filter(F.col("rank") > after_rank)
    return ranked if limit is None else ranked.orderBy("rank").limit(limit)


def ranked_rows(rows: DataFrame, descending: bool = True) -> DataFrame:
    """natural_key, territory_code, value -> the same with rank, percentile and quartile; nulls come last.

    Approximate quantiles (at most ``BOUNDS``) cut the values into buckets: those between two bounds, and one for
    each bound itself, whose rows are equal and may be many, so these (and the nulls) are cut further by the first
    two hex digits of the key. Rows are numbered inside their bucket and the sizes of earlier buckets are added: the
    one window over all buckets sees at most some 50,000 of them."""
    share = [k / BOUNDS for k in range(BOUNDS + 1)]
    bounds = sorted(set(rows.agg(F.approx_percentile("value", share, 10_000)).first()[0] or []))
    at = F.array(*map(F.lit, bounds)) if bounds else F.array().cast("array<double>")
    below = F.size(F.filter(at, lambda b: b < F.col("value")))
    equal = F.array_contains(at, F.col("value"))
    bucket = (2 * below + equal.cast("int")) * (-1 if descending else 1)
    bucket = F.coalesce(bucket, F.lit(2 * BOUNDS + 9))
    cut = F.when(F.col("value").isNull() | equal, F.conv(F.substring("natural_key", 1, 2), 16, 10).cast("int")).otherwise(0)
    dealt = rows.withColumns({"bucket": bucket, "cut": F.coalesce(cut, F.lit(-1))})
    sizes = dealt.groupBy("bucket", "cut").agg(F.count("*").alias("size"))
    before = Window.orderBy("bucket", "cut").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("bucket", "cut", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"), F.sum("size").over(Window.partitionBy()).alias("all"))
    # rows of one value have one percentile: that of the first of them
    first = F.min("before").over(Window.partitionBy("bucket"))
    sizes = sizes.withColumn("first", first)
    value = F.desc_nulls_last("value") if descending else F.asc_nulls_last("value")
    own = Window.partitionBy("bucket", "cut")
    placed = dealt.withColumns({"nth": F.row_number().over(own.orderBy(value, "natural_key")), "tied": F.rank().over(own.orderBy(value))})
    placed = placed.join(sizes, ["bucket", "cut"])
    lone = F.col("value").isNull() | F.array_contains(at, F.col("value"))
    place, n = F.col("before") + F.col("nth"), F.col("all")
    ahead = F.when(lone, F.col("first")).otherwise(F.col("before") + F.col("tied") - 1)
    quarter, more = F.floor(n / 4), n % 4
    high = more * (quarter + 1)
    quartile = F.when(place <= high, F.ceil(place / (quarter + 1))).otherwise(more + F.ceil((place - high) / F.greatest(quarter, F.lit(1))))
    percentile = F.when(n > 1, ahead / (n - 1)).otherwise(0.0)
    return placed.select("natural_key", "territory_code", "value", place.cast("long").alias("rank"), js_round(percentile * 100, 2).alias("percentile"), quartile.cast("long").alias("quartile"))


def distribution(wh: Warehouse, code: str, year: int, level: str | None = None, value_id: int | None = None) -> DataFrame:
    """Counts, mean, sample deviation, range and exact percentiles of a year's values."""
    rows = annual(wh, code, value_id).filter(F.col("year") == year)
    if level is not None:
        rows = rows.filter(F.col("level") == level)
    one = F.lit(1).alias("one")
    found = _distributions(rows.select(one, "value"), ["one"])
    whole = {c: F.coalesce(c, F.lit(0)) for c in ("total", "n", "null_count")}  # of no rows, too
    return wh.spark.range(1).select(one).join(found, "one", "left").withColumns(whole).drop("one")


def distributions(wh: Warehouse) -> DataFrame:
    """``distribution`` of every matrix, year and level in one pass."""
    periods = wh.time_periods.filter("periodicity = 'ANNUAL'").select("time_period_id", "year")
    rows = wh.statistics.join(periods, "time_period_id").join(wh.territories.select("territory_id", "level"), "territory_id")
    return _distributions(rows.select("matrix_id", "year", "level", "value"), ["matrix_id", "year", "level"])


def _cents(x: Column) -> Column:
    """Two digits of a number that is whole in millionths but for what sums and interpolation have lost."""
    return js_round(js_round(x, 6), 2)


def _distributions(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The numbers of each group of keys (none of them null); percentiles by distributed selection."""
    rows = stored(rows)
    found = rows.groupBy(*keys).agg(
        F.count("*").alias("total"),
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("deviation"),
        F.min("value").alias("lowest"),
        F.max("value").alias("highest"),
    )
    p = [F.get("p", F.lit(k)) for k in range(5)]
    found = found.join(quantiles(rows, keys, [0.1, 0.25, 0.5, 0.75, 0.9]), keys, "left")
    return found.select(
        *keys,
        "total",
        "n",
        (F.col("total") - F.col("n")).alias("null_count"),
        _cents(F.col("mean")).alias("mean"),
        _cents(F.col("deviation")).alias("deviation"),
        _cents(F.col("lowest")).alias("min_value"),
        _cents(F.col("highest")).alias("max_value"),
        _cents(F.col("highest") - F.col("lowest")).alias("range_value"),
        *[_cents(v).alias(name) for v, name in zip(p, ("p10", "p25", "median", "p75", "p90"), strict=True)],
        _cents(p[3] - p[1]).alias("iqr"),
    )


def aggregate(wh: Warehouse, code: str, year: int, parent_id: int, function: str = "sum", value_id: int | None = None) -> DataFrame:
    """One number per level below a territory, the territory itself excluded."""
    parent = wh.territories.filter(F.col("territory_id") == parent_id).select(F.col("path").alias("root"), F.col("territory_id").alias("root_id"))
    rows = annual(wh, code, value_id).filter(F.col("year") == year).join(F.broadcast(parent), is_descendant(F.col("path"), F.col("root")) & (F.col("territory_id") != F.col("root_id")))  # one row
    exact = F.sum(F.col("value").cast(EXACT))
    found: Column = {"sum": exact.cast("double"), "avg": F.round(exact.cast("double") / F.count("value"), 4), "min": F.min("value"), "max": F.max("value"), "count": F.count("*").cast("double")}[function]
    return rows.groupBy("level").agg(found.alias("value"), F.countDistinct("territory_id").alias("child_count"))


def direct_children(wh: Warehouse, code: str, year: int, parent_id: int, value_id: int | None = None) -> DataFrame:
    """Values of the territory's children, under the same classification filter."""
    rows = annual(wh, code, value_id).filter((F.col("year") == year) & (F.col("parent_id") == parent_id))
    return rows.select("natural_key", "territory_code", "territory_name", "value")


def correlate(wh: Warehouse, x: str, y: str, year: int, level: str = "NUTS3", totals_only: bool = False) -> DataFrame:
    """Correlation and least squares over the territories' pairs of values.

    Without ``totals_only`` every breakdown row of one matrix meets every one of the other. A constant
    side has no correlation (null)."""
    side = lambda code, name: annual(wh, code, totals_only=totals_only).filter((F.col("year") == year) & (F.col("level") == level)).select("territory_id", "time_period_id", F.col("value").alias(name))
    pairs = side(x, "x").join(side(y, "y"), ["territory_id", "time_period_id"]).filter("x is not null and y is not null")
    found = pairs.agg(F.covar_pop("x", "y").alias("xy"), F.var_pop("x").alias("xx"), F.var_pop("y").alias("yy"), F.avg("x").alias("mx"), F.avg("y").alias("my"), F.count("*").alias("n"))
    slope = F.col("xy") / F.nullif(F.col("xx"), F.lit(0.0))
    r = F.col("xy") / F.nullif(F.sqrt(F.col("xx")) * F.sqrt(F.col("yy")), F.lit(0.0))
    return found.select(
        js_round(r, 4).alias("pearson_r"), js_round(r * r, 4).alias("r_squared"), js_round(slope, 4).alias("slope"), js_round(F.col("my") - slope * F.col("mx"), 2).alias("intercept"), "n", strength(r).alias("interpretation")
    )


HEADERS = 1000


def cells(wh: Warehouse, code: str, rows: str, columns: str, path: str | None = None, year_from: int | None = None, year_to: int | None = None, totals_only: bool = False) -> DataFrame:
    """The cells of a pivot table in long form: row_key, column_key, value, natural_key."""
    facts = flt.years(annual(wh, code, totals_only=totals_only), year_from, year_to)
    if path is not None:
        facts = facts.filter(is_descendant(F.col("path"), path))
    axis = {"territory": F.col("territory_code"), "time": F.col("year").cast("string"), "classification": F.array_join("class_ids", "_")}
    return facts.select(axis[rows].alias("row_key"), axis[columns].alias("column_key"), "value", "natural_key")


def pivot(wh: Warehouse, code: str, rows: str, columns: str, path: str | None = None, year_from: int | None = None, year_to: int | None = None, totals_only: bool = False, headers: list[str] | None = None) -> DataFrame:
    """A table of two axes out of territory, time and classification; of several facts in a cell, the one of
    the largest key counts. Column headers are found by one small aggregation unless given, ``HEADERS`` at most: a
    wider table is better left long (``cells``)."""
    if rows == columns:
        raise ValueError("rows and columns must be two axes")
    found = cells(wh, code, rows, columns, path, year_from, year_to, totals_only)
    if not headers:
        headers = sorted(r[0] for r in found.select("column_key").distinct().limit(HEADERS + 1).collect())
        if len(headers) > HEADERS:
            raise ValueError(f"over {HEADERS} columns; give the headers, or take the cells")
    return found.groupBy("row_key").pivot("column_key", headers).agg(F.max_by("value", "natural_key")).select("row_key", *[F.col(f"`{h}`").alias(f"c_{h}") for h in headers])


def indicators(wh: Warehouse, active_only: bool = True, category: str | None = None) -> DataFrame:
    """The catalog of indicators with the matrices that each needs."""
    needs = wh.indicator_parts.groupBy("indicator_code").agg(F.array_join(F.sort_array(F.collect_set("matrix_code")), ",").alias("matrices"))
    rows = wh.indicators.filter("is_active") if active_only else wh.indicators
    rows = rows.filter(F.col("category") == category) if category else rows
    return rows.join(needs, "indicator_code", "left").select("indicator_code", "name_ro", "category", "matrices")


def indicator_values(wh: Warehouse, year: int, territory_id: int | None = None) -> DataFrame:
    """numerator / denominator x multiplier of every indicator: known components are summed, a missing or
    zero denominator gives null. All components come from one pass over the facts."""
    parts = wh.indicator_parts.join(wh.matrices.select("matrix_code", "matrix_id"), "matrix_code")
    values = wh.class_values.select("type_code", F.col("code").alias("value_code"), "value_id")
    parts = parts.join(values, ["type_code", "value_code"], "left").select("indicator_code", "role", "matrix_id", "type_code", "value_id")
    periods = wh.time_periods.filter((F.col("periodicity") == "ANNUAL") & (F.col("year") == year)).select("time_period_id")
    facts = wh.statistics.join(periods, "time_period_id")
    if territory_id is not None:
        facts = facts.filter(F.col("territory_id") == territory_id)
    taken = facts.join(parts, "matrix_id").filter(F.col("type_code").isNull() | F.array_contains("class_ids", F.col("value_id")))
    exact = lambda role: F.sum(F.when(F.col("role") == role, F.col("value").cast(EXACT))).cast("double")
    sums = taken.groupBy("indicator_code").agg(exact("numerator").alias("numerator"), exact("denominator").alias("denominator"))
    value = F.col("numerator") / F.nullif(F.col("denominator"), F.lit(0.0)) * F.col("multiplier")
    return wh.indicators.join(sums, "indicator_code", "left").select("indicator_code", "numerator", "denominator", js_round(value, 2).alias("value"))
