"""Analytics queries, each with its oracle over the cube's tables."""

from __future__ import annotations

from cubelattice.operators import analytics as an
from cubelattice.plans.queries_statistics import totals

ANNUAL = "annual_facts AS (SELECT s.*, year, t.code AS territory_code, t.name AS territory_name, level, path, parent_id FROM statistics s JOIN time_periods USING (time_period_id) JOIN territories t USING (territory_id) WHERE periodicity = 'ANNUAL')"


def js(x: str, digits: int = 2) -> str:
    k = 10**digits
    return f"floor(({x}) * {k}.0::DOUBLE + 0.5) / {k}"


def _with(query: str) -> str:
    return f", {ANNUAL} {query}"


def _exact_mean(x: str, over: str = "") -> str:
    return f"round(CAST(sum(CAST({x} AS DECIMAL(38,6))){over} AS DOUBLE) / count({x}){over}, 4)"


def _compare(where: str) -> str:
    return _with(f"""SELECT natural_key, territory_code, year, value, row_number() OVER (ORDER BY value DESC NULLS LAST, natural_key) AS rank, min(value) OVER () AS min_value, max(value) OVER () AS max_value,
      {_exact_mean("value", " OVER ()")} AS avg_value, max(value) OVER () - min(value) OVER () AS range_value FROM (SELECT * FROM annual_facts WHERE {where})""")


def _trends(where: str) -> str:
    return _with(f"""SELECT natural_key, territory_code, year, value, prev_value, {js("value - prev_value")} AS yoy_change, {js("(value - prev_value) / nullif(abs(prev_value), 0) * 100")} AS yoy_percent
      FROM (SELECT *, lag(value) OVER (PARTITION BY territory_id, unit_id, class_ids ORDER BY year) AS prev_value FROM annual_facts WHERE {where})""")


def _rankings(where: str, order: str, page: str = "") -> str:
    return _with(f"""SELECT * FROM (SELECT natural_key, territory_code, value, row_number() OVER (ORDER BY value {order} NULLS LAST, natural_key) AS rank,
      {js(f"percent_rank() OVER (ORDER BY value {order} NULLS LAST) * 100")} AS percentile, ntile(4) OVER (ORDER BY value {order} NULLS LAST, natural_key) AS quartile FROM annual_facts WHERE {where}) {page}""")


def cents(x: str) -> str:
    return js(js(x, 6))


def _distribution(where: str, keys: str = "") -> str:
    p = lambda q: f"quantile_cont(value, {q})"
    return _with(f"""SELECT {keys} count(*) AS total, count(value) AS n, count(*) - count(value) AS null_count, {cents("avg(value)")} AS mean, {cents("stddev_samp(value)")} AS deviation, {cents("min(value)")} AS min_value, {cents("max(value)")} AS max_value,
      {cents("max(value) - min(value)")} AS range_value, {cents(p(0.1))} AS p10, {cents(p(0.25))} AS p25, {cents(p(0.5))} AS median, {cents(p(0.75))} AS p75, {cents(p(0.9))} AS p90, {cents(f"{p(0.75)} - {p(0.25)}")} AS iqr FROM annual_facts WHERE {where} {"GROUP BY " + keys.rstrip(", ") if keys else ""}""")


def _aggregate(function: str, where: str = "list_contains(class_ids, 1)") -> str:
    return _with(f"SELECT level, {function} AS value, count(DISTINCT territory_id) AS child_count FROM annual_facts WHERE matrix_id = 1 AND year = 1998 AND starts_with(path, 'W.M1.') AND {where} GROUP BY level")


def _correlate(x: int, y: int, classes: str, level: str = "NUTS3") -> str:
    side = lambda m, n: f"SELECT territory_id, value AS {n} FROM annual_facts WHERE matrix_id = {m} AND year = 1998 AND level = '{level}' AND {classes}"
    return _with(f""", moments AS (SELECT covar_pop(x, y) AS xy, var_pop(x) AS xx, var_pop(y) AS yy, avg(x) AS mx, avg(y) AS my, count(*) AS n FROM ({side(x, "x")}) JOIN ({side(y, "y")}) USING (territory_id) WHERE x IS NOT NULL AND y IS NOT NULL),
      fitted AS (SELECT *, xy / nullif(xx, 0) AS b, xy / nullif(sqrt(xx) * sqrt(yy), 0) AS r FROM moments)
      SELECT {js("r", 4)} AS pearson_r, {js("r * r", 4)} AS r_squared, {js("b", 4)} AS slope, {js("my - b * mx")} AS intercept, n,
             CASE WHEN abs(r) >= 0.7 THEN 'strong' WHEN abs(r) >= 0.4 THEN 'moderate' WHEN abs(r) >= 0.2 THEN 'weak' WHEN r IS NOT NULL THEN 'negligible' END AS interpretation FROM fitted""")


def _pivot(row: str, column: str, headers: list[str], where: str) -> str:
    cells = ", ".join(f"max_by(value, natural_key) FILTER (column_key = '{h}' AND value IS NOT NULL) AS \"c_{h}\"" for h in headers)
    return _with(f"SELECT row_key, {cells} FROM (SELECT {row} AS row_key, {column} AS column_key, value, natural_key FROM annual_facts WHERE {where}) GROUP BY row_key")


_YEARS = [str(y) for y in range(1995, 2002)]
_ONE = f"matrix_id = 1 AND {totals()}"

_PARTS = """parts AS (SELECT indicator_code, role, m.matrix_id, p.type_code, value_id FROM indicator_parts p JOIN matrices m USING (matrix_code) LEFT JOIN class_values c ON c.type_code = p.type_code AND c.code = p.value_code)"""


def _indicator(where: str) -> str:
    return _with(f""", {_PARTS}, sums AS (
      SELECT indicator_code, CAST(sum(CAST(value AS DECIMAL(38,6))) FILTER (role = 'numerator') AS DOUBLE) AS numerator, CAST(sum(CAST(value AS DECIMAL(38,6))) FILTER (role = 'denominator') AS DOUBLE) AS denominator
      FROM statistics JOIN time_periods USING (time_period_id) JOIN parts USING (matrix_id) WHERE periodicity = 'ANNUAL' AND year = 1998 AND {where} AND (type_code IS NULL OR list_contains(class_ids, value_id)) GROUP BY 1)
      SELECT indicator_code, numerator, denominator, {js("numerator / nullif(denominator, 0) * multiplier")} AS value FROM indicators LEFT JOIN sums USING (indicator_code)""")


PAIRS = {
    "compare": (lambda wh: an.compare(wh, "ORD101A", [10, 11, 12, 13], 1998, 1), _compare("matrix_id = 1 AND territory_id IN (10, 11, 12, 13) AND year = 1998 AND list_contains(class_ids, 1)")),
    "compare_latest_year": (lambda wh: an.compare(wh, "LIN101A", [2, 3]), _compare("matrix_id = 3 AND territory_id IN (2, 3) AND year = (SELECT max(year) FROM annual_facts WHERE matrix_id = 3 AND territory_id IN (2, 3))")),
    "trends_national": (lambda wh: an.trends(wh, "ORD101A", level="NATIONAL"), _trends("matrix_id = 1 AND level = 'NATIONAL'")),
    "trends_territory": (lambda wh: an.trends(wh, "ORD101A", territory_id=104, year_from=1996, value_id=1), _trends("matrix_id = 1 AND territory_id = 104 AND year >= 1996 AND list_contains(class_ids, 1)")),
    "trends_all_series": (lambda wh: an.trends(wh, "NUL101A"), _trends("matrix_id = 5")),
    "trends_overall": (
        lambda wh: an.overall_trend(wh, "LIN101A"),
        _with(f"""SELECT territory_code, array_to_string(class_ids, ',') AS classes, first_year, last_year, first_value, last_value, {js("last_value - first_value")} AS change, {js("(last_value - first_value) / nullif(abs(first_value), 0) * 100")} AS change_percent,
          CASE WHEN last_value > first_value THEN 'up' WHEN last_value < first_value THEN 'down' ELSE 'stable' END AS direction
          FROM (SELECT territory_code, unit_id, class_ids, min(year) AS first_year, max(year) AS last_year, arg_min(value, year) AS first_value, arg_max(value, year) AS last_value FROM annual_facts WHERE matrix_id = 3 AND value IS NOT NULL GROUP BY ALL)"""),
    ),
    "rankings_desc": (lambda wh: an.rankings(wh, "ORD101A", 1998, "NUTS3", 1), _rankings("matrix_id = 1 AND year = 1998 AND level = 'NUTS3' AND list_contains(class_ids, 1)", "DESC")),
    "rankings_asc": (lambda wh: an.rankings(wh, "LIN101A", 1997, descending=False), _rankings("matrix_id = 3 AND year = 1997", "ASC")),
    "rankings_nulls": (lambda wh: an.rankings(wh, "NUL101A", 1999), _rankings("matrix_id = 5 AND year = 1999", "DESC")),
    "rankings_lau": (lambda wh: an.rankings(wh, "ORD101A", 2000, "LAU"), _rankings("matrix_id = 1 AND year = 2000 AND level = 'LAU'", "DESC")),
    "rankings_page": (lambda wh: an.rankings(wh, "ORD101A", 1998, "NUTS3", 1, after_rank=10, limit=5), _rankings("matrix_id = 1 AND year = 1998 AND level = 'NUTS3' AND list_contains(class_ids, 1)", "DESC", "WHERE rank > 10 ORDER BY rank LIMIT 5")),
    "distribution": (lambda wh: an.distribution(wh, "ORD101A", 1998, "LAU"), _distribution("matrix_id = 1 AND year = 1998 AND level = 'LAU'")),
    "distribution_every": (lambda wh: an.distributions(wh), _distribution("true", "matrix_id, year, level, ")),
    "distribution_none": (lambda wh: an.distribution(wh, "ORD101A", 1900), _distribution("matrix_id = 1 AND year = 1900")),
    "distribution_nulls": (lambda wh: an.distribution(wh, "NUL101A", 1999), _distribution("matrix_id = 5 AND year = 1999")),
    "distribution_single": (lambda wh: an.distribution(wh, "ORD101A", 1998, "NATIONAL", 1), _distribution("matrix_id = 1 AND year = 1998 AND level = 'NATIONAL' AND list_contains(class_ids, 1)")),
    "aggregate_sum": (lambda wh: an.aggregate(wh, "ORD101A", 1998, 3, "sum", 1), _aggregate("CAST(sum(CAST(value AS DECIMAL(38,6))) AS DOUBLE)")),
    "aggregate_avg": (lambda wh: an.aggregate(wh, "ORD101A", 1998, 3, "avg", 1), _aggregate(_exact_mean("value"))),
    "aggregate_min": (lambda wh: an.aggregate(wh, "ORD101A", 1998, 3, "min", 1), _aggregate("min(value)")),
    "aggregate_max": (lambda wh: an.aggregate(wh, "ORD101A", 1998, 3, "max"), _aggregate("max(value)", "true")),
    "aggregate_count": (lambda wh: an.aggregate(wh, "ORD101A", 1998, 3, "count"), _aggregate("CAST(count(*) AS DOUBLE)", "true")),
    "aggregate_children": (lambda wh: an.direct_children(wh, "ORD101A", 1998, 11, 1), _with("SELECT natural_key, territory_code, territory_name, value FROM annual_facts WHERE matrix_id = 1 AND year = 1998 AND parent_id = 11 AND list_contains(class_ids, 1)")),
    "correlate": (lambda wh: an.correlate(wh, "ORD101A", "LIN101A", 1998), _correlate(1, 3, "true")),
    "correlate_totals": (lambda wh: an.correlate(wh, "ORD101A", "ORD102A", 1998, totals_only=True), _correlate(1, 2, totals())),
    "correlate_nulls": (lambda wh: an.correlate(wh, "NUL101A", "ORD102A", 1998, totals_only=True), _correlate(5, 2, totals())),
    "correlate_single": (lambda wh: an.correlate(wh, "ORD101A", "ORD102A", 1998, "NATIONAL", totals_only=True), _correlate(1, 2, totals(), "NATIONAL")),
    "pivot_territory_time": (lambda wh: an.pivot(wh, "ORD101A", "territory", "time", "W.M0", totals_only=True, headers=_YEARS), _pivot("territory_code", "CAST(year AS VARCHAR)", _YEARS, f"{_ONE} AND (path = 'W.M0' OR starts_with(path, 'W.M0.'))")),
    "pivot_time_territory": (lambda wh: an.pivot(wh, "LIN101A", "time", "territory", "W.M1.R1", 1996, 1999, headers=["R1", "N1"]), _pivot("CAST(year AS VARCHAR)", "territory_code", ["R1", "N1"], "matrix_id = 3 AND (path = 'W.M1.R1' OR starts_with(path, 'W.M1.R1.')) AND year BETWEEN 1996 AND 1999")),
    "pivot_class_time": (lambda wh: an.pivot(wh, "ORD102A", "classification", "time", "W.M0"), _pivot("array_to_string(class_ids, '_')", "CAST(year AS VARCHAR)", _YEARS, "matrix_id = 2 AND (path = 'W.M0' OR starts_with(path, 'W.M0.'))")),
    "indicators_list": (
        lambda wh: an.indicators(wh),
        "SELECT indicator_code, name_ro, category, (SELECT string_agg(DISTINCT matrix_code, ',' ORDER BY matrix_code) FROM indicator_parts p WHERE p.indicator_code = i.indicator_code) AS matrices FROM indicators i WHERE is_active",
    ),
    "indicator_values": (lambda wh: an.indicator_values(wh, 1998, 105), _indicator("territory_id = 105")),
    "indicator_values_all": (lambda wh: an.indicator_values(wh, 1998), _indicator("true")),
}
