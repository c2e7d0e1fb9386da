"""Statistics, summary and coverage queries, each with its oracle over the cube's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cubelattice.operators import filters as flt
from cubelattice.operators import statistics as st

ISO = "CASE WHEN month IS NOT NULL THEN year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') WHEN quarter IS NOT NULL THEN year || '-Q' || quarter ELSE CAST(year AS VARCHAR) END"
SHOWN = f"natural_key, t.code AS territory_code, {ISO} AS x, value AS y, value_status"
COLUMNS = ("natural_key", "territory_code", "x", "y", "value_status")


def totals(column: str = "class_ids") -> str:
    """Every linked value is a TOTAL."""
    return f"len(list_filter({column}, lambda v: v NOT IN (1, 11, 21, 31))) = 0"


def _series(where: str, join: str = "JOIN", classes: str = totals(), columns: str = SHOWN) -> str:
    return f"SELECT {columns} FROM statistics s JOIN time_periods p USING (time_period_id) {join} territories t USING (territory_id) WHERE {where} AND {classes}"


def _point_list() -> str:
    return "string_agg(x || '=' || coalesce(CAST(CAST(y AS DECIMAL(20,2)) AS VARCHAR), 'null'), ',' ORDER BY year, coalesce(quarter, 0), coalesce(month, 0), natural_key) AS points"


_INNER = f"SELECT natural_key, t.code AS territory_code, year, quarter, month, {ISO} AS x, value AS y, class_ids FROM statistics s JOIN time_periods p USING (time_period_id) LEFT JOIN territories t USING (territory_id)"

PAIRS = {
    "statistics_default_total": (lambda wh: st.series(wh, "ORD101A", level="NUTS2", periodicity="ANNUAL").select(*COLUMNS), _series("matrix_id = 1 AND t.level = 'NUTS2' AND periodicity = 'ANNUAL'")),
    "statistics_include_all": (lambda wh: st.series(wh, "ORD102A", level="NUTS1", include_all=True).select(*COLUMNS), _series("matrix_id = 2 AND t.level = 'NUTS1'", classes="true")),
    "statistics_null_territory": (lambda wh: st.series(wh, "EVT101A", include_all=True).select(*COLUMNS), _series("matrix_id = 4", "LEFT JOIN", "true")),
    "statistics_missing_values": (lambda wh: st.series(wh, "NUL101A").select(*COLUMNS), _series("matrix_id = 5", "LEFT JOIN")),
    "statistics_territory_id": (lambda wh: st.series(wh, "LIN101A", territory_id=106, year_from=1996, year_to=1998).select(*COLUMNS), _series("matrix_id = 3 AND territory_id = 106 AND year BETWEEN 1996 AND 1998")),
    "statistics_territory_code": (lambda wh: st.series(wh, "ORD101A", territory_code="W", periodicity="MONTHLY").select(*COLUMNS), _series("matrix_id = 1 AND t.code = 'W' AND periodicity = 'MONTHLY'")),
    "statistics_siruta": (lambda wh: st.series(wh, "ORD101A", siruta="7").select(*COLUMNS), _series("matrix_id = 1 AND siruta_code = '7'")),
    "statistics_path_prefix": (lambda wh: st.series(wh, "ORD101A", path_prefix="W.M1.R1.N1", year_from=1999).select(*COLUMNS), _series("matrix_id = 1 AND starts_with(t.path, 'W.M1.R1.N1') AND year >= 1999")),
    "statistics_class_filter": (
        lambda wh: st.series(wh, "ORD102A", level="NATIONAL", classes='{"ORDER_STATUS": ["F", "O"], "SEGMENT": ["TOTAL"], "NO_TYPE": ["X"]}').select(*COLUMNS),
        _series("matrix_id = 2 AND t.level = 'NATIONAL'", classes="list_has_any(class_ids, [2, 3]) AND list_has_any(class_ids, [11])"),
    ),
    "statistics_class_unknown_code": (lambda wh: st.series(wh, "ORD102A", level="NATIONAL", classes={"SEGMENT": "NONE"}).select(*COLUMNS), _series("matrix_id = 2 AND t.level = 'NATIONAL'", classes="true")),
    "statistics_class_wildcard": (lambda wh: st.series(wh, "LIN101A", level="NATIONAL", classes={"RETURN_FLAG": ["*"]}).select(*COLUMNS), _series("matrix_id = 3 AND t.level = 'NATIONAL'", classes="true")),
    "statistics_invalid_json": (lambda wh: st.series(wh, "LIN101A", level="NUTS1", classes="{oops").select(*COLUMNS), _series("matrix_id = 3 AND t.level = 'NUTS1'")),
    "statistics_by_territory": (lambda wh: st.by_territory(st.series(wh, "LIN101A", periodicity="QUARTERLY")), f"SELECT territory_code, {_point_list()} FROM ({_INNER} WHERE matrix_id = 3 AND periodicity = 'QUARTERLY' AND {totals()}) GROUP BY ALL"),
    "statistics_by_classification": (
        lambda wh: st.by_classification(wh, st.series(wh, "ORD102A", level="NUTS1", include_all=True)),
        f"""SELECT territory_code, classes, {_point_list()} FROM (
              SELECT i.*, (SELECT string_agg(type_code || '=' || code, ';' ORDER BY type_code || '=' || code) FROM class_values c WHERE list_contains(i.class_ids, c.value_id)) AS classes
              FROM ({_INNER} WHERE matrix_id = 2 AND t.level = 'NUTS1') i) GROUP BY ALL""",
    ),
    "statistics_locale_en": (
        lambda wh: st.series(wh, "ORD101A", level="NATIONAL").select("natural_key", F.col("label_en").alias("label"), "unit_code", "symbol", "y"),
        "SELECT natural_key, label_en AS label, u.code AS unit_code, symbol, value AS y FROM statistics s JOIN time_periods p USING (time_period_id) JOIN territories t USING (territory_id) JOIN units u USING (unit_id) WHERE matrix_id = 1 AND t.level = 'NATIONAL' AND " + totals(),
    ),
    "statistics_page1": (
        lambda wh: st.page(st.series(wh, "ORD101A", level="NUTS3"), 20).select(*COLUMNS),
        _series("matrix_id = 1 AND t.level = 'NUTS3'") + " ORDER BY year, quarter NULLS LAST, month NULLS LAST, natural_key LIMIT 21",
    ),
    "statistics_page_after": (
        lambda wh: st.page(st.series(wh, "ORD101A", level="NUTS3"), 20, {"year": 1996, "quarter": None, "month": 5, "natural_key": "8"}).select(*COLUMNS),
        _series("matrix_id = 1 AND t.level = 'NUTS3' AND (year, coalesce(quarter, 99), coalesce(month, 99), natural_key) > (1996, 99, 5, '8')") + " ORDER BY year, quarter NULLS LAST, month NULLS LAST, natural_key LIMIT 21",
    ),
    "filter_bridge_anti": (
        lambda wh: flt.bridge_all_classes_in(wh, wh.facts("ORD102A"), [1, 11]).select("natural_key", "value"),
        "SELECT natural_key, value FROM f2 ANTI JOIN (SELECT DISTINCT natural_key FROM (SELECT natural_key, unnest(class_ids) AS value_id FROM f2) WHERE value_id NOT IN (1, 11)) AS other USING (natural_key)",
    ),
    "filter_bridge_semi": (
        lambda wh: flt.bridge_any_class(wh, wh.facts("LIN101A"), [22, 24]).select("natural_key", "value"),
        "SELECT natural_key, value FROM f3 SEMI JOIN (SELECT DISTINCT natural_key FROM (SELECT natural_key, unnest(class_ids) AS value_id FROM f3) WHERE value_id IN (22, 24)) AS other USING (natural_key)",
    ),
    "summary": (
        lambda wh: st.summary(wh, "NUL101A"),
        """SELECT count(*) AS total_count, count(*) FILTER (value IS NULL) AS null_count, min(value) AS min_value, max(value) AS max_value,
                  round(CAST(sum(CAST(value AS DECIMAL(38,6))) AS DOUBLE) / count(value), 4) AS avg_value, CAST(sum(CAST(value AS DECIMAL(38,6))) AS DOUBLE) AS sum_value, min(year) AS min_year, max(year) AS max_year
           FROM statistics JOIN time_periods USING (time_period_id) WHERE matrix_id = 5""",
    ),
    "summary_empty": (lambda wh: st.summary(wh, "EMP101A").select("total_count", "null_count", "min_value", "sum_value", "min_year"), "SELECT CAST(0 AS BIGINT) AS total_count, CAST(0 AS BIGINT) AS null_count, CAST(NULL AS DOUBLE) AS min_value, CAST(NULL AS DOUBLE) AS sum_value, CAST(NULL AS INTEGER) AS min_year"),
    "summary_levels": (lambda wh: st.levels(wh, "ORD101A"), "SELECT level, count(*) AS fact_count, count(DISTINCT territory_id) AS territory_count FROM statistics JOIN territories USING (territory_id) WHERE matrix_id = 1 GROUP BY level"),
    "data_coverage_periods": (
        lambda wh: st.periodicities(wh, "LIN101A"),
        "SELECT periodicity, count(*) AS fact_count, count(DISTINCT time_period_id) AS period_count, min(year) AS min_year, max(year) AS max_year FROM statistics JOIN time_periods USING (time_period_id) WHERE matrix_id = 3 GROUP BY periodicity",
    ),
    "data_coverage_completeness": (lambda wh: st.completeness(wh), "SELECT matrix_id, count(*) AS total, count(value) AS with_value, floor(count(value) * 100.0::DOUBLE / count(*) * 100 + 0.5) / 100 AS completeness FROM statistics GROUP BY matrix_id"),
    "saved_execute_path": (
        lambda wh: st.saved(wh, 1),
        _series("matrix_id = 1 AND (t.path = 'W.M1' OR starts_with(t.path, 'W.M1.')) AND t.level = 'NUTS2' AND year BETWEEN 1996 AND 1999 AND periodicity = 'ANNUAL'", classes="list_contains(class_ids, 1)"),
    ),
    "saved_execute_values": (lambda wh: st.saved(wh, 2), _series("matrix_id = 3 AND t.level = 'NATIONAL' AND periodicity = 'QUARTERLY'", classes="list_has_any(class_ids, [22, 24])")),
    "saved_execute_all": (lambda wh: st.saved(wh, 3), _series("matrix_id = 5", "LEFT JOIN", "true")),
    "saved_execute_limit": (lambda wh: st.saved(wh, 2, 7), _series("matrix_id = 3 AND t.level = 'NATIONAL' AND periodicity = 'QUARTERLY'", classes="list_has_any(class_ids, [22, 24])") + " ORDER BY year, quarter, month, natural_key LIMIT 7"),
}
