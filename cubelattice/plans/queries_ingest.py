"""Ingest queries, each with its oracle over the cube's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cubelattice.functions import expr, labels
from cubelattice.operators import ingest as ing
from cubelattice.operators import resolve as res
from cubelattice.sources.overlay import csv_lines
from cubelattice.sources.scratch import stored


def _sql(x) -> str:
    return "NULL" if x is None else str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"


def _values(rows: list[tuple], columns: str, kinds: list[str]) -> str:
    body = ", ".join("(" + ", ".join(f"CAST({_sql(x)} AS {k})" for x, k in zip(r, kinds, strict=True)) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({columns})"


def _labels(wh, rows: list[tuple], schema: str):
    return wh.spark.createDataFrame(rows, schema)


def _round_trip(wh, code: str = "LIN101A", unit: int = 3):
    own = wh.only(code)
    parsed = stored(ing.parse_lines(csv_lines(own, code)))
    return ing.resolve(parsed, ing.options(own, code), unit)


def _dedupe(wh):
    staged = stored(_round_trip(wh))
    later = staged.filter("territory_id % 2 = 1").withColumns({"response": F.lit(2), "value": F.col("value") + 1})
    return ing.last_wins(staged.unionByName(later)).select("natural_key", "value")


def _upsert_stage(wh):
    own = wh.facts("NUL101A")
    changed = own.filter("territory_id < 120").withColumn("value", F.when(F.col("territory_id") % 2 == 0, F.col("value") + 1).otherwise(F.col("value")))
    fresh = own.filter("territory_id = 110").withColumn("natural_key", F.concat(F.lit("new-"), "natural_key"))
    return changed.unionByName(fresh)


def _loose(wh):
    """Options of a matrix in other words: longer, shorter, in lower case, and labels of none."""
    opts = stored(ing.options(wh.only("LIN101A"), "LIN101A"))
    label = F.col("label")
    cells = opts.select("dim_index", F.explode(F.array(F.concat(label, F.lit(" (provizoriu)")), F.concat(F.lit("~ "), F.lower(label)), F.substring(label, -4, 4), F.concat(F.lit("?"), F.col("member_id").cast("string")))).alias("cell"))
    return ing.match_labels(cells, opts).select("dim_index", "cell", "kind", "member_id", "ambiguous")


_OPTIONS = """own AS (
    SELECT dim_index, 'TERRITORIAL' AS kind, name AS label, territory_id AS member_id FROM (SELECT DISTINCT territory_id FROM f3) JOIN territories USING (territory_id) JOIN dimensions ON matrix_id = 3 AND dimension_type = 'TERRITORIAL'
    UNION ALL SELECT dim_index, 'TEMPORAL', time_periods.label_ro, time_period_id FROM (SELECT DISTINCT time_period_id FROM f3) JOIN time_periods USING (time_period_id) JOIN dimensions ON matrix_id = 3 AND dimension_type = 'TEMPORAL'
    UNION ALL SELECT dim_index, 'CLASSIFICATION', v.name_ro, value_id FROM class_values v JOIN dimensions d ON d.matrix_id = 3 AND d.dimension_type = 'CLASSIFICATION' AND d.type_code = v.type_code),
  plain AS (SELECT *, trim(upper(strip_accents(label))) AS o FROM own)"""
_LOOSE = f""", {_OPTIONS}, cells AS (
    SELECT DISTINCT dim_index, unnest([label || ' (provizoriu)', '~ ' || lower(label), right(label, 4), '?' || member_id]) AS cell FROM own),
  normal AS (SELECT *, trim(upper(strip_accents(cell))) AS n FROM cells WHERE trim(cell) <> ''),
  met AS (SELECT c.dim_index, c.cell, p.kind, p.member_id, c.n = p.o AS same, bool_or(c.n = p.o) OVER (PARTITION BY c.dim_index, c.cell) AS any_same FROM normal c JOIN plain p ON p.dim_index = c.dim_index AND (contains(c.n, p.o) OR contains(p.o, c.n)))
  SELECT dim_index, cell, arg_min(kind, member_id) AS kind, min(member_id) AS member_id, count(*) AS ambiguous FROM met WHERE same OR NOT any_same GROUP BY 1, 2"""


def _found_periods(wh):
    """Two new periods in several spellings, known ones, and labels of none."""
    return res.periods(wh.time_periods, _labels(wh, [(x,) for x in ("Anul 1998", "1998", "Anul 2050", "2050-2055", "Luna Mai 2050", "Mai 2050", "Total", "Trimestrul II 1996")], "label string"))


_NEW = "(SELECT max(time_period_id) FROM time_periods)"
_PERIODS = f"""SELECT label, year, CAST(quarter AS INTEGER) AS quarter, CAST(month AS INTEGER) AS month, periodicity, CAST(id AS INTEGER) AS time_period_id FROM (VALUES
  ('Anul 1998', 1998, NULL, NULL, 'ANNUAL', 19980000), ('1998', 1998, NULL, NULL, 'ANNUAL', 19980000), ('Anul 2050', 2050, NULL, NULL, 'ANNUAL', {_NEW} + 1), ('2050-2055', 2050, NULL, NULL, 'ANNUAL', {_NEW} + 1),
  ('Luna Mai 2050', 2050, NULL, 5, 'MONTHLY', {_NEW} + 2), ('Mai 2050', 2050, NULL, 5, 'MONTHLY', {_NEW} + 2), ('Total', NULL, NULL, NULL, NULL, NULL), ('Trimestrul II 1996', 1996, 2, NULL, 'QUARTERLY', 19960200)) AS v(label, year, quarter, month, periodicity, id)"""

def _counties(wh):
    side = lambda level: wh.territories.filter(F.col("level").isin(*level)).select(F.col("code").alias("id"), "path")
    return res.counties_of(side(["LAU"]), side(["NUTS3", "NUTS2"]))


PAIRS = {
    "find_or_create_periods": (_found_periods, _PERIODS),
    "new_period_rows": (
        lambda wh: res.period_rows(_found_periods(wh)).filter("year = 2050").select(F.col("period_start").cast("string"), F.col("period_end").cast("string"), "label_ro", "label_en"),
        _values([("2050-01-01", "2050-12-31", "Anul 2050", "Year 2050"), ("2050-05-01", "2050-05-31", "Luna Mai 2050", "Month May 2050")], "period_start, period_end, label_ro, label_en", ["VARCHAR"] * 4),
    ),
    "counties_of_localities": (_counties, "SELECT l.code AS locality, p.code AS county FROM territories l JOIN territories p ON p.territory_id = l.parent_id WHERE l.level = 'LAU'"),
    "class_type_fallback": (
        lambda wh: wh.dimensions.filter("dimension_type = 'CLASSIFICATION'").join(wh.matrices.select("matrix_id", "matrix_code"), "matrix_id").select("matrix_code", "dim_index", labels.infer_class_type(F.col("label_ro"), F.concat("matrix_code", F.lit("_DIM"), "dim_index")).alias("type_code")),
        "SELECT matrix_code, dim_index, matrix_code || '_DIM' || dim_index AS type_code FROM dimensions JOIN matrices USING (matrix_id) WHERE dimension_type = 'CLASSIFICATION'",
    ),
    "parse_time_labels_round_trip": (
        lambda wh: wh.time_periods.select("time_period_id", labels.parse_time_label(F.col("label_ro")).alias("p")).select("time_period_id", "p.year", "p.quarter", "p.month", "p.periodicity"),
        "SELECT time_period_id, year, quarter, month, periodicity FROM time_periods",
    ),
    "content_hashes": (lambda wh: wh.territories.select("code", expr.content_hash(F.col("name")).alias("hash")), "SELECT code, sha256(upper(trim(name))) AS hash FROM territories"),
    "match_labels": (_loose, _LOOSE),
    "ingest_round_trip": (lambda wh: ing.last_wins(_round_trip(wh)).select("natural_key", "territory_id", "time_period_id", "value"), "SELECT natural_key, territory_id, time_period_id, value FROM statistics WHERE matrix_id = 3"),
    "ingest_errors": (lambda wh: _round_trip(wh).groupBy("error").agg(F.count("*").alias("n")), "SELECT CAST(NULL AS VARCHAR) AS error, count(*) AS n FROM statistics WHERE matrix_id = 3"),
    "ingest_last_wins": (_dedupe, "SELECT natural_key, CASE WHEN territory_id % 2 = 1 THEN value + 1 ELSE value END AS value FROM statistics WHERE matrix_id = 3"),
    "upsert_classify": (
        lambda wh: ing.classify(wh.facts("NUL101A"), _upsert_stage(wh)).groupBy("action").agg(F.count("*").alias("n")),
        """SELECT action, count(*) AS n FROM (
             SELECT CASE WHEN territory_id >= 120 THEN 'keep' WHEN territory_id % 2 = 0 AND value IS NOT NULL THEN 'update' ELSE 'unchanged' END AS action FROM statistics WHERE matrix_id = 5
             UNION ALL SELECT 'insert' FROM statistics WHERE matrix_id = 5 AND territory_id = 110) GROUP BY action""",
    ),
    "upsert_merged": (
        lambda wh: ing.merged(wh.facts("NUL101A"), _upsert_stage(wh)).select("natural_key", "territory_id", "value", "value_status"),
        """SELECT natural_key, territory_id, CASE WHEN territory_id < 120 AND territory_id % 2 = 0 THEN value + 1 ELSE value END AS value, value_status FROM statistics WHERE matrix_id = 5
           UNION ALL SELECT 'new-' || natural_key, territory_id, value, value_status FROM statistics WHERE matrix_id = 5 AND territory_id = 110""",
    ),
}
