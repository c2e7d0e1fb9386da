"""Catalog and discovery queries, each with its oracle over the cube's tables."""

from __future__ import annotations

from cubelattice.operators import catalog as cat
from cubelattice.sources.catalog_rows import NOW

EN = "CASE WHEN coalesce(name_en, '') <> '' THEN name_en ELSE name_ro END AS name"
DEPTH = "len(string_split(path, '.'))"
_COUNT = "fact_count, territory_count, period_count"

_OPTIONS = """options AS (
  SELECT DISTINCT 'TERRITORIAL' AS kind, CAST(NULL AS VARCHAR) AS t, code AS option_code, name AS option_name FROM statistics JOIN territories USING (territory_id) WHERE matrix_id = 3
  UNION ALL SELECT DISTINCT 'TEMPORAL', NULL, CAST(time_period_id AS VARCHAR), label_ro FROM statistics JOIN time_periods USING (time_period_id) WHERE matrix_id = 3
  UNION ALL SELECT DISTINCT 'UNIT_OF_MEASURE', NULL, code, name_ro FROM statistics JOIN units USING (unit_id) WHERE matrix_id = 3
  UNION ALL SELECT DISTINCT 'CLASSIFICATION', type_code, code, name_ro FROM bridge JOIN class_values USING (value_id) WHERE matrix_id = 3),
taken AS (SELECT dim_index, dimension_type, option_code, option_name FROM dimensions JOIN options ON dimension_type = kind AND type_code IS NOT DISTINCT FROM t WHERE matrix_id = 3)"""

_UPDATE = "CAST(coalesce(try_strptime(last_update, '%d-%m-%Y'), try_strptime(last_update, '%Y-%m-%d')) AS DATE)"


def _matrices(where: str, name: str = "m.name_ro AS name") -> str:
    return f"SELECT matrix_code, {name}, c.name_ro AS context_name, sync_status, array_to_string(periodicity, ',') AS periodicities, year_from, year_to, CAST({_UPDATE} AS VARCHAR) AS last_update FROM matrices m LEFT JOIN contexts c USING (context_id) WHERE {where}"


def _by_territory(where: str) -> str:
    return f"SELECT matrix_code, count(*) AS fact_count, count(DISTINCT territory_id) AS territory_count, count(DISTINCT time_period_id) AS period_count FROM statistics JOIN territories USING (territory_id) JOIN matrices USING (matrix_id) WHERE {where} GROUP BY 1"


def _periods(where: str) -> str:
    return f"SELECT year, quarter, month, periodicity, CAST(period_start AS VARCHAR) AS period_start, CAST(period_end AS VARCHAR) AS period_end, label_ro, label_en FROM time_periods WHERE {where}"


_DETAIL = """SELECT m.matrix_id, matrix_code, {name} AS name, c.path AS context_path, {context} AS context_name, array_to_string(periodicity, ',') AS periodicities, has_uat, has_county,
  (SELECT CAST(count(*) AS INTEGER) FROM dimensions d WHERE d.matrix_id = m.matrix_id) AS dimension_count, year_from, year_to, CAST({update} AS VARCHAR) AS last_update, sync_status,
  (SELECT count(*) FROM statistics s WHERE s.matrix_id = m.matrix_id) AS row_count, 0 AS view_count, 0 AS download_count,
  coalesce((SELECT string_agg(dim_index || ':' || dimension_type || ':' || {label} || ':' || option_count, '; ' ORDER BY dim_index) FROM dimensions d WHERE d.matrix_id = m.matrix_id), '') AS dimensions
  FROM matrices m LEFT JOIN contexts c USING (context_id) WHERE matrix_code = '{code}'"""
_TREE = "class_values JOIN class_tree USING (value_id)"
_EITHER = "CASE WHEN coalesce({0}_en, '') <> '' THEN {0}_en ELSE {0}_ro END"
_SYNCED = "SELECT matrix_code, sync_status, last_sync_at FROM matrices LEFT JOIN (SELECT matrix_id, max(created_at) AS last_sync_at FROM tasks WHERE status = 'COMPLETED' GROUP BY 1) USING (matrix_id) WHERE matrix_id IN (SELECT matrix_id FROM statistics)"

PAIRS = {
    "contexts_page": (lambda wh: cat.contexts_page(wh, 5, ("Linii de comandă", 1020)), "SELECT context_id, code, name_ro, path FROM contexts WHERE (name_ro, context_id) > ('Linii de comandă', 1020) ORDER BY name_ro, context_id LIMIT 6"),
    "contexts_tree": (lambda wh: cat.contexts_tree(wh), "SELECT CAST(row_number() OVER (ORDER BY string_split(path, '.')) AS INTEGER) AS place, repeat('  ', level) || '[' || code || '] ' || name_ro AS line FROM contexts"),
    "matrices_context": (lambda wh: cat.matrices(wh, context_id=101), _matrices("m.context_id = 101")),
    "matrices_page_update": (
        lambda wh: cat.matrices_page(wh, 20, "lastUpdate", True, ("2024-03-15", 1)),
        f"SELECT matrix_id, matrix_code, sort_value FROM (SELECT *, CAST({_UPDATE} AS VARCHAR) AS sort_value FROM matrices) WHERE sort_value < '2024-03-15' OR (sort_value = '2024-03-15' AND matrix_id > 1) ORDER BY sort_value DESC NULLS LAST, matrix_id LIMIT 21",
    ),
    "matrices_offset": (lambda wh: cat.matrices_page(wh, 20, offset=5), "SELECT matrix_id, matrix_code, name_ro AS sort_value FROM matrices ORDER BY name_ro, matrix_id LIMIT 21 OFFSET 5"),
    "matrix_detail": (lambda wh: cat.matrix_detail(wh, "ORD101A"), _DETAIL.format(name="m.name_ro", context="c.name_ro", update=_UPDATE, label="label_ro", code="ORD101A")),
    "matrix_detail_en": (lambda wh: cat.matrix_detail(wh, "LIN101A", "en"), _DETAIL.format(name=_EITHER.format("m.name"), context=_EITHER.format("c.name"), update=_UPDATE, label=_EITHER.format("label"), code="LIN101A")),
    "matrix_dimension": (lambda wh: cat.matrix_dimension(wh, "LIN101A", 0), f", {_OPTIONS} SELECT 'Retur' AS label_ro, dimension_type, option_code, option_name FROM taken WHERE dim_index = 0"),
    "options_search": (lambda wh: cat.find_options(wh, "LIN101A", "ASIA"), f", {_OPTIONS} SELECT * FROM taken WHERE contains(lower(option_name), 'asia')"),
    "breakdowns_last": (lambda wh: cat.option_samples(wh, "LIN101A", 3, True), f", {_OPTIONS} SELECT *, row_number() OVER (PARTITION BY dim_index ORDER BY option_code DESC) AS place FROM taken QUALIFY place <= 3"),
    "pending_domains": (lambda wh: cat.domains(wh), "SELECT left(matrix_code, 3) AS domain, count(*) AS matrix_count FROM matrices WHERE sync_status = 'PENDING' GROUP BY 1"),
    "dimension_labels": (lambda wh: cat.dimension_labels(wh), "SELECT label_ro, label_en, count(*) AS matrix_count FROM dimensions WHERE dimension_type = 'TERRITORIAL' GROUP BY 1, 2"),
    "dimensions_search": (lambda wh: cat.search_dimensions(wh, "judete"), "SELECT matrix_code, name_ro FROM matrices m WHERE EXISTS (SELECT 1 FROM dimensions d WHERE d.matrix_id = m.matrix_id AND contains(lower(label_ro), 'judete'))"),
    "catalog_search": (lambda wh: cat.find(wh, "Economy"), "SELECT 'context' AS kind, code, name_ro FROM contexts WHERE contains(lower(code), 'economy') OR contains(lower(name_ro), 'economy') UNION ALL SELECT 'matrix', matrix_code, name_ro FROM matrices WHERE contains(lower(matrix_code), 'economy') OR contains(lower(name_ro), 'economy')"),
    "refresh_selection": (lambda wh: cat.to_refresh(wh, NOW, older_than_days=30), f"{_SYNCED} AND sync_status IN ('SYNCED', 'STALE') AND CAST(last_sync_at AS TIMESTAMP) < TIMESTAMP '{NOW}' - INTERVAL 30 DAY"),
    "refresh_selection_stale": (lambda wh: cat.to_refresh(wh, NOW, True), f"{_SYNCED} AND sync_status = 'STALE'"),
    "territories_siruta": (lambda wh: cat.territories(wh, siruta="12"), "SELECT code, name, level, path FROM territories WHERE siruta_code = '12'"),
    "territories_label": (lambda wh: cat.territories(wh, label="R1"), "SELECT code, name, level, path FROM territories WHERE list_contains(string_split(path, '.'), 'R1')"),
    "available_data_page": (
        lambda wh: cat.available_data(wh, 105, "LIN101A", 2),
        "SELECT matrix_code, name_ro, count(*) AS fact_count, count(DISTINCT time_period_id) AS period_count, min(year) AS min_year, max(year) AS max_year FROM statistics JOIN time_periods USING (time_period_id) JOIN matrices USING (matrix_id) WHERE territory_id = 105 GROUP BY 1, 2 HAVING matrix_code > 'LIN101A' ORDER BY matrix_code LIMIT 3",
    ),
    "class_values_roots": (lambda wh: cat.class_values(wh, "PART_NAME", roots_only=True), f"SELECT code, name_ro, sort_order FROM {_TREE} WHERE type_code = 'PART_NAME' AND parent_id IS NULL"),
    "class_values_below": (lambda wh: cat.class_values(wh, "PART_NAME", parent_id=1001, level=2), f"SELECT code, name_ro, sort_order FROM {_TREE} WHERE type_code = 'PART_NAME' AND parent_id = 1001 AND level = 2"),
    "class_values_plain": (lambda wh: cat.class_values(wh, "PART_NAME", "  Gèar "), "SELECT code, name_ro, sort_order FROM class_values WHERE type_code = 'PART_NAME' AND contains(upper(name_ro), 'GEAR')"),
    "class_value": (lambda wh: cat.class_value(wh, "PART_NAME", 1000), f"SELECT CASE WHEN value_id = 1000 THEN 'value' ELSE 'child' END AS kind, value_id, code, name_ro, parent_id, level, sort_order FROM {_TREE} WHERE type_code = 'PART_NAME' AND (value_id = 1000 OR parent_id = 1000)"),
    "class_value_flat": (lambda wh: cat.class_value(wh, "PRIORITY", 2000), f"SELECT 'value' AS kind, value_id, code, name_ro, parent_id, level, sort_order FROM {_TREE} WHERE value_id = 2000"),
    "table_row_counts": (lambda wh: wh.row_counts().filter("table_name IN ('statistics', 'territories', 'units')"), "SELECT 'statistics' AS table_name, count(*) AS row_count FROM statistics UNION ALL SELECT 'territories', count(*) FROM territories UNION ALL SELECT 'units', count(*) FROM units"),
    "contexts_list_en": (lambda wh: cat.contexts(wh, "en"), f"SELECT code, {EN}, level, path, children_type FROM contexts"),
    "contexts_filtered": (lambda wh: cat.contexts(wh, level=1, path_prefix="3.10"), "SELECT code, name_ro AS name, level, path, children_type FROM contexts WHERE level = 1 AND starts_with(path, '3.10')"),
    "context_ancestors": (lambda wh: cat.context_ancestors(wh, "3.102"), "SELECT code, name_ro, level, path FROM contexts WHERE starts_with('3.102', path || '.')"),
    "context_children": (lambda wh: cat.context_children(wh, 3).unionByName(cat.context_children(wh, 102)), "SELECT code, name_ro, 'context' AS kind FROM contexts WHERE parent_id IN (3, 102) UNION ALL SELECT matrix_code, name_ro, 'matrix' FROM matrices WHERE context_id IN (3, 102)"),
    "matrices_list": (lambda wh: cat.matrices(wh), _matrices("true")),
    "matrices_search_en": (lambda wh: cat.matrices(wh, "en", search="Brand 2"), _matrices("contains(lower(coalesce(m.name_en, m.name_ro)), 'brand 2') OR contains(lower(matrix_code), 'brand 2')", "CASE WHEN coalesce(m.name_en, '') <> '' THEN m.name_en ELSE m.name_ro END AS name")),
    "matrices_filtered": (lambda wh: cat.matrices(wh, context_path="3", periodicity="MONTHLY", has_uat=False, has_county=True), _matrices("starts_with(c.path, '3') AND list_contains(periodicity, 'MONTHLY') AND NOT has_uat AND has_county")),
    "matrices_status": (lambda wh: cat.matrices(wh, status="PENDING"), _matrices("sync_status = 'PENDING'")),
    "matrix_dimensions": (lambda wh: cat.dimensions(wh, "PRD304", "en"), "SELECT dim_index, CASE WHEN coalesce(label_en, '') <> '' THEN label_en ELSE label_ro END AS label, dimension_type, type_code, option_count FROM dimensions WHERE matrix_id = 1304"),
    "matrix_options": (lambda wh: cat.dimension_options(wh, "LIN101A"), f", {_OPTIONS} SELECT * FROM taken"),
    "breakdowns_samples": (lambda wh: cat.option_samples(wh, "LIN101A"), f", {_OPTIONS} SELECT *, row_number() OVER (PARTITION BY dim_index ORDER BY option_code) AS place FROM taken QUALIFY place <= 5"),
    "territories_level": (lambda wh: cat.territories(wh, level="NUTS3"), "SELECT code, name, level, path FROM territories WHERE level = 'NUTS3'"),
    "territories_prefix": (lambda wh: cat.territories(wh, path_prefix="W.M1.R1.N1"), "SELECT code, name, level, path FROM territories WHERE starts_with(path, 'W.M1.R1.N1')"),
    "territories_search": (lambda wh: cat.territories(wh, search="east"), "SELECT code, name, level, path FROM territories WHERE contains(upper(name), 'EAST')"),
    "territories_parent": (lambda wh: cat.territories(wh, parent_id=12), "SELECT code, name, level, path FROM territories WHERE parent_id = 12"),
    "territories_page": (lambda wh: cat.page_by_name(cat.territories(wh), 50, ("Customer#000000040", "C40")), "SELECT code, name, level, path FROM territories WHERE (name, code) > ('Customer#000000040', 'C40') ORDER BY name, code LIMIT 51"),
    "territory_ancestors": (lambda wh: cat.ancestors(wh, 100042), f"SELECT code, name, level, {DEPTH} AS depth FROM territories WHERE (SELECT path FROM territories WHERE territory_id = 100042) = path OR starts_with((SELECT path FROM territories WHERE territory_id = 100042), path || '.')"),
    "territory_descendants": (lambda wh: cat.descendants(wh, 101), f"SELECT code, name, level, {DEPTH} AS depth FROM territories WHERE path = 'W.M1.R1.N1' OR starts_with(path, 'W.M1.R1.N1.')"),
    "territory_descendants_depth": (lambda wh: cat.descendants(wh, 1, 2), f"SELECT code, name, level, {DEPTH} AS depth FROM territories WHERE {DEPTH} <= 3"),
    "territory_children": (lambda wh: cat.children(wh, 3), "SELECT code, name, level FROM territories WHERE parent_id = 3"),
    "available_data": (lambda wh: cat.available_data(wh, 105), "SELECT matrix_code, name_ro, count(*) AS fact_count, count(DISTINCT time_period_id) AS period_count, min(year) AS min_year, max(year) AS max_year FROM statistics JOIN time_periods USING (time_period_id) JOIN matrices USING (matrix_id) WHERE territory_id = 105 GROUP BY 1, 2"),
    "time_periods_list": (lambda wh: cat.time_periods(wh), _periods("true")),
    "time_periods_filtered": (lambda wh: cat.time_periods(wh, "QUARTERLY", 1996, 1998), _periods("periodicity = 'QUARTERLY' AND year BETWEEN 1996 AND 1998")),
    "time_periods_of_matrix": (lambda wh: cat.time_periods(wh, matrix="EVT101A"), _periods("time_period_id IN (SELECT time_period_id FROM statistics WHERE matrix_id = 4)")),
    "time_periods_unknown_matrix": (lambda wh: cat.time_periods(wh, "ANNUAL", matrix="NOPE"), _periods("periodicity = 'ANNUAL'")),
    "class_types": (lambda wh: cat.class_types(wh), "SELECT type_code, name_ro, is_hierarchical, (SELECT count(*) FROM class_values v WHERE v.type_code = t.type_code) AS value_count FROM class_types t"),
    "class_types_search": (lambda wh: cat.class_types(wh, "produse", True), "SELECT type_code, name_ro, is_hierarchical, (SELECT count(*) FROM class_values v WHERE v.type_code = t.type_code) AS value_count FROM class_types t WHERE (contains(lower(name_ro), 'produse') OR contains(lower(type_code), 'produse')) AND is_hierarchical"),
    "class_values": (lambda wh: cat.class_values(wh, "PART_NAME", "RIN"), "SELECT code, name_ro, sort_order FROM class_values WHERE type_code = 'PART_NAME' AND (contains(lower(name_ro), 'rin') OR contains(lower(code), 'rin'))"),
    "topics": (lambda wh: cat.topics(wh, "en"), f"SELECT category, slug, {EN}, (SELECT count(DISTINCT matrix_id) FROM tag_links l WHERE l.tag_id = t.tag_id) AS matrix_count FROM tags t"),
    "topics_category": (lambda wh: cat.topics(wh, category="topic"), "SELECT category, slug, name_ro AS name, (SELECT count(DISTINCT matrix_id) FROM tag_links l WHERE l.tag_id = t.tag_id) AS matrix_count FROM tags t WHERE category = 'topic'"),
    "by_territory": (lambda wh: cat.by_territory(wh, 11), _by_territory("territory_id = 11")),
    "by_territory_subtree": (lambda wh: cat.by_territory(wh, 11, True), _by_territory("path = 'W.M1.R1' OR starts_with(path, 'W.M1.R1.')")),
    "by_territory_level": (lambda wh: cat.by_territory(wh, 1, True, "NUTS2"), _by_territory("level = 'NUTS2'")),
    "by_time_range": (lambda wh: cat.by_time_range(wh, 2000, 2024), "SELECT matrix_code, year_from, year_to, greatest(0, least(year_to, 2024) - greatest(year_from, 2000) + 1) AS coverage_years FROM matrices WHERE year_from IS NOT NULL AND least(year_to, 2024) >= greatest(year_from, 2000)"),
    "by_time_range_periodicity": (lambda wh: cat.by_time_range(wh, 1990, 1996, "MONTHLY"), "SELECT matrix_code, year_from, year_to, least(year_to, 1996) - year_from + 1 AS coverage_years FROM matrices WHERE year_from <= 1996 AND list_contains(periodicity, 'MONTHLY')"),
    "by_breakdowns": (
        lambda wh: cat.by_breakdowns(wh, territory=True, low=3, high=4),
        "SELECT matrix_code, count(*) AS dimension_count, string_agg(DISTINCT dimension_type, ',' ORDER BY dimension_type) AS kinds FROM matrices JOIN dimensions d USING (matrix_id) GROUP BY 1 HAVING bool_or(dimension_type = 'TERRITORIAL') AND count(*) BETWEEN 3 AND 4",
    ),
    "by_breakdowns_absent": (
        lambda wh: cat.by_breakdowns(wh, territory=False, temporal=True),
        "SELECT matrix_code, count(*) AS dimension_count, string_agg(DISTINCT dimension_type, ',' ORDER BY dimension_type) AS kinds FROM matrices JOIN dimensions d USING (matrix_id) GROUP BY 1 HAVING NOT bool_or(dimension_type = 'TERRITORIAL')",
    ),
    "by_breakdowns_type": (
        lambda wh: cat.by_breakdowns(wh, type_code="PART_NAME"),
        "SELECT matrix_code, count(*) AS dimension_count, string_agg(DISTINCT dimension_type, ',' ORDER BY dimension_type) AS kinds FROM matrices JOIN dimensions d USING (matrix_id) GROUP BY 1 HAVING bool_or(type_code = 'PART_NAME')",
    ),
    "tag_matrices": (lambda wh: cat.tag_matrices(wh, "quality"), "SELECT DISTINCT matrix_code, matrices.name_ro, sync_status FROM tag_links JOIN tags USING (tag_id) JOIN matrices USING (matrix_id) WHERE slug = 'quality'"),
    "tags_related": (
        lambda wh: cat.related_tags(wh, "orders"),
        "SELECT t.slug, t.category, count(DISTINCT b.matrix_id) AS shared FROM tag_links a JOIN tags o ON o.tag_id = a.tag_id AND o.slug = 'orders' JOIN tag_links b ON b.matrix_id = a.matrix_id AND b.tag_id <> a.tag_id JOIN tags t ON t.tag_id = b.tag_id GROUP BY 1, 2 ORDER BY shared DESC, t.slug LIMIT 10",
    ),
}
