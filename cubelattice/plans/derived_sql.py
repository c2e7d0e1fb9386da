"""The derived catalog entries in DuckDB's SQL: helper tables, and the rows that each catalog table takes besides the fixed ones."""

from __future__ import annotations

from cubelattice.functions.labels import MONTHS_RO

HELPERS = """part_types AS (SELECT p_type, CAST(row_number() OVER (ORDER BY p_type) AS INTEGER) AS type_no FROM (SELECT DISTINCT p_type FROM part)),
products AS (
  SELECT *, 1000 + type_no * 100 + brand_no AS matrix_id FROM part_types JOIN (
    SELECT p_type, CAST(substr(p_brand, 7) AS INTEGER) AS brand_no, CAST(count(DISTINCT p_partkey) AS INTEGER) AS parts, CAST(count(DISTINCT p_size) AS INTEGER) AS sizes, CAST(count(DISTINCT p_name) AS INTEGER) AS names,
           CAST(count(DISTINCT l_suppkey) AS INTEGER) AS suppliers, CAST(min(year(l_shipdate)) AS INTEGER) AS year_from, CAST(max(year(l_shipdate)) AS INTEGER) AS year_to, max(l_shipdate) AS last_ship
    FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2) USING (p_type)),
nouns AS (SELECT noun, CAST(1000 + row_number() OVER (ORDER BY noun) AS INTEGER) AS noun_id FROM (SELECT DISTINCT split_part(p_name, ' ', -1) AS noun FROM part)),
part_names AS (
  SELECT 1000 AS value_id, CAST(NULL AS INTEGER) AS parent_id, 0 AS level, 'TOTAL' AS code, 'Total' AS name, 0 AS sort_order FROM part LIMIT 1),
all_names AS (
  SELECT * FROM part_names UNION ALL SELECT noun_id, 1000, 1, upper(noun), noun, noun_id - 1000 FROM nouns
  UNION ALL SELECT CAST(1100 + nth AS INTEGER), noun_id, 2, upper(replace(p_name, ' ', '_')), p_name, CAST(nth AS INTEGER)
  FROM (SELECT p_name, split_part(p_name, ' ', -1) AS noun, row_number() OVER (ORDER BY p_name) AS nth FROM (SELECT DISTINCT p_name FROM part)) JOIN nouns USING (noun)),
priorities AS (
  (SELECT 2000 AS value_id, CAST(NULL AS INTEGER) AS parent_id, 0 AS level, 'TOTAL' AS code, 'Total' AS name, 0 AS sort_order FROM orders LIMIT 1)
  UNION ALL SELECT CAST(2000 + nth AS INTEGER), 2000, 1, substr(p, 3), p, CAST(nth AS INTEGER) FROM (SELECT p, row_number() OVER (ORDER BY p) AS nth FROM (SELECT DISTINCT o_orderpriority AS p FROM orders))),
sent AS (SELECT *, CAST(1000 + (event_id % 6 + 1) * 100 + event_id % 25 + 1 AS INTEGER) AS matrix_id, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events)"""

_STAMP = "'%Y-%m-%d %H:%M:%S'"

DERIVED = {
    "class_values": "SELECT value_id, 'PART_NAME', code, name, sort_order FROM all_names UNION ALL SELECT value_id, 'PRIORITY', code, name, sort_order FROM priorities",
    "class_tree": "SELECT value_id, parent_id, level FROM all_names UNION ALL SELECT value_id, parent_id, level FROM priorities",
    "label_mappings": f"""SELECT upper(label), label, 'TIME_PERIOD', '', CAST(y * 10000 + 1000 + m AS VARCHAR), 'PATTERN', NULL, '2024-01-05 08:00:00'
      FROM (SELECT y, m, 'Luna ' || ({MONTHS_RO})[m] || ' ' || y AS label FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m FROM orders))
      UNION ALL SELECT upper(p), p, 'TERRITORY', 'ORD101A', NULL, NULL, 'no territory', '2024-01-06 08:00:0' || left(p, 1) FROM (SELECT DISTINCT o_orderpriority AS p FROM orders)""",
    "class_types": "(SELECT 'PART_NAME', 'Produse după nume', 'Products by name', true FROM part LIMIT 1) UNION ALL (SELECT 'PRIORITY', 'Prioritate', '', false FROM orders LIMIT 1)",
    "units": "SELECT 100 + p_size, 'MARIME_' || p_size, 'Mărime ' || p_size, CASE WHEN p_size % 2 = 0 THEN 'Size ' || p_size ELSE '' END, 'm' || p_size FROM (SELECT DISTINCT p_size FROM part)",
    "contexts": "SELECT 100 + type_no, CAST(100 + type_no AS VARCHAR), 'Produse ' || p_type, CASE WHEN type_no % 2 = 0 THEN 'Products ' || p_type END, 1, 3, '3.' || (100 + type_no), 'matrix' FROM part_types",
    "matrices": """SELECT matrix_id, 'PRD' || type_no || lpad(CAST(brand_no AS VARCHAR), 2, '0'), 'Produse ' || p_type || ' marca ' || brand_no, CASE WHEN brand_no % 2 = 0 THEN 'Products ' || p_type || ' brand ' || brand_no ELSE '' END, 100 + type_no,
      (['SYNCED', 'STALE', 'PENDING', 'FAILED'])[parts % 4 + 1], CASE WHEN brand_no % 2 = 0 THEN ['ANNUAL', 'MONTHLY'] ELSE ['ANNUAL'] END, year_from, year_to, false, parts % 2 = 0, strftime(last_ship, '%d-%m-%Y') FROM products""",
    "dimensions": """SELECT matrix_id, 0, 'Produse', 'Products', 'CLASSIFICATION', 'PART_NAME', names FROM products
      UNION ALL SELECT matrix_id, 1, 'Ani', NULL, 'TEMPORAL', NULL, year_to - year_from + 1 FROM products UNION ALL SELECT matrix_id, 2, 'Judete de livrare', 'Counties of delivery', 'TERRITORIAL', NULL, suppliers FROM products WHERE parts % 2 = 0""",
    "tags": "SELECT 100 + n, 'brand-' || n, 'Marca ' || n, CASE WHEN n % 2 = 0 THEN 'Brand ' || n END, CASE WHEN n % 2 = 0 THEN 'topic' ELSE 'audience' END FROM (SELECT DISTINCT CAST(substr(p_brand, 7) AS INTEGER) AS n FROM part)",
    "tag_links": "SELECT matrix_id, 100 + brand_no FROM products UNION ALL SELECT matrix_id, 1 FROM products WHERE p_type = 'PROMO' UNION ALL SELECT matrix_id, 4 FROM products WHERE parts % 3 = 0",
    "indicators": "SELECT 'share-' || lower(s), 'Ponderea ' || s, CASE WHEN length(s) % 2 = 0 THEN 'Share of ' || s END, 'segments', length(s) <> 7, 100.0 FROM (SELECT DISTINCT c_mktsegment AS s FROM customer)",
    "indicator_parts": "SELECT 'share-' || lower(s), role, 'ORD102A', 'SEGMENT', CASE role WHEN 'numerator' THEN s ELSE 'TOTAL' END FROM (SELECT DISTINCT c_mktsegment AS s FROM customer), (VALUES ('numerator'), ('denominator')) AS r(role)",
    "tasks": f"""SELECT CAST(1000 + event_id AS INTEGER), matrix_id, CASE WHEN event_type = 'purchase' THEN 'COMPLETED' WHEN event_type = 'error' THEN 'FAILED' WHEN k % 2 = 0 THEN 'RUNNING' ELSE 'PENDING' END, 1995, 2001, k % 10, k,
      CASE WHEN event_type = 'purchase' THEN k ELSE k // 2 END, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END, CAST(floor(value * 10) AS INTEGER), CAST(user_id AS INTEGER), strftime(ts, {_STAMP}), CASE WHEN event_type = 'signup' AND k % 2 = 0 THEN strftime(ts + INTERVAL 20 DAY, {_STAMP}) END
      FROM sent WHERE event_type IN ('purchase', 'error', 'signup')""",
    "chunks": f"""SELECT CAST(1000 + event_id AS INTEGER), matrix_id, left(md5(CAST(event_id AS VARCHAR)), 8), (['COMPLETED', 'FAILED', 'EXHAUSTED', 'IN_PROGRESS'])[k % 4 + 1], k % 4, CASE WHEN k % 4 = 1 AND k % 3 > 0 THEN strftime(ts + INTERVAL 20 DAY, {_STAMP}) END,
      CASE k % 4 WHEN 1 THEN 'HTTP ' || (400 + k) WHEN 2 THEN 'permanent' END, CASE WHEN k % 4 = 0 THEN CAST(floor(value * 100) AS INTEGER) END FROM sent WHERE event_type IN ('click', 'view')""",
}
