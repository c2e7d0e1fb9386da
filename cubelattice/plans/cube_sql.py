"""DuckDB common table expressions of the sample cube, for the oracle of each query."""

from __future__ import annotations

from cubelattice.functions.labels import MONTHS_EN, MONTHS_RO
from cubelattice.plans.derived_sql import DERIVED, HELPERS
from cubelattice.sources.catalog_rows import CLASS_VALUES, STATIC

_KINDS = {"int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE", "array<string>": "VARCHAR[]", "array<int>": "INTEGER[]"}


def _literal(x, kind: str) -> str:
    if x is None:
        return f"CAST(NULL AS {_KINDS[kind]})"
    if isinstance(x, list):
        return f"CAST([{', '.join(_literal(v, 'string' if isinstance(v, str) else 'int') for v in x)}] AS {_KINDS[kind]})"
    if isinstance(x, str):
        return "'" + x.replace("'", "''") + "'"
    return f"CAST({str(x).lower()} AS {_KINDS[kind]})"


def _static(name: str) -> str:
    rows, schema = STATIC[name]
    columns = [c.split(" ") for c in schema.split(", ")]
    values = ", ".join("(" + ", ".join(_literal(x, k) for x, (_, k) in zip(r, columns, strict=True)) + ")" for r in rows)
    derived = f" UNION ALL {DERIVED[name]}" if name in DERIVED else ""
    return f"{name}({', '.join(c for c, _ in columns)}) AS (VALUES {values}{derived})"


def _class_case(kind: str, column: str) -> str:
    return "CASE " + column + "".join(f" WHEN '{c}' THEN {v}" for v, t, c, _, _ in CLASS_VALUES if t == kind and c != "TOTAL") + " END"


def _names(names: list[str]) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


_KEY = "md5(concat_ws(':', {matrix}, coalesce(CAST(territory_id AS VARCHAR), 'null'), time_period_id, {unit}, array_to_string(list_sort(list_transform(class_ids, lambda i: CAST(i AS VARCHAR))), ',')))"


def _facts(name: str, matrix: int, unit: int, source: str, where: str = "true") -> str:
    return f"""{name} AS (
  SELECT {matrix} AS matrix_id, {_KEY.format(matrix=matrix, unit=unit)} AS natural_key, territory_id, time_period_id, {unit} AS unit_id, value, CAST(NULL AS VARCHAR) AS value_status, class_ids
  FROM (
    SELECT territory_id, time_period_id, class_ids, CAST(sum(amount) AS DOUBLE) AS value
    FROM (SELECT territory_id, time_period_id, unnest(classes) AS class_ids, amount
          FROM (SELECT territory_id, unnest(periods) AS time_period_id, classes, amount
                FROM (SELECT unnest(territories) AS territory_id, periods, classes, amount FROM ({source}))))
    WHERE {where} GROUP BY ALL))"""


_PLACED = """placed AS (
  SELECT o_custkey, n_nationkey, n_regionkey AS r, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, o_orderstatus, c_mktsegment, CAST(o_totalprice AS DECIMAL(18,2)) AS price
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey)"""

_CHAIN = "1, 2 + r % 2, 10 + r, 100 + n_nationkey"

_TERRITORIES = """territories AS (SELECT *, CASE WHEN level = 'LAU' THEN substr(code, 2) END AS siruta_code FROM (
  SELECT 1 AS territory_id, 'W' AS code, 'World' AS name, 'NATIONAL' AS level, CAST(NULL AS INTEGER) AS parent_id, 'W' AS path
  UNION ALL SELECT DISTINCT 2 + r_regionkey % 2, 'M' || (r_regionkey % 2), 'Macro ' || (r_regionkey % 2), 'NUTS1', 1, 'W.M' || (r_regionkey % 2) FROM region
  UNION ALL SELECT 10 + r_regionkey, 'R' || r_regionkey, r_name, 'NUTS2', 2 + r_regionkey % 2, 'W.M' || (r_regionkey % 2) || '.R' || r_regionkey FROM region
  UNION ALL SELECT 100 + n_nationkey, 'N' || n_nationkey, n_name, 'NUTS3', 10 + n_regionkey, 'W.M' || (n_regionkey % 2) || '.R' || n_regionkey || '.N' || n_nationkey FROM nation
  UNION ALL SELECT CAST(100000 + c_custkey AS INTEGER), 'C' || c_custkey, c_name, 'LAU', 100 + n_nationkey, 'W.M' || (n_regionkey % 2) || '.R' || n_regionkey || '.N' || n_nationkey || '.C' || c_custkey FROM customer JOIN nation ON n_nationkey = c_nationkey))"""

_PERIODS = f"""months AS (
  SELECT DISTINCT CAST(year(d) AS INTEGER) AS y, CAST(month(d) AS INTEGER) AS m FROM (SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem UNION ALL SELECT ts FROM events)
), raw_periods AS (
  SELECT DISTINCT y * 10000 AS time_period_id, y AS year, CAST(NULL AS INTEGER) AS quarter, CAST(NULL AS INTEGER) AS month, 'ANNUAL' AS periodicity FROM months
  UNION ALL SELECT DISTINCT CAST(y * 10000 + ceil(m / 3) * 100 AS INTEGER), y, CAST(ceil(m / 3) AS INTEGER), NULL, 'QUARTERLY' FROM months
  UNION ALL SELECT y * 10000 + 1000 + m, y, NULL, m, 'MONTHLY' FROM months
), time_periods AS (
  SELECT *, make_date(year, coalesce(month, (quarter - 1) * 3 + 1, 1), 1) AS period_start, last_day(make_date(year, coalesce(month, quarter * 3, 12), 1)) AS period_end,
         CASE periodicity WHEN 'ANNUAL' THEN 'Anul ' || year WHEN 'QUARTERLY' THEN 'Trimestrul ' || (['I', 'II', 'III', 'IV'])[quarter] || ' ' || year ELSE 'Luna ' || ({_names(MONTHS_RO)})[month] || ' ' || year END AS label_ro,
         CASE periodicity WHEN 'ANNUAL' THEN 'Year ' || year WHEN 'QUARTERLY' THEN 'Quarter ' || quarter || ' ' || year ELSE 'Month ' || ({_names(MONTHS_EN)})[month] || ' ' || year END AS label_en
  FROM raw_periods)"""

_STATUS = _class_case("ORDER_STATUS", "o_orderstatus")
_SEGMENT = _class_case("SEGMENT", "c_mktsegment")

_STATISTICS = ",\n".join(
    [
        _PLACED,
        _facts("f1", 1, 1, f"SELECT [{_CHAIN}, CAST(100000 + o_custkey AS INTEGER)] AS territories, [y * 10000, y * 10000 + 1000 + m] AS periods, [[1], [{_STATUS}]] AS classes, price AS amount FROM placed", "territory_id < 100000 OR (class_ids = [1] AND time_period_id % 10000 = 0)"),
        _facts("f2", 2, 2, f"SELECT [{_CHAIN}] AS territories, [y * 10000] AS periods, [[1, 11], [1, {_SEGMENT}], [{_STATUS}, 11], [{_STATUS}, {_SEGMENT}]] AS classes, 1 AS amount FROM placed"),
        f"""shipped AS (
  SELECT n_nationkey, n_regionkey AS r, CAST(year(l_shipdate) AS INTEGER) AS y, CAST(month(l_shipdate) AS INTEGER) AS m, {_class_case("RETURN_FLAG", "l_returnflag")} AS flag, CAST(l_quantity AS DECIMAL(18,2)) AS quantity
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey)""",
        _facts("f3", 3, 3, f"SELECT [{_CHAIN}] AS territories, [y * 10000, CAST(y * 10000 + ceil(m / 3) * 100 AS INTEGER)] AS periods, [[21], [flag]] AS classes, quantity AS amount FROM shipped"),
        _facts("f4", 4, 2, f"SELECT [CAST(NULL AS INTEGER)] AS territories, [CAST(year(ts) * 10000 + 1000 + month(ts) AS INTEGER)] AS periods, [[31], [{_class_case('EVENT_TYPE', 'event_type')}]] AS classes, CAST(value AS DECIMAL(18,2)) AS amount FROM events"),
        f"""f5 AS (
  SELECT 5 AS matrix_id, {_KEY.format(matrix=5, unit=1)} AS natural_key, territory_id, time_period_id, 1 AS unit_id,
         CASE WHEN (territory_id + time_period_id // 10000) % 7 <> 0 THEN value END AS value, CASE WHEN (territory_id + time_period_id // 10000) % 7 = 0 THEN 'missing' END AS value_status, class_ids
  FROM (SELECT 100 + n_nationkey AS territory_id, y * 10000 AS time_period_id, CAST([] AS INTEGER[]) AS class_ids, CAST(sum(price) AS DOUBLE) AS value FROM placed GROUP BY ALL))""",
        "statistics AS (SELECT * FROM f1 UNION ALL SELECT * FROM f2 UNION ALL SELECT * FROM f3 UNION ALL SELECT * FROM f4 UNION ALL SELECT * FROM f5)",
        "bridge AS (SELECT matrix_id, natural_key, unnest(class_ids) AS value_id FROM statistics)",
    ]
)


def over_cube(query: str) -> str:
    """The query with the cube's tables in front of it."""
    return "WITH " + ",\n".join([_TERRITORIES, _PERIODS, HELPERS, *map(_static, STATIC), _STATISTICS]) + "\n" + query
