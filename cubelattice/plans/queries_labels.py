"""Label, resolver and planner queries over labels that the cube's tables give, each with its oracle.

Labels are spelled in several ways out of periods, territories, units and values, among them some that name nothing, and the
oracle knows what each stands for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubelattice.functions import expr, labels
from cubelattice.functions.unit_names import UNITS
from cubelattice.operators import ingest as ing
from cubelattice.operators import resolve as res
from cubelattice.plans.chunking import CELLS, Dimension, Option, chunk_rows
from cubelattice.sources.derived import text
from cubelattice.sources.landing import MATRIX_JSON
from cubelattice.sources.warehouse import Warehouse

#: A normalised label in the oracles.
PLAIN = "trim(regexp_replace(upper(strip_accents({0})), '\\s+', ' ', 'g'))"
CODE = "substr(regexp_replace(replace({0}, ' ', '_'), '[^0-9A-Z_]', '', 'g'), 1, 50)"


def _listed(names: list[str]) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


# time labels


def time_spellings(wh: Warehouse) -> DataFrame:
    """(time_period_id, spelling, label): spellings of every period, the last ones of each kind naming none."""
    year = F.col("year")
    roman, month = labels._name(labels.QUARTERS, F.col("quarter")), labels._name(labels.MONTHS_RO, F.col("month"))
    kinds = {
        "ANNUAL": [text("Anul ", year), text(" anul ", year, " "), text(year), text(year, "-", year + 4), text(year, "–", year + 4), text("Anii ", year - 5, "-", year), F.lit("Total"), text("text ", year)],
        "QUARTERLY": [text("Trimestrul ", roman, " ", year), text("trimestrul ", roman, " ", year), text("T", F.col("quarter"), " ", year), text("Trimestrul ", F.lower(roman), " ", year), text("T5 ", year)],
        "MONTHLY": [text("Luna ", month, " ", year), text("luna ", F.upper(month), " ", year), text(labels._name(labels.MONTHS_RO_SHORT, F.col("month")), " ", year), text("Luna Brumar ", year), text("Abc ", year), text(month)],
    }
    spelled = F.lit(None).cast("array<string>")
    for kind, forms in kinds.items():
        spelled = F.when(F.col("periodicity") == kind, F.array(*forms)).otherwise(spelled)
    return wh.time_periods.select("time_period_id", F.posexplode(spelled).alias("spelling", "label"))


def _parsed(wh: Warehouse) -> DataFrame:
    return time_spellings(wh).select("time_period_id", "spelling", "label", labels.parse_time_label(F.col("label")).alias("p")).select("time_period_id", "spelling", "label", "p.year", "p.quarter", "p.month", "p.periodicity")


_ROMAN, _MONTH = f"({_listed(labels.QUARTERS)})[quarter]", f"({_listed(labels.MONTHS_RO)})[month]"
_SPELLED = f"""spelled AS (
  SELECT *, CASE periodicity
    WHEN 'ANNUAL' THEN ['Anul ' || year, ' anul ' || year || ' ', '' || year, year || '-' || (year + 4), year || '–' || (year + 4), 'Anii ' || (year - 5) || '-' || year, 'Total', 'text ' || year]
    WHEN 'QUARTERLY' THEN ['Trimestrul ' || {_ROMAN} || ' ' || year, 'trimestrul ' || {_ROMAN} || ' ' || year, 'T' || quarter || ' ' || year, 'Trimestrul ' || lower({_ROMAN}) || ' ' || year, 'T5 ' || year]
    ELSE ['Luna ' || {_MONTH} || ' ' || year, 'luna ' || upper({_MONTH}) || ' ' || year, ({_listed(labels.MONTHS_RO_SHORT)})[month] || ' ' || year, 'Luna Brumar ' || year, 'Abc ' || year, {_MONTH}] END AS forms,
    CASE periodicity WHEN 'ANNUAL' THEN 6 ELSE 3 END AS good FROM time_periods),
each_label AS (SELECT * EXCLUDE (forms), unnest(forms) AS label, generate_subscripts(forms, 1) AS nth FROM spelled)"""
_TIME = f""", {_SPELLED} SELECT time_period_id, CAST(nth - 1 AS INTEGER) AS spelling, label, CASE WHEN nth <= good THEN year END AS year, CASE WHEN nth <= good THEN quarter END AS quarter, CASE WHEN nth <= good THEN month END AS month,
  CASE WHEN nth <= good THEN periodicity END AS periodicity FROM each_label"""


def _mapped(wh: Warehouse) -> DataFrame:
    """The mapping cache after the full spelling of every period, and one of none."""
    given = time_spellings(wh).filter("spelling = 0 or label like 'Luna Brumar%'").select("label").distinct()
    found = res.periods(wh.time_periods, given).select("label", F.col("time_period_id").alias("target"))
    rows = res.mapped(given.withColumn("hint", F.lit(None).cast("string")), wh.label_mappings, found, "TIME_PERIOD", "no period", "2024-02-01 00:00:00")
    return res.remembered(wh.label_mappings, rows).drop("context_hint")


_MAPPED = f""", {_SPELLED}, given AS (SELECT DISTINCT label, CASE WHEN nth <= good THEN time_period_id END AS id FROM each_label WHERE nth = 1 OR label LIKE 'Luna Brumar%'),
  hits AS (SELECT label_normalized FROM label_mappings WHERE context_type = 'TIME_PERIOD' AND context_hint = '' AND target IS NOT NULL),
  fresh AS (SELECT upper(label) AS label_normalized, label AS label_original, 'TIME_PERIOD' AS context_type, CAST(id AS VARCHAR) AS target, CASE WHEN id IS NULL THEN NULL WHEN upper(label) IN (FROM hits) THEN 'EXACT' ELSE 'PATTERN' END AS method,
            CASE WHEN id IS NULL THEN 'no period' END AS reason, '2024-02-01 00:00:00' AS created_at FROM given)
  SELECT * FROM fresh UNION ALL SELECT label_normalized, label_original, context_type, target, method, reason, created_at FROM label_mappings m
  WHERE NOT EXISTS (SELECT 1 FROM fresh f WHERE f.label_normalized = m.label_normalized AND f.context_type = m.context_type AND m.context_hint = '')"""


# units

_UNIT_ROWS = ", ".join("(" + ", ".join("'" + x.replace("'", "''") + "'" for x in row) + ")" for row in UNITS)


def _unit_labels(wh: Warehouse) -> DataFrame:
    name = F.col("name_ro")
    pair = lambda label, english=F.lit(None).cast("string"): F.struct(label.alias("label"), english.alias("label_en"))
    spelled = F.array(pair(text("UM: ", name), F.col("name_en")), pair(text(" um:   ", F.upper(name))), pair(name), pair(F.lit("UM: ")))
    return wh.units.select(F.explode(spelled).alias("x")).select("x.label", "x.label_en")


_UNITS_SQL = f""", spelled AS (
    SELECT 'UM: ' || name_ro AS label, name_en AS label_en, name_ro AS name FROM units UNION ALL SELECT ' um:   ' || upper(name_ro), NULL, upper(name_ro) FROM units UNION ALL SELECT name_ro, NULL, name_ro FROM units),
  dictionary(k, code, symbol, english) AS (VALUES {_UNIT_ROWS}), named AS (SELECT *, {PLAIN.format("name")} AS plain FROM spelled)
  SELECT label, coalesce(code, {CODE.format("plain")}) AS code, symbol, name AS name_ro, coalesce(label_en, english, name) AS name_en, plain AS name_normalized FROM named LEFT JOIN dictionary ON k = lower(plain)"""


def _unit_table(wh: Warehouse) -> DataFrame:
    """Units known by "UM: name", after labels that are their bare names and labels of brands, which are none yet."""
    known = wh.units.select("unit_id", "code", "symbol", "name_ro", "name_en", F.array(text("UM: ", F.col("name_ro"))).alias("patterns"))
    fresh = wh.tags.filter("slug like 'brand-%'").select(text("UM: ", F.col("name_ro")).alias("label"), F.lit(None).cast("string").alias("label_en"))
    given = wh.units.filter("unit_id > 100").select(F.col("name_ro").alias("label"), F.lit(None).cast("string").alias("label_en")).union(fresh)
    return res.find_or_create_units(known, given).select("unit_id", "code", "symbol", F.array_join("patterns", "|").alias("patterns"))


_UNIT_TABLE = f"""SELECT unit_id, code, symbol, 'UM: ' || name_ro || CASE WHEN unit_id > 100 THEN '|' || name_ro ELSE '' END AS patterns FROM units
  UNION ALL SELECT CAST((SELECT max(unit_id) FROM units) + row_number() OVER (ORDER BY {CODE.format("upper(name_ro)")}) AS INTEGER), {CODE.format("upper(name_ro)")}, NULL, 'UM: ' || name_ro FROM tags WHERE slug LIKE 'brand-%'"""


# territories


def _register(wh: Warehouse) -> DataFrame:
    return wh.territories.select("territory_id", "code", F.lpad("siruta_code", 6, "0").alias("siruta_code"))


def _found_places(wh: Warehouse) -> DataFrame:
    """Localities by register number and name, other territories by names that say nothing, numbers that nobody has."""
    number, name = F.lpad("siruta_code", 6, "0"), F.col("name")
    label = F.when(F.col("siruta_code").isNull(), text("Zona ", name)).when(F.col("territory_id") % 5 == 0, text("9", F.substring(number, 2, 5), " ", name)).otherwise(text(number, " ", name))
    return res.territories(_register(wh), wh.territories.select(label.alias("label")))


_PLACES = """SELECT CASE WHEN siruta_code IS NULL THEN 'Zona ' || name WHEN territory_id % 5 = 0 THEN '9' || substr(lpad(siruta_code, 6, '0'), 2) || ' ' || name ELSE lpad(siruta_code, 6, '0') || ' ' || name END AS label,
  CASE WHEN siruta_code IS NOT NULL AND territory_id % 5 <> 0 THEN territory_id END AS territory_id, CASE WHEN siruta_code IS NOT NULL AND territory_id % 5 <> 0 THEN code END AS code FROM territories"""


def _spelled_places(wh: Warehouse) -> DataFrame:
    """A county, region or number per territory of the cube, as its number gives it."""
    pick = lambda names, n: F.get(F.array(*map(F.lit, names)), n % len(names))
    n = F.substring("code", 2, 9).cast("int")
    county = text("Județul ", F.initcap(F.lower(pick(list(labels.COUNTIES), n))))
    spelled = (
        F.when(F.col("level") == "NATIONAL", "Nivel  Național").when(F.col("level") == "NUTS1", text("Macroregiunea ", F.lower(pick(list(labels.MACRO_REGIONS), n)))).when(F.col("level") == "NUTS2", text("Regiunea ", pick(list(labels.REGIONS), n)))
        .when(F.col("level") == "NUTS3", county).when(n % 3 == 0, text("Alba, ", F.col("name"))).otherwise(text(F.lpad("siruta_code", 5, "0"), " ", F.col("name")))
    )
    return wh.territories.select("territory_id", spelled.alias("label")).select("territory_id", "label", labels.resolve_territory(F.col("label")).alias("code"))


def _pick_sql(names: list[str], n: str = "n") -> str:
    return f"({_listed(names)})[{n} % {len(names)} + 1]"


_CAPITAL = "list_reduce(list_transform(string_split(lower({0}), ' '), lambda w: upper(w[1]) || w[2:]), lambda a, b: a || ' ' || b)"
_TERRITORIES = f"""SELECT territory_id, CASE level WHEN 'NATIONAL' THEN 'Nivel  Național' WHEN 'NUTS1' THEN 'Macroregiunea ' || lower({_pick_sql(list(labels.MACRO_REGIONS))}) WHEN 'NUTS2' THEN 'Regiunea ' || {_pick_sql(list(labels.REGIONS))}
    WHEN 'NUTS3' THEN 'Județul ' || {_CAPITAL.format(_pick_sql(list(labels.COUNTIES)))} ELSE CASE WHEN n % 3 = 0 THEN 'Alba, ' || name ELSE lpad(siruta_code, 5, '0') || ' ' || name END END AS label,
  CASE level WHEN 'NATIONAL' THEN 'RO' WHEN 'NUTS1' THEN {_pick_sql(list(labels.MACRO_REGIONS.values()))} WHEN 'NUTS2' THEN {_pick_sql(list(labels.REGIONS.values()))} WHEN 'NUTS3' THEN {_pick_sql(list(labels.COUNTIES.values()))}
    ELSE CASE WHEN n % 3 > 0 THEN lpad(siruta_code, 5, '0') END END AS code FROM (SELECT *, TRY_CAST(substr(code, 2) AS INTEGER) AS n FROM territories)"""


# classification values


def _class_values(wh: Warehouse) -> DataFrame:
    """Known names in other spellings, and a new value below each part name, spelled twice."""
    known = wh.class_values.select("value_id", "type_code", "code", expr.content_hash(F.col("name_ro")).alias("content_hash"), F.col("code").alias("path"), F.lit(None).cast("int").alias("parent_id"), F.lit(0).alias("level"), "name_ro", "sort_order")
    name, at = F.col("name_ro"), F.col("sort_order")
    none = F.lit(None).cast("string")
    row = lambda label, parent, level, place: F.struct("type_code", label.alias("label"), parent.alias("parent_label"), F.lit(level).alias("level"), place.alias("sort_order"))
    spelled = F.array(row(text("  ", F.upper(name), " "), none, 0, at), row(text(name, " nou"), name, 3, 2 * at + 1), row(text(F.upper(name), "  NOU"), name, 3, 2 * at + 2))
    rows = wh.class_values.filter("type_code = 'PART_NAME' and value_id > 1100").select(F.explode(spelled).alias("x")).select("x.*")
    found = res.class_values(known, rows)
    return found.join(wh.class_values.select("value_id"), "value_id", "left_anti").select("value_id", "type_code", "code", "path", "parent_id", "level", "name_ro")


_CLASS_VALUES = """SELECT CAST((SELECT max(value_id) FROM class_values) + row_number() OVER (ORDER BY sort_order) AS INTEGER) AS value_id, type_code, code || '_NOU' AS code, code || '.' || code || '_NOU' AS path, value_id AS parent_id, 3 AS level, name_ro || ' nou' AS name_ro
  FROM class_values WHERE type_code = 'PART_NAME' AND value_id > 1100"""


# metadata


def _responses(wh: Warehouse, lang: str) -> DataFrame:
    """The catalog's derived matrices as the source's JSON answers in a language, landed as text."""
    rows = wh.matrices.filter("matrix_id > 1000")
    label = F.col("label_ro" if lang == "ro" else "label_en")
    numbers = F.sequence(F.lit(1), F.col("option_count"))
    option = lambda o, first: F.struct(F.when(F.col("dimension_type") == "TEMPORAL", text("Anul ", first + o - 1)).otherwise(text("Optiunea ", o)).alias("label"), o.alias("nomItemId"), o.alias("offset"), F.when((F.col("dimension_type") == "CLASSIFICATION") & (o > 1), 1).alias("parentId"))
    dims = wh.dimensions.join(rows.select("matrix_id", "year_from"), "matrix_id")
    dims = dims.select("matrix_id", F.struct("dim_index", (100 - F.col("dim_index")).alias("dimCode"), label.alias("label"), F.transform(numbers, lambda o: option(o, F.col("year_from"))).alias("options")).alias("d"))
    dims = dims.groupBy("matrix_id").agg(F.sort_array(F.collect_list("d")).alias("dimensionsMap"), F.max("d.dim_index").alias("last"))
    if lang == "en":
        dims = dims.withColumn("dimensionsMap", F.reverse("dimensionsMap"))  # told by code, not by place
    names = F.transform("periodicity", lambda p: F.when(p == "ANNUAL", "Anuala").otherwise("Lunara"))
    details = F.struct(F.lit(2).alias("matTime"), F.when(F.col("last") == 2, 3).otherwise(0).alias("nomJud"), F.lit(0).alias("nomLoc"), F.lit(0).alias("matRegJ"), F.lit(1).alias("matSiruta"))
    body = F.struct(F.col("name_ro" if lang == "ro" else "name_en").alias("matrixName"), names.alias("periodicitati"), F.array(F.struct(text("Sursa " if lang == "ro" else "Source ", F.col("context_id")).alias("nume"))).alias("surseDeDate"), F.col("last_update").alias("ultimaActualizare"), "dimensionsMap", details.alias("details"))
    return rows.join(dims, "matrix_id").select(F.col("matrix_code").alias("code"), F.to_json(body).alias("body"))


def _metadata(wh: Warehouse) -> DataFrame:
    read = lambda lang: _responses(wh, lang).select("code", F.from_json("body", MATRIX_JSON).alias("r")).select("code", "r.*")
    dims = F.array_join(F.transform("dimensions", lambda d: F.concat_ws(":", d["dim_index"].cast("string"), d["label_ro"], F.coalesce(d["label_en"], F.lit("-")), d["dimension_type"], d["option_count"].cast("string"), d["is_hierarchical"].cast("string"))), "; ")
    sources = F.array_join(F.transform("sources", lambda x: F.concat_ws("/", x["name"], x["name_en"])), ",")
    return res.metadata(read("ro"), read("en")).select("code", "name_ro", "name_en", F.array_join("periodicity", ",").alias("periodicities"), "year_from", "year_to", "has_uat", "has_county", "has_siruta", "last_update", sources.alias("sources"), dims.alias("dimensions"))


_METADATA = """SELECT matrix_code AS code, name_ro, name_en, array_to_string(periodicity, ',') AS periodicities, year_from, year_to, false AS has_uat, has_county, true AS has_siruta, last_update, 'Sursa ' || context_id || '/Source ' || context_id AS sources,
  (SELECT string_agg(dim_index || ':' || label_ro || ':' || coalesce(label_en, '-') || ':' || dimension_type || ':' || option_count || ':' || (dimension_type = 'CLASSIFICATION' AND option_count > 1), '; ' ORDER BY dim_index) FROM dimensions d WHERE d.matrix_id = m.matrix_id) AS dimensions
  FROM matrices m WHERE matrix_id > 1000"""


# inference and normalisation


def _inferred(wh: Warehouse) -> DataFrame:
    """Dimensions whose label, or else whose options, tell their type."""
    names = wh.class_values.filter("type_code = 'PART_NAME' and value_id > 1100").join(wh.class_tree.select("value_id", F.col("parent_id").cast("string").alias("of")), "value_id")
    group = lambda rows, key, label, option: rows.groupBy(key.alias("k")).agg(F.sort_array(F.collect_set(option)).alias("options")).select(text(label, F.col("k")).alias("label"), "options")
    rows = [
        group(names, F.col("of"), "Produse ", "name_ro"),
        group(names, F.col("of"), "Altele ", "name_ro"),
        group(wh.time_periods, F.col("year").cast("string"), "Perioade ", "label_ro"),
        group(wh.time_periods.filter("periodicity = 'ANNUAL'"), F.col("year").cast("string"), "Serii ", F.col("year").cast("string")),
        group(wh.territories.filter("level = 'NUTS3'"), F.col("parent_id").cast("string"), "Localități ", "name"),
        group(wh.units, F.col("symbol"), "UM: ", "name_ro"),
        group(wh.units, F.col("symbol"), "Clase de mărime ", "name_ro"),
    ]
    found = rows[0]
    for r in rows[1:]:
        found = found.unionByName(r)
    return found.select("label", labels.infer_dimension_type(F.col("label"), F.col("options")).alias("kind"), labels.infer_class_type(F.col("label")).alias("type_code"))


_INFERRED = """SELECT DISTINCT label, kind, type_code FROM (
  SELECT 'Produse ' || parent_id AS label, 'CLASSIFICATION' AS kind, CAST(NULL AS VARCHAR) AS type_code FROM class_tree WHERE value_id > 1100 AND value_id < 2000
  UNION ALL SELECT 'Altele ' || parent_id, 'CLASSIFICATION', NULL FROM class_tree WHERE value_id > 1100 AND value_id < 2000 UNION ALL SELECT 'Perioade ' || year, 'TEMPORAL', NULL FROM time_periods UNION ALL SELECT 'Serii ' || year, 'TEMPORAL', NULL FROM time_periods
  UNION ALL SELECT 'Localități ' || parent_id, 'TERRITORIAL', NULL FROM territories WHERE level = 'NUTS3' UNION ALL SELECT 'UM: ' || symbol, 'UNIT_OF_MEASURE', NULL FROM units UNION ALL SELECT 'Clase de mărime ' || symbol, 'CLASSIFICATION', 'SIZE_CLASS' FROM units)"""


def _names(wh: Warehouse) -> DataFrame:
    tables = [wh.territories.select(F.col("name").alias("x")), wh.contexts.select("name_ro"), wh.units.select("name_ro"), wh.class_values.select("name_ro"), wh.matrices.select("name_ro"), wh.time_periods.select("label_ro"), wh.tags.select("name_en")]
    every = tables[0]
    for t in tables[1:]:
        every = every.union(t)
    return every.distinct().select(text("  Şoseaua\t", F.col("x"), " - ţară").alias("label")).select("label", expr.normalize_label(F.col("label")).alias("normalized"), expr.code_from_label(F.col("label")).alias("code"))


_NAMES = f"""SELECT label, normalized, {CODE.format("normalized")} AS code FROM (SELECT label, {PLAIN.format("coalesce(label, '')")} AS normalized FROM (SELECT DISTINCT '  Şoseaua' || chr(9) || x || ' - ţară' AS label FROM (
  SELECT name AS x FROM territories UNION ALL SELECT name_ro FROM contexts UNION ALL SELECT name_ro FROM units UNION ALL SELECT name_ro FROM class_values UNION ALL SELECT name_ro FROM matrices UNION ALL SELECT label_ro FROM time_periods UNION ALL SELECT name_en FROM tags)))"""


# value marks

_CELLS = ["value", ":", "-", "*", "<0.5", "", "abc", "1e3"]


def _marks(wh: Warehouse) -> DataFrame:
    """Facts whose cell is their value, or a mark by the number of their territory and period."""
    cell = F.get(F.array(F.col("value").cast("decimal(20,2)").cast("string"), *map(F.lit, _CELLS[1:])), (F.col("territory_id") + F.floor(F.col("time_period_id") / 100)) % 8)
    value, status = ing.parse_value(F.col("cell"))
    return wh.facts("LIN101A").select("natural_key", cell.alias("cell")).select("natural_key", "cell", value.alias("value"), status.alias("value_status"))


_MARKS = """SELECT natural_key, CASE k WHEN 0 THEN CAST(CAST(value AS DECIMAL(20,2)) AS VARCHAR) WHEN 1 THEN ':' WHEN 2 THEN '-' WHEN 3 THEN '*' WHEN 4 THEN '<0.5' WHEN 5 THEN '' WHEN 6 THEN 'abc' ELSE '1e3' END AS cell,
  CASE k WHEN 0 THEN CAST(CAST(value AS DECIMAL(20,2)) AS DOUBLE) WHEN 7 THEN 1000.0 END AS value, CASE k WHEN 1 THEN 'missing' WHEN 2 THEN 'no_data' WHEN 3 THEN 'confidential' WHEN 4 THEN 'below_threshold' END AS value_status
  FROM (SELECT *, (territory_id + time_period_id // 100) % 8 AS k FROM statistics WHERE matrix_id = 3)"""


# the planner


def _plan(wh: Warehouse) -> DataFrame:
    """The chunks of a request for all periods, territories above localities and part names; options are catalog entries."""
    taken = lambda rows, ident, label: [Option(*r) for r in rows.select(ident, label).orderBy(ident).collect()]
    dims = [
        Dimension("TEMPORAL", taken(wh.time_periods, "time_period_id", "label_ro")),
        Dimension("TERRITORIAL", taken(wh.territories.filter("level != 'LAU'"), "territory_id", "name")),
        Dimension("CLASSIFICATION", taken(wh.class_values.filter("type_code = 'PART_NAME'"), "value_id", "name_ro")),
        Dimension("UNIT_OF_MEASURE", taken(wh.units.filter("unit_id < 100"), "unit_id", "name_ro")),
    ]
    return wh.spark.createDataFrame(chunk_rows("X", dims), "chunk_no int, chunk_hash string, cells long, query string")


_PLAN = f""", axes AS (
    SELECT (SELECT list(time_period_id ORDER BY time_period_id) FROM time_periods) AS t, (SELECT list(territory_id ORDER BY territory_id) FROM territories WHERE level <> 'LAU') AS p,
           (SELECT list(value_id ORDER BY value_id) FROM class_values WHERE type_code = 'PART_NAME') AS c, (SELECT list(unit_id ORDER BY unit_id) FROM units WHERE unit_id < 100) AS u),
  sized AS (SELECT *, len(p) * len(c) * len(u) AS rest FROM axes), parted AS (SELECT *, CAST(ceil(len(t) / ({CELLS} // rest)) AS BIGINT) AS parts FROM sized),
  cuts AS (SELECT *, unnest(range(parts)) AS n, len(t) // parts AS size, len(t) % parts AS extra FROM parted),
  cut AS (SELECT n, rest, t[n * size + least(n, extra) + 1 : (n + 1) * size + least(n + 1, extra)] AS own, p, c, u FROM cuts),
  spelled AS (SELECT n, rest * len(own) AS cells, array_to_string(own, ',') || ':' || array_to_string(p, ',') || ':' || array_to_string(c, ',') || ':' || array_to_string(u, ',') AS query FROM cut)
  SELECT CAST(n AS INTEGER) AS chunk_no, substr(md5('v2|X|' || query), 1, 16) AS chunk_hash, cells, query FROM spelled"""

PAIRS = {
    "parse_time_labels": (_parsed, _TIME),
    "map_labels": (_mapped, _MAPPED),
    "resolve_units": (lambda wh: res.units(_unit_labels(wh)), _UNITS_SQL),
    "find_or_create_units": (_unit_table, _UNIT_TABLE),
    "find_territories": (_found_places, _PLACES),
    "resolve_territory_labels": (_spelled_places, _TERRITORIES),
    "find_or_create_class_values": (_class_values, _CLASS_VALUES),
    "build_metadata": (_metadata, _METADATA),
    "infer_dimension_types": (_inferred, _INFERRED),
    "normalize_labels": (_names, _NAMES),
    "parse_value_marks": (_marks, _MARKS),
    "chunk_plan": (_plan, _PLAN),
}
