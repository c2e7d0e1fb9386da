"""Queries over stored facts: snapshots, upserts in one commit, refreshed aggregates, counts from footers; and labels matched
inside long texts. Each with its oracle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cubelattice.functions.expr import blind, normalize_label
from cubelattice.operators import intervals, objects, rollups
from cubelattice.operators.bitmaps import BitmapIndex, write_grouped, write_index
from cubelattice.operators.matching import match_labels, near_options
from cubelattice.plans.queries_analytics import ANNUAL
from cubelattice.plans.queries_views import PAIRS as VIEWS
from cubelattice.sources.facts import FactStore
from cubelattice.sources.scratch import new_folder, stored
from cubelattice.sources.warehouse import Warehouse


def _changes(wh: Warehouse) -> DataFrame:
    """Staged facts of two matrices: some values one larger, and some facts that are new."""
    lines = wh.facts("LIN101A").filter("territory_id % 2 = 1").withColumn("value", F.col("value") + 1)
    gaps = wh.facts("NUL101A")
    changed = gaps.filter("territory_id < 120").withColumn("value", F.when(F.col("territory_id") % 2 == 0, F.col("value") + 1).otherwise(F.col("value")))
    fresh = gaps.filter("territory_id = 110").withColumn("natural_key", F.concat(F.lit("new-"), "natural_key"))
    return reduce(DataFrame.unionByName, [lines, changed, fresh]).withColumns({"response": F.lit(1), "line_no": F.lit(1)})


#: The facts after the changes.
_AFTER = """after AS (
  SELECT natural_key, matrix_id, territory_id, time_period_id, value_status,
         CASE WHEN matrix_id = 3 AND territory_id % 2 = 1 OR matrix_id = 5 AND territory_id < 120 AND territory_id % 2 = 0 THEN value + 1 ELSE value END AS value FROM statistics
  UNION ALL SELECT 'new-' || natural_key, matrix_id, territory_id, time_period_id, value_status, value FROM statistics WHERE matrix_id = 5 AND territory_id = 110)"""


def _stored(wh: Warehouse) -> FactStore:
    store = FactStore(wh.spark, new_folder(wh.spark, "facts"))
    store.create(wh, wh.statistics)
    return store


class _BrokenOffError(RuntimeError):
    """A writer that fails on purpose."""


def upsert_snapshots(wh: Warehouse) -> DataFrame:
    """The two matrices before an upsert, after a writer that failed midway, and after the upsert, each as its version
    has it; and a version that is named after a later one has come."""
    store = _stored(wh)
    try:
        with store.snapshots.begin() as tx:
            tx.write("statistics", store.facts(matrices=[3]).withColumn("value", F.lit(-1.0)), "matrix_id")
            raise _BrokenOffError
    except _BrokenOffError:
        pass
    between = store.facts(matrices=[3, 5])  # planned now, read later: its files never change
    store.upsert(wh, _changes(wh))
    moments = {"before": store.facts(1, [3, 5]), "between": between, "after": store.facts(matrices=[3, 5])}
    return reduce(DataFrame.unionByName, [rows.select(F.lit(name).alias("moment"), "matrix_id", "natural_key", "value", "value_status") for name, rows in moments.items()])


_SNAPSHOTS = f""", {_AFTER} SELECT moment, matrix_id, natural_key, value, value_status FROM statistics, (VALUES ('before'), ('between')) AS m(moment) WHERE matrix_id IN (3, 5)
  UNION ALL SELECT 'after', matrix_id, natural_key, value, value_status FROM after WHERE matrix_id IN (3, 5)"""


def _refreshed(wh: Warehouse) -> DataFrame:
    """The states after the upsert, which makes those of two matrices anew."""
    store = _stored(wh)
    store.upsert(wh, _changes(wh))
    return store.states()


def _over_after(view: str) -> str:
    return f", {_AFTER} " + VIEWS[view][1].replace("FROM statistics", "FROM after").replace("JOIN statistics", "JOIN after")


def names_in_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents that hold a name of the catalog (parts, their nouns, types, brands, nations, regions, segments), or
    stand in one: the first such name in their order, and how many there are."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    part = read("part")
    names = [part.select(F.col("p_name").alias("label")), part.select(F.substring_index("p_name", " ", -1)), part.select("p_type"), part.select("p_brand"), read("nation").select("n_name"), read("region").select("r_name"), read("customer").select("c_mktsegment")]
    names = stored(reduce(DataFrame.union, names).distinct().select(F.lit(1).alias("dim_index"), F.col("label").alias("offset"), F.lit("NAME").alias("kind"), F.col("label").alias("member_id"), "label"))
    lines = read("documents").select(F.lit(1).alias("dim_index"), F.explode(F.split("text", "\n")).alias("cell"))
    return match_labels(near_options(lines, names), names).select(F.md5(F.col("cell").cast("binary")).alias("line_md5"), F.col("member_id").alias("name"), "ambiguous")


_PLAIN = r"trim(regexp_replace(upper(strip_accents(replace({0}, 'ß', 'SS'))), '\s+', ' ', 'g'))"
_NAMES_IN_LINES = f"""WITH names AS (SELECT label, {_PLAIN.format("label")} AS o FROM (
    SELECT p_name AS label FROM part UNION SELECT split_part(p_name, ' ', -1) FROM part UNION SELECT p_type FROM part UNION SELECT p_brand FROM part UNION SELECT n_name FROM nation UNION SELECT r_name FROM region UNION SELECT c_mktsegment FROM customer)),
  lines AS (SELECT DISTINCT unnest(string_split(text, chr(10))) AS cell FROM documents), normal AS (SELECT cell, {_PLAIN.format("cell")} AS n FROM lines),
  met AS (SELECT cell, label, n = o AS same, bool_or(n = o) OVER (PARTITION BY cell) AS any_same FROM normal JOIN names ON contains(n, o) OR contains(o, n) WHERE n <> '')
  SELECT md5(cell) AS line_md5, min(label) AS name, count(*) AS ambiguous FROM met WHERE same OR NOT any_same GROUP BY cell"""



# interval labels


def _tree_facts(wh: Warehouse, territory_id: int) -> DataFrame:
    path = new_folder(wh.spark, "tree")
    intervals.write_in_tree_order(wh, wh.statistics, path)
    return intervals.subtree(wh.spark.read.parquet(path), intervals.intervals(wh.territories), territory_id).select("matrix_id", "natural_key", "value")


_INTERVALS = """, numbered AS (SELECT territory_id, path, row_number() OVER (ORDER BY string_split(path, '.')) - 1 AS pre FROM territories)
  SELECT territory_id, pre, pre + (SELECT count(*) FROM territories t WHERE starts_with(t.path, n.path || '.')) AS last, CAST(len(string_split(path, '.')) AS INTEGER) AS depth FROM numbered n"""
_EXACT = "CAST(sum(CAST(value AS DECIMAL(38,6))) AS DOUBLE)"
_AGGREGATES = f""", {ANNUAL} SELECT p.code AS parent_code, f.level, {_EXACT} AS sum_value, round({_EXACT} / count(value), 4) AS avg_value, min(value) AS min_value, max(value) AS max_value, count(*) AS fact_count, count(DISTINCT f.territory_id) AS child_count
  FROM annual_facts f JOIN territories p ON starts_with(f.path, p.path || '.') WHERE matrix_id = 1 AND year = 1998 GROUP BY 1, 2"""


# bitmaps


def _bitmaps(wh: Warehouse, matrix_id: int) -> BitmapIndex:
    facts, index = new_folder(wh.spark, "grouped"), new_folder(wh.spark, "bitmaps")
    write_grouped(wh.statistics, facts, 500)
    write_index(wh.spark, facts, index)
    return BitmapIndex(wh.spark, facts, index, matrix_id)


# nested objects

_OBJECTS = """, dims AS (SELECT matrix_id, list({'index': dim_index, 'labels': {'ro': label_ro, 'en': label_en}, 'type': dimension_type, 'classification': type_code, 'options': option_count} ORDER BY dim_index) AS d FROM dimensions GROUP BY 1)
  SELECT matrix_code, CAST(to_json({'id': matrix_id, 'names': {'ro': m.name_ro, 'en': m.name_en}, 'context': CASE WHEN c.code IS NOT NULL THEN {'code': c.code, 'path': c.path, 'names': {'ro': c.name_ro, 'en': c.name_en}} END, 'periodicities': periodicity,
    'years': CASE WHEN year_from IS NOT NULL THEN {'from': year_from, 'to': year_to} END, 'flags': {'uat': has_uat, 'county': has_county}, 'dimensions': d,
    'updated': CAST(CAST(coalesce(try_strptime(last_update, '%d-%m-%Y'), try_strptime(last_update, '%Y-%m-%d')) AS DATE) AS VARCHAR), 'status': sync_status}) AS VARCHAR) AS body
  FROM matrices m LEFT JOIN contexts c USING (context_id) LEFT JOIN dims USING (matrix_id)"""
_OPTION_OBJECTS = """, referred AS (
    SELECT DISTINCT dim_index, name AS label, {'type': 'TERRITORY', 'id': territory_id, 'code': code, 'name': name, 'detail': level} AS reference FROM f3 JOIN territories USING (territory_id) JOIN dimensions d ON d.matrix_id = 3 AND dimension_type = 'TERRITORIAL'
    UNION ALL SELECT DISTINCT dim_index, p.label_ro, {'type': 'TIME_PERIOD', 'id': time_period_id, 'code': periodicity, 'name': p.label_ro, 'detail': CAST(year AS VARCHAR)} FROM f3 JOIN time_periods p USING (time_period_id) JOIN dimensions d ON d.matrix_id = 3 AND dimension_type = 'TEMPORAL'
    UNION ALL SELECT DISTINCT dim_index, v.name_ro, {'type': 'CLASSIFICATION', 'id': value_id, 'code': v.code, 'name': v.name_ro, 'detail': v.type_code} FROM (SELECT unnest(class_ids) AS value_id FROM f3) JOIN class_values v USING (value_id) JOIN dimensions d ON d.matrix_id = 3 AND d.type_code = v.type_code)
  SELECT dim_index, CAST(to_json({'label': label, 'reference': reference}) AS VARCHAR) AS body FROM referred"""


# searches that do not see case and marks


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text")
    return text.select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-zÀ-ÿ]+"), F.lit(0))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of documents, case and marks left out of account: how many spellings, and how often."""
    found = _words(spark, sf_dir).groupBy(blind(F.col("word")).alias("same")).agg(F.count("*").alias("spellings"), F.sum("n").alias("occurrences"), F.min("word").alias("one"))
    return found.select(normalize_label(F.col("one")).alias("word"), "spellings", "occurrences")


def blind_search(spark: SparkSession, sf_dir: str, text: str = "ÇOÏ") -> DataFrame:
    """Documents that hold a text in any spelling."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.filter(F.contains(blind(F.col("text")), blind(F.lit(text)))).select("doc_id")


_FOLD = "upper(strip_accents(replace({0}, 'ß', 'SS')))"
_SPELLINGS = f"SELECT {_FOLD.format('word')} AS word, count(DISTINCT word) AS spellings, count(*) AS occurrences FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS word FROM documents) GROUP BY 1"
_BLIND = f"SELECT doc_id FROM documents WHERE contains({_FOLD.format('text')}, 'COI')"

PAIRS = {
    "territory_intervals": (lambda wh: intervals.intervals(wh.territories), _INTERVALS),
    "facts_of_subtree": (lambda wh: _tree_facts(wh, 11), "SELECT matrix_id, natural_key, value FROM statistics JOIN territories USING (territory_id) WHERE path = 'W.M1.R1' OR starts_with(path, 'W.M1.R1.')"),
    "aggregate_every": (lambda wh: intervals.aggregates(wh, "ORD101A", 1998), _AGGREGATES),
    "bitmap_any": (lambda wh: _bitmaps(wh, 3).any_of([22, 24]).select("natural_key", "value"), "SELECT natural_key, value FROM statistics WHERE matrix_id = 3 AND list_has_any(class_ids, [22, 24])"),
    "bitmap_types": (lambda wh: _bitmaps(wh, 2).by_type([[2, 3], [11, 12]]).select("natural_key", "value"), "SELECT natural_key, value FROM statistics WHERE matrix_id = 2 AND list_has_any(class_ids, [2, 3]) AND list_has_any(class_ids, [11, 12])"),
    "bitmap_all": (lambda wh: _bitmaps(wh, 2).all_in([1, 11]).select("natural_key", "value"), "SELECT natural_key, value FROM statistics WHERE matrix_id = 2 AND len(list_filter(class_ids, lambda x: x NOT IN (1, 11))) = 0"),
    "bitmap_all_without_values": (lambda wh: _bitmaps(wh, 5).all_in([1]).select("natural_key", "value"), "SELECT natural_key, value FROM statistics WHERE matrix_id = 5"),
    "matrix_objects": (lambda wh: objects.as_json(objects.matrix_objects(wh), "matrix_code"), _OBJECTS),
    "option_objects": (lambda wh: objects.as_json(objects.option_objects(wh, "LIN101A"), "dim_index"), _OPTION_OBJECTS),
    "upsert_snapshots": (upsert_snapshots, _SNAPSHOTS),
    "refreshed_national_timeseries": (lambda wh: rollups.national(wh, _refreshed(wh)), _over_after("mv_national_timeseries")),
    "refreshed_annual_nuts2": (lambda wh: rollups.regional(wh, _refreshed(wh)), _over_after("mv_annual_nuts2")),
    "refreshed_matrix_stats": (lambda wh: rollups.matrix_stats(wh, _refreshed(wh)), _over_after("mv_matrix_stats")),
    "footer_counts": (lambda wh: _stored(wh).counts(), "SELECT matrix_id, count(*) AS fact_count, min(time_period_id) AS first_period, max(time_period_id) AS last_period FROM statistics GROUP BY 1"),
}
#: Queries over the tables themselves.
TABLES = {"names_in_lines": (names_in_lines, _NAMES_IN_LINES), "word_spellings": (spellings, _SPELLINGS), "blind_search": (blind_search, _BLIND)}
