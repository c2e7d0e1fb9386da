"""Bitmap index, interval labels, nested objects, searches blind to case and marks."""

import json

import pytest
from pyspark.sql import functions as F

from cubelattice.functions.expr import blind, normalize_label
from cubelattice.operators import bitmaps, filters, intervals, objects
from cubelattice.sources.overlay import cube
from cubelattice.sources.warehouse import NotFoundError, Warehouse

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cube"))
    cube(spark, SF).save(path)
    return Warehouse.read(spark, path)


def keys(df):
    return sorted(r["natural_key"] for r in df.select("natural_key").collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def indexed(spark, kept, tmp_path_factory):
    folder = tmp_path_factory.mktemp("bitmaps")
    bitmaps.write_grouped(kept.statistics, f"{folder}/facts", 100)
    bitmaps.write_index(spark, f"{folder}/facts", f"{folder}/index")
    return folder


@pytest.mark.parametrize(("matrix", "code"), [(1, "ORD101A"), (2, "ORD102A"), (3, "LIN101A"), (5, "NUL101A")])
def test_bitmaps_select_what_arrays_and_bridge_select(spark, kept, indexed, matrix, code):
    index = bitmaps.BitmapIndex(spark, f"{indexed}/facts", f"{indexed}/index", matrix)
    facts = kept.facts(code)
    for ids in ([1], [2, 3], [11, 22], [24], [999]):
        assert keys(index.any_of(ids)) == keys(filters.any_class(facts, ids)) == keys(filters.bridge_any_class(kept, facts, ids))
        assert keys(index.all_in(ids)) == keys(filters.bridge_all_classes_in(kept, facts, ids))
    assert keys(index.by_type([[1, 2], [11, 13]])) == keys(filters.any_class(filters.any_class(facts, [1, 2]), [11, 13]))


def test_groups_without_a_hit_are_skipped(spark, kept, indexed, tmp_path):
    rare = kept.facts("ORD101A").withColumn("class_ids", F.when(F.col("natural_key").startswith("00"), F.array(F.lit(77))).otherwise(F.col("class_ids")))
    bitmaps.write_grouped(rare.withColumn("matrix_id", F.lit(1)), str(tmp_path / "f"), 20)
    bitmaps.write_index(spark, str(tmp_path / "f"), str(tmp_path / "i"))
    found = bitmaps.BitmapIndex(spark, str(tmp_path / "f"), str(tmp_path / "i"), 1).any_of([77])
    groups = spark.read.parquet(str(tmp_path / "f")).select("grp").distinct().count()
    scan = next(line for line in plan(found).splitlines() if "PushedFilters" in line and "grp" in line and "bit" in line)
    assert "In(grp, [" in scan or "EqualTo(grp," in scan
    assert 0 < found.count() < groups


def test_bits_of_all_places(spark):
    bits = spark.range(0, 32_768, 7).agg(F.bitmap_construct_agg("id").alias("bits"))
    got = spark.range(32_768).crossJoin(bits).filter(bitmaps.is_set(F.col("bits"), F.col("id"))).count()
    assert got == len(range(0, 32_768, 7)) and spark.range(1).filter(bitmaps.is_set(F.lit(None).cast("binary"), F.col("id"))).count() == 0


def test_subtrees_are_ranges(spark, kept, tmp_path):
    tree = intervals.intervals(kept.territories)
    rows = {r["territory_id"]: r for r in tree.collect()}
    paths = {r["territory_id"]: r["path"] for r in kept.territories.collect()}
    assert sorted(r["pre"] for r in rows.values()) == list(range(len(paths)))
    for a in (1, 3, 11, 101, 100_042):
        below = {t for t, p in paths.items() if p == paths[a] or p.startswith(paths[a] + ".")}
        assert {t for t, r in rows.items() if rows[a]["pre"] <= r["pre"] <= rows[a]["last"]} == below
        assert {t for t, r in rows.items() if r["pre"] <= rows[a]["pre"] <= r["last"]} == {t for t, p in paths.items() if paths[a] == p or paths[a].startswith(p + ".")}
    path = str(tmp_path / "tree")
    intervals.write_in_tree_order(kept, kept.statistics, path)
    stored = spark.read.parquet(path)
    found = intervals.subtree(stored, tree, 101)
    pushed = plan(found)
    assert f"GreaterThanOrEqual(pre,{rows[101]['pre']})" in pushed and f"LessThanOrEqual(pre,{rows[101]['last']})" in pushed
    below = {t for t, p in paths.items() if p == paths[101] or p.startswith(paths[101] + ".")}
    assert keys(found) == keys(kept.statistics.filter(F.col("territory_id").isin(list(below))))
    with pytest.raises(NotFoundError):
        intervals.subtree(stored, tree, -1)


def test_several_roots(spark):
    rows = [(1, None, "A"), (2, None, "B"), (3, 1, "A.x"), (4, 3, "A.x.y"), (5, 2, "B.z")]
    got = {r["territory_id"]: (r["pre"], r["last"]) for r in intervals.intervals(spark.createDataFrame(rows, "territory_id int, parent_id int, path string")).collect()}
    assert got == {1: (0, 2), 3: (1, 2), 4: (2, 2), 2: (3, 4), 5: (4, 4)}


def test_objects_are_nested(kept):
    body = {r["matrix_code"]: json.loads(r["body"]) for r in objects.as_json(objects.matrix_objects(kept), "matrix_code").collect()}
    assert [d["type"] for d in body["ORD101A"]["dimensions"]] == ["CLASSIFICATION", "TERRITORIAL", "TEMPORAL", "UNIT_OF_MEASURE"]
    assert body["EMP101A"]["years"] is None and body["ORD101A"]["context"]["names"]["en"] == "Orders"
    kinds = {r["reference"]["type"] for r in objects.option_objects(kept, "ORD101A").collect()}
    assert kinds == {"TERRITORY", "TIME_PERIOD", "CLASSIFICATION", "UNIT"}


def test_case_and_marks_are_not_seen(spark):
    words = spark.createDataFrame([("Élan",), ("elan",), ("ÈLÂN",), ("elań",), ("plan",)], "w string")
    assert words.groupBy(blind(F.col("w"))).count().count() == 2
    assert words.filter(F.contains(blind(F.col("w")), blind(F.lit("LÄN")))).count() == 5


def test_labels_lose_all_marks(spark):
    import unicodedata

    letters = [c for c in map(chr, range(0xC0, 0x2000)) if c.isalpha() and len(c.upper()) == 1 and len("".join(x for x in unicodedata.normalize("NFD", c) if not 0x300 <= ord(x) <= 0x36F)) == 1]
    rows = spark.createDataFrame([(c,) for c in [*letters, "é Å"]], "c string").select("c", F.upper("c").alias("up"), normalize_label(F.col("c")).alias("n")).collect()
    for r in rows:
        assert r["n"] == "".join(x for x in unicodedata.normalize("NFD", r["up"]) if not 0x300 <= ord(x) <= 0x36F), r
