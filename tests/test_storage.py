"""Landed files, warehouse on disk, upserts, streaming ingest."""

import json

import pytest
from pyspark.sql import functions as F

from cubelattice.operators import analytics, catalog, ingest, statistics, views
from cubelattice.sources import landing, sinks
from cubelattice.sources.overlay import csv_lines, cube
from cubelattice.sources.snapshots import Snapshots
from cubelattice.sources.warehouse import NotFoundError, Warehouse
from cubelattice.streaming.ingest import ingest_stream

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cube"))
    cube(spark, SF).save(path)
    return path


def collected(df):
    return sorted(map(repr, df.collect()))


def test_stored_warehouse_answers_like_the_lazy_one(spark, stored):
    lazy, kept = cube(spark, SF), Warehouse.read(spark, stored)
    assert collected(analytics.trends(lazy, "ORD101A", level="NUTS1")) == collected(analytics.trends(kept, "ORD101A", level="NUTS1"))
    kept.register_views()
    assert spark.sql("SELECT count(*) FROM statistic_classifications").first()[0] == lazy.bridge.count()


def test_matrix_scan_is_pruned_and_unknown_matrices_raise(spark, stored):
    kept = Warehouse.read(spark, stored)
    plan = statistics.series(kept, "ORD101A")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(matrix_id" in plan
    with pytest.raises(NotFoundError):
        kept.facts("NOPE")


def test_upsert_counts_and_leaves_other_matrices_alone(spark, stored, tmp_path):
    path = str(tmp_path / "facts")
    kept = Warehouse.read(spark, stored)
    kept.statistics.write.partitionBy("matrix_id").parquet(path)
    own = kept.facts("NUL101A")
    staged = own.filter("territory_id < 110").withColumns({"value": F.col("value") + 1, "response": F.lit(1), "line_no": F.lit(1)})
    fresh = own.limit(3).withColumns({"natural_key": F.concat(F.lit("n"), "natural_key"), "response": F.lit(1), "line_no": F.lit(1)})
    known, filled = own.filter("territory_id < 110").count(), own.filter("territory_id < 110 and value is not null").count()
    before = spark.read.parquet(path).count()
    done = sinks.upsert_facts(spark, path, staged.unionByName(fresh), str(tmp_path / "staging"))
    assert done == {"insert": 3, "update": filled, "unchanged": known - filled}
    assert spark.read.parquet(path).count() == before + 3
    again = sinks.upsert_facts(spark, path, staged.unionByName(fresh), str(tmp_path / "staging"))
    assert again["insert"] == again["update"] == 0


def test_lines_are_parsed_with_and_without_header(spark):
    rows = [(1, 1, 0, "Ani, Valoare"), (1, 1, 1, "  "), (1, 1, 2, " Anul 2020 , 5 "), (1, 2, 0, "Ani, Valoare"), (1, 2, 1, "")]
    lines = spark.createDataFrame(rows, "matrix_id int, response int, line_no int, line string")
    assert [r["cells"] for r in ingest.parse_lines(lines).collect()] == [["Anul 2020", "5"]]
    assert sorted(r["cells"] for r in ingest.parse_lines(lines, keep_header=True, trim=False).collect()) == [[" Anul 2020 ", "5 "], ["Ani", "Valoare"], ["Ani", "Valoare"]]


def test_stream_ingests_landed_lines(spark, stored, tmp_path):
    kept = Warehouse.read(spark, stored)
    path, landed = str(tmp_path / "facts"), str(tmp_path / "landing")
    kept.statistics.filter("matrix_id = 3").limit(0).withColumn("matrix_id", F.lit(3)).write.parquet(path)
    spark.createDataFrame([(9, "k", 1, 1, 1, 1.0, None, [1])], "matrix_id int, natural_key string, territory_id int, time_period_id int, unit_id int, value double, value_status string, class_ids array<int>").write.mode("overwrite").partitionBy("matrix_id").parquet(path)
    csv_lines(kept, "LIN101A").write.json(landed)
    options = ingest.options(kept, "LIN101A")
    for _ in range(2):  # a second run finds nothing new
        query = ingest_stream(spark, landed, path, options, 3, str(tmp_path / "staging"), str(tmp_path / "checkpoint"))
        query.awaitTermination(300)
        assert query.exception() is None
    got = spark.read.parquet(path).filter("matrix_id = 3").select("natural_key", "value")
    assert collected(got) == collected(kept.facts("LIN101A").select("natural_key", "value"))


def test_saved_queries(spark, tmp_path):
    store = sinks.SavedQueries(spark, str(tmp_path / "saved"), "query_id int, name string")
    assert store.frame().count() == 0
    store.add((1, "a"))
    store.add((2, "b"))
    assert store.delete(1) and not store.delete(1)
    assert [r["name"] for r in store.frame().collect()] == ["b"]
    counted = sinks.SavedQueries(spark, str(tmp_path / "counted"), "query_id int, execution_count int")
    counted.add((1, None))
    counted.add((2, 5))
    assert [counted.executed(1), counted.executed(1), counted.executed(2)] == [1, 2, 6]
    with pytest.raises(NotFoundError):
        counted.executed(3)


def test_unknown_entities_raise(spark):
    wh = cube(spark, SF)
    for ask in (lambda: catalog.descendants(wh, -1), lambda: catalog.by_territory(wh, -1), lambda: statistics.saved(wh, -1), lambda: catalog.matrix_detail(wh, "NOPE"), lambda: catalog.matrix_dimension(wh, "LIN101A", 9), lambda: catalog.class_value(wh, "SEGMENT", 1)):
        with pytest.raises(NotFoundError):
            ask()


def test_descendants_are_in_order_of_depth_and_name(spark):
    rows = [(r["depth"], r["name"]) for r in catalog.descendants(cube(spark, SF), 1, 3).collect()]
    assert rows == sorted(rows) and len({d for d, _ in rows}) == 4


def test_facts_are_written_in_ranges_and_ranked_in_buckets(spark, tmp_path):
    """A large matrix goes to many files, and no window sees all facts of a year."""
    schema = "matrix_id int, natural_key string, territory_id int, time_period_id int, unit_id int, value double, value_status string, class_ids array<int>"
    facts = spark.range(40_000).selectExpr("1 as matrix_id", "md5(cast(id as string)) as natural_key", "cast(id % 500 as int) as territory_id", "cast(19980000 + id % 7 as int) as time_period_id", "1 as unit_id", "cast(if(id % 3 = 0, 5, id % 1000) as double) as value", "cast(null as string) as value_status", "array(1) as class_ids")
    facts = spark.createDataFrame(facts.collect(), schema)
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k"}  # files follow sizes
    for k, v in small.items():
        spark.conf.set(k, v)
    Warehouse(spark, {"statistics": facts}).save(str(tmp_path / "w"))
    for k in small:
        spark.conf.unset(k)
    assert len(list((tmp_path / "w" / "statistics" / "matrix_id=1").glob("*.parquet"))) > 3
    rows = facts.selectExpr("natural_key", "'T' as territory_code", "if(value > 990, null, value) as value")
    for descending in (True, False):
        got = {r["natural_key"]: (r["rank"], r["percentile"], r["quartile"]) for r in analytics.ranked_rows(rows, descending).collect()}
        held = sorted(((r["value"] is None, (-1 if descending else 1) * (r["value"] or 0), r["natural_key"]) for r in rows.collect()))
        first, n = {}, len(held)
        for k, (none, value, key) in enumerate(held):
            at = first.setdefault((none, value), k)
            want = (k + 1, int(at / (n - 1) * 10_000 + 0.5) / 100, k // (n // 4) + 1)
            assert got[key] == want
    plan = analytics.ranked_rows(rows)._jdf.queryExecution().executedPlan().toString()
    numbering = [x.split("\n")[0] for x in plan.split("Window [")[1:] if "row_number()" in x.split("\n")[0] or "rank(" in x.split("\n")[0]]
    assert numbering and all("bucket#" in x and "cut#" in x for x in numbering)


def test_wide_pivots_are_refused(spark, monkeypatch):
    wh = cube(spark, SF)
    monkeypatch.setattr(analytics, "HEADERS", 3)
    with pytest.raises(ValueError, match="columns"):
        analytics.pivot(wh, "LIN101A", "time", "territory")
    assert analytics.cells(wh, "LIN101A", "time", "territory").count() > 3


def test_an_interrupted_replacement_is_completed(spark, tmp_path):
    rows = lambda *x: spark.createDataFrame(list(x), "matrix_id int, v int")
    path, staging = str(tmp_path / "t"), str(tmp_path / "s")
    rows((1, 1), (2, 2)).write.partitionBy("matrix_id").parquet(path)
    rows((1, 7)).write.partitionBy("matrix_id").parquet(f"{staging}/left")  # a finished copy, not put in place
    sinks.resume(spark, f"{staging}/left", path, "matrix_id", rows().schema)
    assert {tuple(r) for r in spark.read.parquet(path).select("matrix_id", "v").collect()} == {(1, 7), (2, 2)} and not (tmp_path / "s" / "left").exists()


def test_metadata_is_replaced_in_one_commit(spark, tmp_path):
    rows = lambda *x: spark.createDataFrame(list(x), "matrix_id int, v int")
    store = Snapshots(spark, str(tmp_path / "m"))
    for names in (("a", "b"), ("c",)):
        sinks.replace_matrix(store, spark.createDataFrame([(1, "M")], "matrix_id int, code string"), spark.createDataFrame([(1, n) for n in names], "matrix_id int, label string"), rows(*[(1, 5)] * (len(names) - 1)))
    assert [r["label"] for r in store.read("dimensions").collect()] == ["c"] and store.read("options").count() == 0
    assert sorted(r["label"] for r in store.read("dimensions", 1).collect()) == ["a", "b"] and store.read("options", 1).count() == 1


def test_seeds_and_stored_views(spark, stored, tmp_path):
    old = spark.createDataFrame([("A", "a"), ("B", "b")], "code string, name string")
    new = spark.createDataFrame([("B", "bb"), ("C", "c")], "code string, name string")
    assert {tuple(r) for r in sinks.seeded(old, new).collect()} == {("A", "a"), ("B", "bb"), ("C", "c")}
    assert {tuple(r) for r in sinks.seeded(old, new, force=True).collect()} == {("B", "bb"), ("C", "c")}
    wh = Warehouse.read(spark, stored)
    for _ in range(4):
        sinks.refresh(spark, str(tmp_path / "views"), views.stored_views(wh))
    assert len(list((tmp_path / "views" / "data" / "mv_matrix_stats").iterdir())) == sinks.KEPT  # old versions go
    for name, df in views.stored_views(wh).items():
        assert collected(sinks.stored(spark, str(tmp_path / "views"), name)) == collected(df)


def test_landed_contexts_lists_and_whole_seed(spark, tmp_path):
    body = [{"level": 0, "parentCode": "", "context": {"name": " Top ", "code": "1", "childrenUrl": "context"}}, {"level": 1, "parentCode": "1", "context": {"name": "Leaf", "code": "10", "childrenUrl": "matrix"}}]
    (tmp_path / "c.json").write_text(json.dumps(body))
    rows = landing.context_paths(landing.contexts(landing.json_files(spark, str(tmp_path / "c.json"), landing.CONTEXT_JSON)))
    assert sorted(tuple(r) for r in rows.select("code", "level", "name", "children_type", "path").collect()) == [("1", 0, "Top", "context", "1"), ("10", 1, "Leaf", "matrix", "1.10")]
    (tmp_path / "l.json").write_text(json.dumps([{"name": " A ", "code": "X1"}, {"name": "none", "code": ""}]))
    assert [tuple(r) for r in landing.matrix_list(landing.json_files(spark, str(tmp_path / "l.json"), landing.MATRIX_LIST_JSON)).collect()] == [("X1", "A")]
    static = spark.createDataFrame([("RO", "NATIONAL", None), ("AB", "NUTS3", "RO")], "code string, level string, parent_code string")
    places = spark.createDataFrame([("1017", "1017", "LAU", "AB", "1"), ("1018", "1018", "LAU", "AB", "0")], "code string, siruta_code string, level string, parent_code string, urban string")
    extra = spark.createDataFrame([("EXTRA", "EXTRA")], "code string, level string")
    known = spark.createDataFrame([(1, "RO", None), (5, "old", "1017")], "id int, code string, siruta_code string")
    got = {r["code"]: (r["id"], r["source"]) for r in landing.whole_seed(static, places, extra, known).collect()}
    assert got == {"RO": (1, "STATIC"), "1017": (5, "SIRUTA"), "1018": (6, "SIRUTA"), "AB": (7, "STATIC"), "EXTRA": (8, "SOURCE")}


def test_catalog_upsert_preserves_other_columns(spark):
    old = spark.createDataFrame([("A", "old", "SYNCED"), ("B", "same", "STALE")], "code string, name string, status string")
    new = spark.createDataFrame([("A", "new"), ("C", "fresh")], "code string, name string")
    got = {tuple(r) for r in sinks.upsert_rows(old, new, "code", ["name"]).collect()}
    assert got == {("A", "new", "SYNCED"), ("B", "same", "STALE"), ("C", "fresh", None)}
    assert [r[0] for r in sinks.missing_from(old, new, "code").collect()] == ["B"]


def test_landed_json_and_csv(spark, tmp_path):
    doc = {"matrixName": "M", "periodicitati": ["Anuala"], "dimensionsMap": [{"dimCode": 1, "label": "Ani", "options": [{"label": " Anul 2020 ", "nomItemId": 7, "offset": 1, "parentId": None}]}, {"dimCode": 2, "label": "UM", "options": []}]}
    (tmp_path / "m.json").write_text(json.dumps(doc, indent=1))
    rows = landing.matrix_options(landing.json_files(spark, str(tmp_path / "m.json"), landing.MATRIX_JSON)).collect()
    assert [(r["dim_index"], r["label"], r["nom_item_id"]) for r in rows] == [(0, "Anul 2020", 7)]
    (tmp_path / "p.csv").write_text("Ani, Valoare\nAnul 2020, 5\n\nAnul 2021, :\n")
    assert [(r["line_no"], r["line"]) for r in landing.pivot_lines(spark, str(tmp_path / "p.csv")).collect()] == [(0, "Ani, Valoare"), (1, "Anul 2020, 5"), (3, "Anul 2021, :")]
    head = "id,code,siruta_code,level,parent_code,name_ro,nuts,type,urban,source\n"
    (tmp_path / "t.csv").write_text(head + "1,RO,,NATIONAL,,România,,,,x\n2,RO1,,NUTS1,RO,Macro,,,,x\n3,RO11,,NUTS2,RO1,NV,,,,x\n4,CJ,,NUTS3,RO11,Cluj,,,,x\n5,54975,54975,LAU,CJ,Cluj-Napoca,,1,1,x\n6,SJ,,NUTS3,RO11,Sălaj,,,,x\n7,BAD,54975,LAU,ZZ,Bad,,,,x\n")
    seed = landing.territory_seed(spark, str(tmp_path / "t.csv"))
    paths = {r["code"]: (r["path"], r["parent_id"]) for r in landing.seed_paths(seed).collect()}
    assert paths["54975"] == ("RO.RO1.RO11.CJ.54975", 4) and paths["RO"] == ("RO", None)
    problems = {tuple(r) for r in landing.seed_problems(seed).collect()}
    assert problems == {("duplicate siruta_code", "54975"), ("unknown parent", "BAD"), ("county without locality", "SJ")}
    (tmp_path / "s.csv").write_text("SIRUTA;DENLOC;JUD;NIV;TIP;MED\n10;ALBA;1;1;40;0\n1017;ALBA IULIA;1;2;1;1\n")
    assert [(r["code"], r["parent_code"]) for r in landing.localities(spark, str(tmp_path / "s.csv"), {1: "AB"}).collect()] == [("1017", "AB")]
    ro = spark.createDataFrame([("A", "unu"), ("B", "doi")], "code string, name string")
    en = spark.createDataFrame([("B", "two")], "code string, name string")
    assert {tuple(r) for r in landing.bilingual(ro, en, "code", ["name"]).collect()} == {("A", "unu", None), ("B", "doi", "two")}


def test_fixture_series_trend(spark):
    """The canonical series: 19354339, 19229519, 19043098, 19055228, 19067576."""
    wh = cube(spark, SF)
    values = [19354339.0, 19229519.0, 19043098.0, 19055228.0, 19067576.0]
    facts = spark.createDataFrame([(1, f"k{n}", 1, (1995 + n) * 10_000, 1, v, None, [1]) for n, v in enumerate(values)], "matrix_id int, natural_key string, territory_id int, time_period_id int, unit_id int, value double, value_status string, class_ids array<int>")
    small = Warehouse(spark, wh._tables | {"statistics": facts})
    got = [r["yoy_percent"] for r in analytics.trends(small, "ORD101A").orderBy("year").collect()]
    assert got == [None, -0.64, -0.97, 0.06, 0.06]
