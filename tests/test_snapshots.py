"""Snapshots, bucketed facts, refreshed aggregates, selection of ranks, the q-gram index."""

import random

import pytest
from pyspark.sql import functions as F

from cubelattice.operators import matching, rollups, selection, views
from cubelattice.plans.queries_storage import _changes
from cubelattice.sources import scratch
from cubelattice.sources.facts import FactStore
from cubelattice.sources.overlay import cube
from cubelattice.sources.snapshots import ConflictError, Snapshots
from cubelattice.sources.warehouse import Warehouse

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cube"))
    cube(spark, SF).save(path)
    return Warehouse.read(spark, path)


def rows(df):
    return sorted(map(repr, df.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def table(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k int, v string")


# snapshots


def test_tables_change_at_once_and_old_versions_stay(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    assert store.versions() == [] and store.manifest() == {"version": 0, "tables": {}}
    with store.begin() as tx:
        tx.write("a", table(spark, (1, "x"), (2, "y")), "k")
        tx.write("b", table(spark, (9, "whole")))
    with store.begin() as tx:
        tx.write("a", table(spark, (2, "z")), "k", replace=[1])
        tx.write("b", table(spark, (8, "other")))
    assert store.versions() == [1, 2]
    assert rows(store.read("a").select("k", "v")) == ["Row(k=2, v='z')"] and rows(store.read("b")) == ["Row(k=8, v='other')"]
    assert len(rows(store.read("a", 1))) == 2 and rows(store.read("b", 1)) == ["Row(k=9, v='whole')"]
    with store.begin() as tx:
        tx.write("a", table(spark, (2, "more")), "k", append=True)
    assert sorted(r["v"] for r in store.read("a").collect()) == ["more", "z"] and store.read("a", values=[7]).count() == 0
    with pytest.raises(LookupError):
        store.read("c")
    with pytest.raises(LookupError):
        store.read("a", 9)


def test_a_failed_writer_changes_nothing_and_leaves_nothing(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    with store.begin() as tx:
        tx.write("a", table(spark, (1, "x")), "k")
    with pytest.raises(ZeroDivisionError), store.begin() as tx:
        tx.write("a", table(spark, (1, "lost")), "k")
        raise ZeroDivisionError
    assert store.versions() == [1] and rows(store.read("a").select("v")) == ["Row(v='x')"]
    assert len(list((tmp_path / "data" / "a").iterdir())) == 1
    gone = store.begin()  # a driver that dies here
    gone.write("a", table(spark, (1, "orphan")), "k")
    assert store.expire(grace=3600) == 0
    assert store.expire() == 1 and rows(store.read("a").select("v")) == ["Row(v='x')"]


def test_two_writers(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    with store.begin() as tx:
        tx.write("a", table(spark, (1, "x"), (2, "y")), "k")
    first, second, third = store.begin(), store.begin(), store.begin()
    first.write("a", table(spark, (1, "first")), "k")
    second.write("a", table(spark, (2, "second")), "k")
    third.write("a", table(spark, (1, "third")), "k")
    assert (first.commit(), second.commit()) == (2, 3)  # other partitions: both are in
    with pytest.raises(ConflictError):
        third.commit()
    assert sorted(r["v"] for r in store.read("a").collect()) == ["first", "second"]


def test_a_version_is_never_renamed_over(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    with store.begin() as tx:
        tx.write("a", table(spark, (1, "x")), "k")
    (tmp_path / "log" / "new").write_text("{}")
    assert not store._rename(store._place("log", "new"), store._place("log", f"{1:020d}.json")) and "tables" in store.manifest()


def test_expired_versions_and_their_files_go(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    for n in range(4):
        with store.begin() as tx:
            tx.write("a", table(spark, (1, f"one {n}"), *([(2, "two")] if n == 0 else [])), "k")
    assert store.expire(keep=2) == 2 and store.versions() == [3, 4]  # the first two of partition 1
    assert sorted(r["v"] for r in store.read("a").collect()) == ["one 3", "two"] and sorted(r["v"] for r in store.read("a", 3).collect()) == ["one 2", "two"]
    with pytest.raises(LookupError):
        store.read("a", 1)


# facts


@pytest.fixture(scope="module")
def changed(spark, kept, tmp_path_factory):
    store = FactStore(spark, str(tmp_path_factory.mktemp("facts")), buckets=4)
    store.create(kept, kept.statistics)
    done = store.upsert(kept, _changes(kept), {"notes": (table(spark, (1, "with the facts")), None)})
    return store, done


def test_an_upsert_is_one_commit(spark, kept, changed):
    store, done = changed
    assert done["version"] == 2 and done["insert"] > 0 and done["update"] > 0 and done["unchanged"] > 0
    assert store.snapshots.read("notes").first()["v"] == "with the facts"
    with pytest.raises(LookupError):
        store.snapshots.read("notes", 1)
    columns = ["matrix_id", "natural_key", "value", "class_ids"]
    assert rows(store.facts(1).select(*columns)) == rows(kept.statistics.select(*columns))
    assert rows(store.facts(2, [1, 2, 4]).select(*columns)) == rows(kept.statistics.filter("matrix_id in (1, 2, 4)").select(*columns))
    again = store.upsert(kept, _changes(kept))
    assert again["insert"] == again["update"] == 0 and again["version"] == 2


def test_an_upsert_shuffles_the_staged_rows_alone(spark, kept, changed):
    store, _ = changed
    name = store.table()
    staged = _changes(kept).drop("response", "line_no")
    found = plan(store.merge(name, staged, [3, 5]))
    target, stage = found.split("SortMergeJoin")[1].split("\n", 1)[1], found
    assert stage.count("Exchange hashpartitioning(natural_key") == 1 and "Bucketed: true" in target and "REPARTITION_BY_NUM" in stage
    assert "SelectedBucketsCount: 4 out of 4" in stage
    store.drop(name)


def test_refreshed_aggregates_equal_a_rebuild_and_read_what_changed(spark, kept, changed):
    store, _ = changed
    facts = store.facts(2)
    now = Warehouse(spark, kept._tables | {"statistics": facts})
    for fresh, rebuilt in ((rollups.national, views.mv_national), (rollups.regional, views.mv_nuts2), (rollups.matrix_stats, views.mv_matrix_stats)):
        assert rows(fresh(kept, store.states(2))) == rows(rebuilt(now).select(*fresh(kept, store.states(2)).columns))
    before, after = (store.snapshots.manifest(v)["tables"]["states"]["parts"] for v in (1, 2))
    assert {m for m in after if before[m] != after[m]} == {"3", "5"}


def test_partitions_and_counts_come_from_metadata(spark, kept, changed):
    store, _ = changed
    name = store.table(1, "facts_by_name")
    assert store.table(2, "facts_by_name") == name and store.exists(name) and not store.exists("facts_of_nobody")
    assert store.partitions(name) == [1, 2, 3, 4, 5] and spark.table(name).count() == store.facts(2).count()
    store.drop(name)
    counts = store.counts(1)
    pushed = plan(counts)
    assert "PushedAggregation: [COUNT(*), MIN(time_period_id), MAX(time_period_id)]" in pushed and "PushedGroupBy: [snapshot_write, matrix_id]" in pushed
    assert {r["matrix_id"]: r["fact_count"] for r in counts.collect()} == {r["matrix_id"]: r["count"] for r in kept.statistics.groupBy("matrix_id").count().collect()}


def test_scratch_tables_go_with_their_scope(spark):
    with scratch.scope(spark):
        df = scratch.stored(spark.range(5))
        path = df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert df.count() == 5
    import os

    assert not os.path.exists(path)


# selection


@pytest.mark.parametrize(("small", "cuts"), [(3, 4), (20, 8), (4096, 64)])
def test_quantiles_of_many_groups(spark, small, cuts):
    draw = random.Random(small)
    groups = {"normal": [draw.gauss(0, 100) for _ in range(250)], "equal": [5.0] * 90, "few": [1.0, 2.0], "one": [7.25], "ties": [float(draw.randrange(6)) for _ in range(120)], None: [draw.random() for _ in range(90)]}
    data = [(k, 1, v) for k, vs in groups.items() for v in vs] + [("normal", 1, None), ("nulls", 1, None)]
    shares = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    df = spark.createDataFrame(data, "a string, b int, value double").repartition(5)
    got = {r["a"]: r["p"] for r in selection.quantiles(scratch.stored(df), ["a", "b"], shares, small, cuts).collect()}
    want = {r["a"]: r["p"] for r in df.filter("value is not null").groupBy("a").agg(F.percentile("value", F.array(*map(F.lit, shares))).alias("p")).collect()}
    assert set(got) == set(want) == set(groups)
    assert all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)


def test_no_window_or_buffer_holds_a_group(spark):
    df = spark.range(60_000).selectExpr("1 as a", "cast(hash(id) as double) as value")
    groups = scratch.stored(df.selectExpr("struct(a) as g", "0L as part", "value"))
    wanted = spark.createDataFrame([(30_000,)], "goal long").selectExpr("struct(1 as a) as g", "0L as part", "goal as rank", "goal")
    found = selection.ranked_values(groups, wanted, selection._sizes(groups, selection.CUTS), small=2000)
    assert found.first()["value"] == sorted(r["value"] for r in df.collect())[30_000]
    assert "ObjectHashAggregate(keys=[], functions=[percentile" not in plan(found)


# the q-gram index


@pytest.mark.parametrize("q", [1, 2, 3])
def test_contained_texts(spark, q):
    draw = random.Random(q)
    word = lambda most: "".join(draw.choice("abc ") for _ in range(draw.randrange(most)))
    needles, hays = [(draw.randrange(2), n, word(6)) for n in range(120)], [(draw.randrange(2), n, word(25)) for n in range(120)]
    frame = lambda data, name: scratch.stored(spark.createDataFrame(data, f"dim int, {name} long, text string"))
    got = {tuple(r) for r in matching.contained(frame(needles, "needle"), frame(hays, "hay"), q).collect()}
    assert got == {(a, b) for d, a, s in needles for e, b, t in hays if d == e and s and s in t} and got
    assert matching.contained(frame([], "needle"), frame(hays, "hay"), q).count() == 0


def test_labels_meet_no_option_without_their_rarest_gram(spark):
    """10,000 labels and 2,000 options: far fewer pairs are looked at than the 20 million there are."""
    opts = spark.range(2000).selectExpr("1 as dim_index", "cast(id as int) as offset", "'K' as kind", "cast(id as int) as member_id", "concat('name', id, 'x') as label")
    cells = spark.range(10_000).selectExpr("1 as dim_index", "concat('the name', id, 'x of ', id) as cell")
    found = matching.match_labels(cells, opts)
    assert found.count() == 2000 and found.filter("ambiguous > 1").count() == 0
    asked = scratch.stored(spark.range(10_000).selectExpr("1 as dim", "id as hay", "concat('the name', id, 'x of ', id) as text"))
    posted = scratch.stored(spark.range(2000).selectExpr("1 as dim", "id as needle", "concat('name', id, 'x') as text"))
    text = matching.contained(posted, asked)._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in text and "contains(" in text.lower()
