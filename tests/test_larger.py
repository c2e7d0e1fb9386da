"""Queries whose plans are others over larger tables."""

import re
from itertools import pairwise

import pytest

from cubelattice.operators import matching, views
from cubelattice.plans import registry
from cubelattice.sources.overlay import cube
from cubelattice.sources.warehouse import Warehouse
from tests.parity import duck, same

SMALL = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.1"


def test_facts_by_level_over_larger_tables(spark):
    name = "by_territory_level"
    assert same(registry.QUERIES[name](spark, LARGER), duck(LARGER), registry.ORACLES[name]) == 3


@pytest.mark.parametrize("name", ["ingest_errors", "ingest_last_wins", "ingest_round_trip", "match_labels"])
def test_source_tables_are_read_once(spark, monkeypatch, name):
    read, stored = [], matching.stored
    monkeypatch.setattr(matching, "stored", lambda df: read.extend(df.inputFiles()) or stored(df))
    found = registry.QUERIES[name](spark, SMALL)
    assert read and not [f for f in [*read, *found.inputFiles()] if f.endswith("lineitem.parquet")]
    assert same(found, duck(SMALL), registry.ORACLES[name]) > 0


def test_no_facts_are_dealt_by_matrix(spark):
    plan = views.mv_matrix_stats(cube(spark, SMALL))._jdf.queryExecution().executedPlan().toString().splitlines()
    dealt = [below for line, below in pairwise(plan) if re.search(r"Exchange hashpartitioning\(matrix_id#\d+, \d+\)", line)]
    assert len([below for below in dealt if "partial_sum" not in below]) == 1  # the catalog


def test_matrices_without_facts_territories_or_values(spark):
    facts = spark.createDataFrame([(1, "a", None, 7, None), (1, "b", 5, 7, 1.0), (1, "c", 5, 8, 1.0), (2, "d", None, 7, None)], "matrix_id int, natural_key string, territory_id int, time_period_id int, value double")
    periods = spark.createDataFrame([(7, 1999), (8, 2001)], "time_period_id int, year int")
    matrices = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "matrix_id int, matrix_code string")
    rows = views.mv_matrix_stats(Warehouse(spark, {"statistics": facts, "time_periods": periods, "matrices": matrices})).collect()
    assert sorted(map(tuple, rows)) == [("A", 3, 1, 2, 1999, 2001, 1), ("B", 1, 0, 1, 1999, 1999, 1), ("C", 0, 0, 0, None, None, 1)]
