"""Cells that no option can match are dropped where they are read, and no cell that an option matches."""

import random
import re
import sys

import pytest
from pyspark.sql import functions as F

from cubelattice.functions.expr import normalize_label
from cubelattice.operators import matching
from cubelattice.plans import registry

SMALL = "/root/testdata/sf0.01"
CELLS = "dim_index int, cell string"


def options(spark, labels):
    return spark.createDataFrame([(1, n, "K", n, label) for n, label in enumerate(labels)], "dim_index int, offset int, kind string, member_id int, label string")


def rows(found):
    return sorted(map(tuple, found.select(F.hex("cell"), "kind", "member_id", "ambiguous").collect()))


def test_only_near_lines_are_stored(spark, monkeypatch):
    seen, stored = [], matching.stored
    monkeypatch.setattr(matching, "stored", lambda df: seen.append(stored(df)) or seen[-1])
    found = registry.QUERIES["names_in_lines"](spark, SMALL)
    lines = [df for df in seen if "cell" in df.columns][0].count()
    assert 0 < found.count() <= lines < 2 * found.count()  # of ten times as many
    assert not any("gram" in df.columns for df in seen)


def test_no_matching_cell_is_dropped_whatever_its_letters(spark):
    letters = spark.range(1, sys.maxunicode + 1).filter("id < 55296 or id > 57343").select(F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    uneven = [c for c in map(chr, range(1, sys.maxunicode + 1)) if len(c.upper()) > 1] + ["ͅ", "ı", "ſ", "é", "Å", "ǆ", "ж", "ß"]
    shapes = spark.createDataFrame([(c,) for c in uneven], "c string").select(normalize_label(F.concat(F.lit("x"), "c", F.lit("y"))).alias("o")).distinct()
    opts = options(spark, [r["o"] for r in shapes.collect()])
    cells = letters.select(F.lit(1).alias("dim_index"), F.concat(F.lit("a long enough line of text with x"), "c", F.lit("Y in it")).alias("cell"))
    near = matching.near_options(cells, opts)
    found = rows(matching.match_labels(near, opts))
    assert found == rows(matching.match_labels(cells, opts)) and len(found) > len(uneven)
    assert near.count() < cells.count() / 100


def cases():
    draw = random.Random(6)
    word = lambda most: "".join(draw.choice("aAéb \t-#.(ßְ́") for _ in range(draw.randrange(most)))
    return [word(7) for _ in range(60)] + [r"a\b[c", "a|b", "two  words", ""], [word(40) for _ in range(3000)] + ["", " ", "\t", "wo \t\n      wor", r"xA\B[C", "x a|b", None, "o\x0bw"]


@pytest.mark.parametrize("one_by_one", [0, 256])
def test_near_cells_give_the_same_matches(spark, monkeypatch, one_by_one):
    labels, cells = cases()
    if one_by_one:  # without marks alone and single characters, which let all cells pass
        labels = [x for x in labels if len(re.findall(r"[aAébß#.(|\[-]", x)) > 2 or "wo" in x]
    monkeypatch.setattr(matching, "ONE_BY_ONE", one_by_one)
    opts, cells = options(spark, labels), spark.createDataFrame([(1, c) for c in cells], CELLS)
    near = matching.near_options(cells, opts)
    assert not one_by_one or near.count() < cells.count()
    found = rows(matching.match_labels(near, opts))
    monkeypatch.setattr(matching, "ONE_BY_ONE", 256 - one_by_one)
    assert found == rows(matching.match_labels(cells, opts)) and found


def test_bytes_that_are_no_text_and_sets_without_bounds(spark):
    cells = spark.sql("SELECT 1 AS dim_index, cast(x'20FF72696E67' AS string) AS cell UNION ALL SELECT 1, 'far from any option there is'")
    assert matching.near_options(cells, options(spark, ["ring"])).count() == 1
    assert matching.near_options(cells, options(spark, [])).count() == 0
    assert matching.near_options(cells, options(spark, [f"n{n}" for n in range(matching.FEW + 1)])).count() == 2
    assert matching.near_options(cells, options(spark, ["x" * 1001])).count() == 2
