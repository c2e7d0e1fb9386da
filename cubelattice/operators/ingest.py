"""From labelled CSV responses to facts: parse, match labels, key, deduplicate, classify the upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cubelattice.functions.expr import natural_key
from cubelattice.operators.matching import match_labels
from cubelattice.sources.warehouse import Warehouse


def parse_lines(lines: DataFrame, keep_header: bool = False, trim: bool = True) -> DataFrame:
    """(matrix_id, response, line_no, line) -> the same with cells instead of the line; blank lines go, and
    the first line of each response unless the header is kept."""
    rows = lines.filter(F.trim("line") != "")
    if not keep_header:
        rows = rows.filter("line_no > 0")
    cells = F.split("line", ", ")
    return rows.select("matrix_id", "response", "line_no", (F.transform(cells, lambda c: F.trim(c)) if trim else cells).alias("cells"))


def parse_value(cell: Column) -> tuple[Column, Column]:
    """(value, status): ``:`` missing, ``-`` no data, ``*`` confidential, ``<x`` below the threshold."""
    value = F.try_to_number(cell, F.lit("S99999999999999999999.999999")).cast("double")
    value = F.coalesce(cell.try_cast("double"), value)
    status = F.when(cell == ":", "missing").when(cell == "-", "no_data").when(cell == "*", "confidential").when(cell.startswith("<"), "below_threshold")
    return F.when(status.isNull(), value), status


def options(wh: Warehouse, code: str) -> DataFrame:
    """(dim_index, offset, label, kind, member_id): what each dimension's labels stand for."""
    own = wh.facts(code)
    used = lambda key: own.select(key).distinct()
    kinds = {
        "TERRITORIAL": used("territory_id").join(wh.territories, "territory_id").select(F.col("name").alias("label"), F.col("territory_id").alias("member_id"), F.lit(None).cast("string").alias("t")),
        "TEMPORAL": used("time_period_id").join(wh.time_periods, "time_period_id").select(F.col("label_ro").alias("label"), F.col("time_period_id").alias("member_id"), F.lit(None).cast("string").alias("t")),
        "CLASSIFICATION": wh.class_values.select(F.col("name_ro").alias("label"), F.col("value_id").alias("member_id"), F.col("type_code").alias("t")),
    }
    dims = wh.dimensions.join(wh.matrices.filter(F.col("matrix_code") == code).select("matrix_id"), "matrix_id").select("dim_index", "dimension_type", "type_code")
    found = None
    for kind, members in kinds.items():
        part = dims.filter(F.col("dimension_type") == kind).join(members, F.col("type_code").eqNullSafe(F.col("t"))).select("dim_index", F.lit(kind).alias("kind"), "label", "member_id")
        found = part if found is None else found.unionByName(part)
    place = F.row_number().over(Window.partitionBy("dim_index").orderBy("member_id")) - 1
    return found.withColumn("offset", place)


def resolve(parsed: DataFrame, opts: DataFrame, unit_id: int) -> DataFrame:
    """Parsed rows -> staged facts with response, line_no and error (null where the row is good)."""
    labels = parsed.select("matrix_id", "response", "line_no", F.element_at("cells", -1).alias("last"), F.posexplode(F.slice("cells", F.lit(1), F.size("cells") - 1)).alias("dim_index", "cell"))
    matched = labels.join(match_labels(labels, opts), ["dim_index", "cell"], "left")
    one = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("member_id")))
    rows = matched.groupBy("matrix_id", "response", "line_no").agg(
        F.first("last").alias("last"),
        one("TERRITORIAL").alias("territory_id"),
        one("TEMPORAL").alias("time_period_id"),
        F.sort_array(F.collect_set(F.when(F.col("kind") == "CLASSIFICATION", F.col("member_id")))).alias("class_ids"),
        F.count_if(F.col("kind").isNull()).alias("unmatched"),
    )
    value, status = parse_value(F.col("last"))
    unit = F.lit(unit_id)
    return rows.select(
        "matrix_id", natural_key(F.col("matrix_id"), F.col("territory_id"), F.col("time_period_id"), unit, F.col("class_ids")).alias("natural_key"), "territory_id", "time_period_id", unit.alias("unit_id"),
        value.alias("value"), status.alias("value_status"), "class_ids", "response", "line_no",
        F.when(F.col("time_period_id").isNull(), "no time period").when(F.col("unmatched") > 0, "unmatched label").alias("error"),
    )


def last_wins(staged: DataFrame) -> DataFrame:
    """One row per key, the last by response and line; rows without a time period stay out."""
    columns = ["territory_id", "time_period_id", "unit_id", "value", "value_status", "class_ids"]
    good = staged.filter("time_period_id is not null")
    picked = good.groupBy("matrix_id", "natural_key").agg(F.max_by(F.struct(*columns), F.struct("response", "line_no")).alias("r"))
    return picked.select("matrix_id", "natural_key", *[f"r.{c}" for c in columns])


KEYS = ["matrix_id", "natural_key"]


def classify(target: DataFrame, staged: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Keyed rows of both with ``action``: insert, update (value or status differ), unchanged, keep (not staged). The
    natural key alone suffices where it is made of the matrix, too."""
    t = target.select(*keys, F.col("value").alias("old_value"), F.col("value_status").alias("old_status"), F.lit(True).alias("in_target"))
    s = staged.select(*keys, "value", "value_status", F.lit(True).alias("in_stage"))
    same = F.col("value").eqNullSafe(F.col("old_value")) & F.col("value_status").eqNullSafe(F.col("old_status"))
    action = F.when(F.col("in_target").isNull(), "insert").when(F.col("in_stage").isNull(), "keep").when(same, "unchanged").otherwise("update")
    return t.join(s, keys, "full").select(*keys, action.alias("action"), "old_value", "value")


def merged(target: DataFrame, staged: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """The target after the upsert: staged values and statuses win, new rows are added."""
    columns = [c for c in ("matrix_id", "territory_id", "time_period_id", "unit_id", "value", "value_status", "class_ids") if c not in keys]
    t = target.select(*keys, F.struct(*columns).alias("t"))
    s = staged.select(*keys, F.struct(*columns).alias("s"))
    both = t.join(s, keys, "full")
    row = F.when(F.col("s").isNull(), F.col("t")).when(F.col("t").isNull(), F.col("s")).otherwise(F.col("t").withField("value", F.col("s.value")).withField("value_status", F.col("s.value_status")))
    return both.select(*keys, row.alias("r")).select("matrix_id" if "matrix_id" in keys else "r.matrix_id", "natural_key", *[f"r.{c}" for c in columns if c != "matrix_id"])
