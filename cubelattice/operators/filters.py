"""Predicates over facts and dimensions."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubelattice.functions.expr import is_descendant, path_depth
from cubelattice.sources.warehouse import Warehouse

TOTAL = "TOTAL"
WILDCARD = "*"


def years(df: DataFrame, low: int | None = None, high: int | None = None) -> DataFrame:
    if low is not None:
        df = df.filter(F.col("year") >= low)
    return df if high is None else df.filter(F.col("year") <= high)


def text_prefix(path: Column, prefix: str) -> Column:
    """Textual prefix: ``W.M1`` also takes ``W.M10``."""
    return path.startswith(prefix)


def contains(column: Column, text: str) -> Column:
    """Case-insensitive substring; % and _ stand for themselves."""
    return F.lower(column).contains(text.lower())


def searched(ro: Column, en: Column, text: str, locale: str = "ro") -> Column:
    """Substring of the name in the asked language; English falls back on a null."""
    return contains(F.coalesce(en, ro) if locale == "en" else ro, text)


def any_class(df: DataFrame, value_ids: Iterable[int]) -> DataFrame:
    """Facts linked to at least one of the values."""
    return df.filter(F.arrays_overlap("class_ids", F.array(*[F.lit(int(v)) for v in value_ids])))


def value_ids(wh: Warehouse, codes: list[str], type_code: str | None = None) -> list[int]:
    """Ids of codes, over all types or one; the vocabulary is a small catalog table."""
    rows = wh.class_values.filter(F.col("code").isin(codes))
    if type_code is not None:
        rows = rows.filter(F.col("type_code") == type_code)
    return sorted(r[0] for r in rows.select("value_id").collect())


def all_classes_in(wh: Warehouse, df: DataFrame, codes: list[str]) -> DataFrame:
    """Facts all of whose values have one of the codes; facts without values pass; no filter if no code is known."""
    if WILDCARD in codes:
        return df
    ids = value_ids(wh, codes)
    if not ids:
        return df
    return df.filter(F.size(F.array_except("class_ids", F.array(*map(F.lit, ids)))) == 0)


def classes_by_type(wh: Warehouse, df: DataFrame, wanted: dict[str, list[str]]) -> DataFrame:
    """Facts with one of the codes of each type; a type without a known code is ignored."""
    for type_code, codes in wanted.items():
        ids = [] if WILDCARD in codes else value_ids(wh, codes, type_code)
        if ids:
            df = any_class(df, ids)
    return df


def class_filter(wh: Warehouse, df: DataFrame, filters: str | dict | None = None, include_all: bool = False) -> DataFrame:
    """Explicit types, else the default: every linked value is a TOTAL. Invalid JSON counts as no filter."""
    if isinstance(filters, str):
        try:
            filters = json.loads(filters)
        except ValueError:
            filters = None
    if isinstance(filters, dict) and filters:
        return classes_by_type(wh, df, {k: [v] if isinstance(v, str) else list(v) for k, v in filters.items()})
    return df if include_all else all_classes_in(wh, df, [TOTAL])


def bridge_all_classes_in(wh: Warehouse, df: DataFrame, ids: list[int]) -> DataFrame:
    """``all_classes_in`` in the form of an anti join over the bridge; for tables without class_ids."""
    return df.join(wh.bridge.filter(~F.col("value_id").isin(ids)), ["matrix_id", "natural_key"], "left_anti")


def bridge_any_class(wh: Warehouse, df: DataFrame, ids: list[int]) -> DataFrame:
    return df.join(wh.bridge.filter(F.col("value_id").isin(ids)), ["matrix_id", "natural_key"], "left_semi")


def descendants(territories: DataFrame, root: str, max_depth: int | None = None) -> DataFrame:
    """The territory and all below it, at most ``max_depth`` levels down."""
    found = territories.filter(is_descendant(F.col("path"), root))
    return found if max_depth is None else found.filter(path_depth(F.col("path")) <= len(root.split(".")) + max_depth)


def after(columns: list[tuple[Column, object, bool]]) -> Column:
    """Keyset predicate: rows after the given values of the sort columns (column, value, ascending)."""
    found, equal = F.lit(False), F.lit(True)
    for column, value, ascending in columns:
        found = found | equal & (column > value if ascending else column < value)
        equal = equal & (column == value)
    return found
