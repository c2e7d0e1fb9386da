"""Query registry: name -> callable, and name -> the DuckDB SQL that must return the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cubelattice.plans import queries_analytics, queries_catalog, queries_ingest, queries_labels, queries_statistics, queries_storage, queries_views
from cubelattice.plans.cube_sql import over_cube
from cubelattice.sources.overlay import cube
from cubelattice.sources.warehouse import Warehouse

_FAMILIES = (queries_statistics, queries_analytics, queries_catalog, queries_views, queries_ingest, queries_labels, queries_storage)


def _on_cube(query: Callable[[Warehouse], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(cube(spark, sf_dir))


#: The same queries over any warehouse, for instance a stored one.
ON_WAREHOUSE: dict[str, Callable[[Warehouse], DataFrame]] = {name: query for family in _FAMILIES for name, (query, _) in family.PAIRS.items()}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: _on_cube(query) for name, query in ON_WAREHOUSE.items()}
ORACLES: dict[str, str] = {name: over_cube(sql) for family in _FAMILIES for name, (_, sql) in family.PAIRS.items() if sql}
QUERIES |= {name: query for name, (query, _) in queries_storage.TABLES.items()}
ORACLES |= {name: sql for name, (_, sql) in queries_storage.TABLES.items()}
