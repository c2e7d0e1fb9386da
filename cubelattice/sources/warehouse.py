"""The cube's star schema as lazy DataFrames, from Parquet or from any frames of the same columns.

statistics: matrix_id, natural_key, territory_id?, time_period_id, unit_id?, value?, value_status?, class_ids
territories: territory_id, code, name, level, parent_id?, path, siruta_code?
time_periods: time_period_id, year, quarter?, month?, periodicity, period_start, period_end, label_ro, label_en
The small catalog tables have the columns of ``catalog_rows``.

``class_ids`` is the fact's sorted set of classification values. The fact/value bridge of a normalised
schema is ``Warehouse.bridge``; filters read the array instead, which spares the shuffle of a semi or
anti join over the bridge (tests hold both against each other).
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cubelattice.sources.catalog_rows import STATIC
from cubelattice.sources.scratch import remove, stored

#: Small tables that are written at a time.
SIDE_BY_SIDE = 4
TABLES = ("statistics", "territories", "time_periods", *STATIC)
LEVELS = ("NATIONAL", "NUTS1", "NUTS2", "NUTS3", "LAU")


def by_range(df: DataFrame, key: str) -> DataFrame:
    """Rows in ranges of partition key, period and territory, as far as the frame has them; sorted inside."""
    order = [c for c in (key, "time_period_id", "territory_id", "natural_key") if c in df.columns]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


class NotFoundError(LookupError):
    """A matrix, territory or other entity that a query names does not exist."""


class Warehouse:
    """Tables are frames, or functions that make one at its first use."""

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame | Callable[[], DataFrame]]):
        self.spark, self._tables, self._made = spark, tables, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._tables:
            raise AttributeError(name)
        if name not in self._made:
            found = self._tables[name]
            self._made[name] = found if isinstance(found, DataFrame) else found()
        return self._made[name]

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Warehouse:
        return cls(spark, {t: lambda t=t: spark.read.parquet(f"{path}/{t}") for t in TABLES})

    def save(self, path: str) -> None:
        """Facts go into one folder per matrix, in files by ranges of matrix, period and territory: a large matrix is
        sorted by many tasks, and row groups skip by period and territory. Ranges are found over a plain copy, so facts are
        computed once. Small tables are one file each, and written side by side."""
        small = [name for name in self._tables if name != "statistics"]
        for name in small:
            getattr(self, name)
        with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
            done = [pool.submit(lambda name=name: getattr(self, name).coalesce(1).write.parquet(f"{path}/{name}")) for name in small]
            for one in done:
                one.result()
        if "statistics" in self._tables:
            self.statistics.write.parquet(f"{path}/_copy")
            copy = self.spark.read.schema(self.statistics.schema).parquet(f"{path}/_copy")
            by_range(copy, "matrix_id").write.partitionBy("matrix_id").parquet(f"{path}/statistics")
            remove(self.spark, f"{path}/_copy")

    def row_counts(self) -> DataFrame:
        """(table_name, row_count) of every table."""
        counts = [getattr(self, name).agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name in self._tables]
        return reduce(DataFrame.unionByName, counts)

    @property
    def bridge(self) -> DataFrame:
        """(matrix_id, natural_key, value_id)."""
        return self.statistics.select("matrix_id", "natural_key", F.explode("class_ids").alias("value_id"))

    def matrix_id(self, code: str) -> int:
        """One look-up in the catalog, so that the fact scan prunes to the matrix's folder."""
        row = self.matrices.filter(F.col("matrix_code") == code).select("matrix_id").first()
        if row is None:
            raise NotFoundError(f"no matrix {code}")
        return row[0]

    def path_of(self, territory_id: int) -> str:
        row = self.territories.filter(F.col("territory_id") == territory_id).select("path").first()
        if row is None:
            raise NotFoundError(f"no territory {territory_id}")
        return row[0]

    def facts(self, code: str) -> DataFrame:
        return self.statistics.filter(F.col("matrix_id") == self.matrix_id(code))

    def only(self, code: str) -> Warehouse:
        """One matrix with its dimensions, facts and their members, each computed once and stored, for queries that read
        them several times; until ``release``. Of dimensions it has what tells their members."""
        rows = stored(self.matrices.filter(F.col("matrix_code") == code).select("matrix_id", "matrix_code"))
        found = rows.first()
        if found is None:
            raise NotFoundError(f"no matrix {code}")
        own = F.col("matrix_id") == found["matrix_id"]
        dims = stored(self.dimensions.filter(own).select("matrix_id", "dim_index", "dimension_type", "type_code"))
        facts = stored(self.statistics.filter(own))
        used = lambda name, key, by: stored(getattr(self, name).join(by.select(key).distinct(), key, "left_semi"))
        members = {"territories": used("territories", "territory_id", facts), "time_periods": used("time_periods", "time_period_id", facts), "class_values": used("class_values", "type_code", dims)}
        return Warehouse(self.spark, self._tables | {"matrices": rows, "dimensions": dims, "statistics": facts} | members)

    def register_views(self) -> None:
        """Temporary views of all tables for ad-hoc SQL."""
        for name in self._tables:
            getattr(self, name).createOrReplaceTempView(name)
        self.bridge.createOrReplaceTempView("statistic_classifications")
