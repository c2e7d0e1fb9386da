"""Writers: partitioned upserts of facts, seeds, metadata, catalog entries, saved queries and stored aggregates.

Parquet has no in-place update. An upsert stores the staged rows once, writes the touched partitions of the merged
table beside the old ones, reads them back, and overwrites those partitions only (dynamic mode), so no job reads
files it is replacing. Spark replaces the partitions one after the other when the job commits; a job that ends
before leaves the old ones, one that ends in between leaves some new ones. The finished copy stays until all are
replaced, and ``resume`` completes the work from it, so a second try is harmless; then it is removed.
``facts.FactStore`` upserts several matrices in one commit; a matrix's metadata, stored aggregates and saved queries are
snapshots (``snapshots``), too, whose old versions are removed."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cubelattice.operators.ingest import classify, last_wins, merged
from cubelattice.sources.scratch import remove
from cubelattice.sources.snapshots import ConflictError, Snapshots
from cubelattice.sources.warehouse import NotFoundError, by_range

#: Versions that stay, for readers that have begun.
KEPT = 2


def replace_partitions(df: DataFrame, path: str, key: str, staging: str) -> None:
    """Overwrite the partitions of ``df``; others stay."""
    copy = f"{staging.rstrip('/')}/{uuid.uuid4().hex}"
    df.write.partitionBy(key).parquet(copy)
    resume(df.sparkSession, copy, path, key, df.schema)


def resume(spark: SparkSession, copy: str, path: str, key: str, schema: StructType) -> None:
    """Put a finished copy in place of the partitions it holds, and remove it."""
    rows = spark.read.schema(schema).parquet(copy)
    by_range(rows, key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)
    remove(spark, copy)


def upsert_facts(spark: SparkSession, path: str, staged: DataFrame, staging: str) -> dict[str, int]:
    """Upsert staged facts by key; the last staged row of a key wins. Returns inserted, updated, unchanged."""
    copy = f"{staging.rstrip('/')}/{uuid.uuid4().hex}"
    rows = last_wins(staged)
    rows.write.parquet(copy)  # the source is read once, so counts and rows agree
    staged = spark.read.schema(rows.schema).parquet(copy)
    touched = [r[0] for r in staged.select("matrix_id").distinct().collect()]  # partitions of one ingest run
    target = spark.read.parquet(path).filter(F.col("matrix_id").isin(touched))
    target = target.select("matrix_id", "natural_key", "territory_id", "time_period_id", "unit_id", "value", "value_status", "class_ids")
    actions = dict(classify(target, staged).groupBy("action").count().collect())
    if actions.get("insert", 0) + actions.get("update", 0):
        replace_partitions(merged(target, staged), path, "matrix_id", staging)
    remove(spark, copy)
    return {k: actions.get(k, 0) for k in ("insert", "update", "unchanged")}


def replace_matrix(store: Snapshots, matrix: DataFrame, dimensions: DataFrame, options: DataFrame) -> int:
    """A matrix's metadata, dimensions and options take the place of what is stored of them, in one commit; all have
    matrix_id. The new version."""
    own = [r[0] for r in matrix.select("matrix_id").distinct().collect()]  # one matrix, or a few
    with store.begin() as tx:
        for name, rows in (("matrices", matrix), ("dimensions", dimensions), ("options", options)):
            tx.write(name, rows, "matrix_id", replace=own)
    return tx.version


def seeded(old: DataFrame, new: DataFrame, key: str = "code", force: bool = False) -> DataFrame:
    """The territory table after a seed: an upsert, or with ``force`` the seed alone (``missing_from`` tells what goes)."""
    return new.select(*old.columns) if force else upsert_rows(old, new, key)


def refresh(spark: SparkSession, path: str, views: dict[str, DataFrame]) -> int:
    """Store aggregates anew, all in one commit; the new version. Older ones but the last are removed."""
    store = Snapshots(spark, path)
    with store.begin() as tx:
        for name, df in views.items():
            tx.write(name, df)
    store.expire(KEPT)
    return tx.version


def stored(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The latest stored version of an aggregate."""
    return Snapshots(spark, path).read(name)


def upsert_rows(old: DataFrame, new: DataFrame, key: str, replace: list[str] | None = None) -> DataFrame:
    """A small table after an upsert by ``key``: new rows are added; of known rows the columns of ``replace``
    (all by default) take the new values, others are preserved."""
    replace = replace if replace is not None else [c for c in new.columns if c != key]
    o, n = old.alias("o"), new.alias("n")
    both = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full")
    known = F.col(f"o.{key}").isNotNull()

    def column(c: str):
        given = F.col(f"n.{c}") if c in new.columns else F.lit(None)
        if c == key:
            return F.coalesce(F.col(f"o.{c}"), given).alias(c)
        if c in replace:
            return F.when(F.col(f"n.{key}").isNull(), F.col(f"o.{c}")).otherwise(given).alias(c)
        return F.when(known, F.col(f"o.{c}")).otherwise(given).alias(c)

    return both.select(*[column(c) for c in old.columns])


def missing_from(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of the old table that the new one no longer has."""
    return old.join(new.select(key), key, "left_anti")


class SavedQueries:
    """Stored filters: a small table, of which each change is a version. Two drivers that change it at once take turns."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.schema, self.store = spark, schema, Snapshots(spark, path)

    def frame(self) -> DataFrame:
        try:
            return self.store.read("saved")
        except LookupError:
            return self.spark.createDataFrame([], self.schema)

    def _change(self, change: Callable[[DataFrame], DataFrame | None]) -> None:
        """Write what a change makes of the table; again from its new state where another driver was first. A change that
        gives nothing leaves it."""
        while True:
            try:
                with self.store.begin() as tx:
                    rows = change(self.frame())
                    if rows is not None:
                        tx.write("saved", rows.coalesce(1))
            except ConflictError:
                continue
            self.store.expire(KEPT)
            return

    def add(self, row: tuple) -> None:
        self._change(lambda now: now.unionByName(self.spark.createDataFrame([row], self.schema)))

    def executed(self, query_id: int) -> int:
        """Count one more execution; the number so far. The table has a column execution_count."""
        own = F.col("query_id") == query_id

        def counted(now: DataFrame) -> DataFrame:
            if now.filter(own).isEmpty():
                raise NotFoundError(f"no saved query {query_id}")
            return now.withColumn("execution_count", F.when(own, F.coalesce("execution_count", F.lit(0)) + 1).otherwise(F.col("execution_count")).cast(now.schema["execution_count"].dataType))

        self._change(counted)
        return self.frame().filter(own).first()["execution_count"]

    def delete(self, query_id: int) -> bool:
        gone = []

        def rest(now: DataFrame) -> DataFrame | None:
            gone.append(not now.filter(F.col("query_id") == query_id).isEmpty())
            return now.filter(F.col("query_id") != query_id) if gone[-1] else None

        self._change(rest)
        return gone[-1]
