"""Facts as a snapshot table that is partitioned by matrix and bucketed by key inside a matrix.

An upsert joins the staged rows, dealt into the same buckets, with the buckets of the matrices that they touch: the
stored facts are not shuffled, and each task writes its bucket back. Facts, the stored aggregates' states and a matrix's
metadata change in one commit. Partitions and counts are read from the catalog and from Parquet footers."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cubelattice.operators import rollups
from cubelattice.operators.ingest import classify, last_wins, merged
from cubelattice.sources.scratch import scope, stored
from cubelattice.sources.snapshots import WRITE, Snapshots
from cubelattice.sources.warehouse import Warehouse

COLUMNS = ["natural_key", "territory_id", "time_period_id", "unit_id", "value", "value_status", "class_ids", "matrix_id"]
FACTS, STATES = "statistics", "states"


class FactStore:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 16):
        self.spark, self.buckets = spark, buckets
        self.snapshots = Snapshots(spark, path)

    def _bucketed(self, df: DataFrame, path: str) -> None:
        """Write rows that are dealt into buckets already, a file per bucket and matrix."""
        name = f"write_{uuid.uuid4().hex}"
        df.write.partitionBy("matrix_id").bucketBy(self.buckets, "natural_key").sortBy("natural_key").format("parquet").option("path", path).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # the files stay

    def dealt(self, df: DataFrame) -> DataFrame:
        return df.select(*COLUMNS).repartition(self.buckets, "natural_key")

    def create(self, wh: Warehouse, facts: DataFrame) -> int:
        """The first version: facts and their states."""
        with self.snapshots.begin() as tx:
            tx.write(FACTS, self.dealt(facts), "matrix_id", writer=self._bucketed)
            written = self._written(tx)
            tx.write(STATES, rollups.states(wh, written), "matrix_id")
        return tx.version

    def _written(self, tx) -> DataFrame:
        """The facts that a transaction has written."""
        base = f"{self.snapshots.path}/data/{FACTS}"
        folders = [f for fs in tx.changes[FACTS]["parts"].values() for f in fs]
        return self.spark.read.schema(tx.changes[FACTS]["schema"]).option("basePath", base).parquet(*[f"{base}/{f}" for f in folders]).drop(WRITE)

    def facts(self, version: int | None = None, matrices: Iterable[int] | None = None) -> DataFrame:
        return self.snapshots.read(FACTS, version, matrices)

    def states(self, version: int | None = None) -> DataFrame:
        return self.snapshots.read(STATES, version)

    # the catalog

    def table(self, version: int | None = None, name: str | None = None) -> str:
        """A catalog table over a version's files, with a partition per matrix and the buckets; its name. Making it again
        under the same name changes nothing but its partitions."""
        known = self.snapshots.manifest(version)["tables"][FACTS]
        base = f"{self.snapshots.path}/data/{FACTS}"
        name = name or f"facts_{uuid.uuid4().hex}"
        if not self.exists(name):
            self.spark.sql(f"CREATE TABLE {name} ({known['schema']}) USING parquet PARTITIONED BY (matrix_id) CLUSTERED BY (natural_key) SORTED BY (natural_key) INTO {self.buckets} BUCKETS LOCATION '{base}'")
        for value, folders in known["parts"].items():
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (matrix_id={int(value)}) LOCATION '{base}/{folders[0]}'")
            self.spark.sql(f"ALTER TABLE {name} PARTITION (matrix_id={int(value)}) SET LOCATION '{base}/{folders[0]}'")
        for value in set(self.partitions(name)) - {int(v) for v in known["parts"]}:
            self.spark.sql(f"ALTER TABLE {name} DROP PARTITION (matrix_id={value})")
        return name

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(name)

    def partitions(self, name: str) -> list[int]:
        """The matrices that have a partition, from the catalog alone."""
        return sorted(int(r[0].split("=")[1]) for r in self.spark.sql(f"SHOW PARTITIONS {name}").collect())

    def drop(self, name: str) -> None:
        """Forget a catalog table; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def counts(self, version: int | None = None) -> DataFrame:
        """(matrix_id, fact_count, first_period, last_period) from the files' footers: no data page is read."""
        known = self.snapshots.manifest(version)["tables"][FACTS]
        session = self.spark.newSession()  # the pushed aggregation needs the newer reader, for this frame alone
        session.conf.set("spark.sql.sources.useV1SourceList", "")
        session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        base = f"{self.snapshots.path}/data/{FACTS}"
        rows = session.read.schema(known["schema"]).option("basePath", base).parquet(*[f"{base}/{f}" for fs in known["parts"].values() for f in fs])
        # footers answer for whole folders: one per write and matrix
        folders = rows.groupBy(WRITE, "matrix_id").agg(F.count("*").alias("n"), F.min("time_period_id").alias("first"), F.max("time_period_id").alias("last"))
        return folders.groupBy("matrix_id").agg(F.sum("n").alias("fact_count"), F.min("first").alias("first_period"), F.max("last").alias("last_period"))

    # changes

    def target(self, name: str, matrices: list[int]) -> DataFrame:
        return self.spark.table(name).filter(F.col("matrix_id").isin(matrices)).select(*COLUMNS)

    def merge(self, name: str, staged: DataFrame, matrices: list[int]) -> DataFrame:
        """The touched matrices after the upsert. Only the staged rows are shuffled."""
        return merged(self.target(name, matrices), self.dealt(staged), keys=["natural_key"])

    def upsert(self, wh: Warehouse, staged: DataFrame, also: dict[str, tuple[DataFrame, str | None]] | None = None) -> dict[str, int]:
        """Upsert staged facts (the last one of a key wins), their matrices' states, and ``also`` other tables (frame and
        partition column) in one commit. Returns inserted, updated, unchanged and the version."""
        with scope(self.spark):
            rows = stored(last_wins(staged))  # the source is read once, so counts and rows agree
            touched = sorted(r[0] for r in rows.select("matrix_id").distinct().collect())  # partitions of one run
            tx = self.snapshots.begin()
            name = self.table(tx.base["version"])
            try:
                actions = dict(classify(self.target(name, touched), self.dealt(rows), keys=["natural_key"]).groupBy("action").count().collect())
                with tx:
                    if actions.get("insert", 0) + actions.get("update", 0):
                        tx.write(FACTS, self.merge(name, rows, touched).select(*COLUMNS), "matrix_id", writer=self._bucketed)
                        tx.write(STATES, rollups.states(wh, self._written(tx)), "matrix_id", replace=touched)
                    for other, (df, by) in (also or {}).items():
                        tx.write(other, df, by)
            finally:
                self.drop(name)
        return {k: actions.get(k, 0) for k in ("insert", "update", "unchanged")} | {"version": tx.version or tx.base["version"]}
