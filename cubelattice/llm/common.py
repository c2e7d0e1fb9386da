"""Helpers that the training-data operators share."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Folders of the intermediate tables that this process has written and not removed yet.
_TABLES: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    """A top-level column by its name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; a null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's spark.checkpoint.dir. A session in local mode
    that has none (a test) gets a temporary folder, which it then keeps; on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cubelattice-"))
        found = spark.sparkContext.getCheckpointDir()
    return found


def new_folder(spark: SparkSession, kind: str = "tables") -> str:
    """A path in the shared folder, to be removed with the intermediate tables."""
    _TABLES.append(f"{shared_dir(spark).rstrip('/')}/{kind}/{uuid.uuid4().hex}")
    return _TABLES[-1]


def written(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared folder, with a folder per value of ``by``. It stays until
    ``intermediate``, ``supersede`` or ``release`` removes it."""
    path = new_folder(df.sparkSession)
    df.write.partitionBy(*by).parquet(path) if by else df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, since: int = 0, keep: tuple[str, ...] = ()) -> None:
    """Remove the intermediate tables written after the first ``since``; frames that read them end with them."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    gone = [p for p in _TABLES[since:] if p not in keep]
    for path in gone:
        place = hadoop(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    _TABLES[since:] = [p for p in _TABLES[since:] if p in keep]


def supersede(spark: SparkSession) -> None:
    """Remove the table written before the last one, which takes its place."""
    release(spark, len(_TABLES) - 2, (_TABLES[-1],))


@contextmanager
def intermediate(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A scope for tables that only its inside needs. It gives a function that writes a frame to a table which
    outlives the scope; all others written inside are removed at its end."""
    since, kept = len(_TABLES), []

    def keep(df: DataFrame) -> DataFrame:
        found = written(df)
        kept.append(_TABLES[-1])
        return found

    try:
        yield keep
    finally:
        release(spark, since, tuple(kept))


def task_dir() -> str | None:
    """A folder for a task's private files: the first of Spark's local folders, else Python's default."""
    return next((d for d in os.environ.get("SPARK_LOCAL_DIRS", "").split(",") if os.path.isdir(d)), None)


#: Bits of a filter: 16 per identifier, within these bounds (128 kilobytes to 16 megabytes).
FILTER_BITS = (1 << 20, 1 << 27)


class IdFilter:
    """A bitmap of hashed identifiers, which is broadcast: its size has a bound, whatever the number of identifiers. Rows that
    it does not know are certainly without one of them, so they need not be shuffled to learn that; beyond some ten million
    identifiers it knows ever more rows, and less is spared."""

    def __init__(self, ids: DataFrame, name: str):
        """``ids`` is a stored table with a column of whole numbers."""
        many = ids.count()
        self.bits = min(max(1 << (16 * many).bit_length(), FILTER_BITS[0]), FILTER_BITS[1])
        at = self._at(quoted(name))
        # dealt by slot first, so a slot's bitmap is made once
        dealt = ids.select((at / 32_768).cast("int").alias("_slot"), (at % 32_768).alias("_bit")).repartition("_slot")
        self.table = written(dealt.groupBy("_slot").agg(F.bitmap_construct_agg("_bit").alias("_bits")))

    def _at(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key.cast("long")), F.lit(self.bits))

    def mark(self, rows: DataFrame, name: str, flag: str = "_known") -> DataFrame:
        """The rows with a flag that is false only where the identifier is none of the filter's."""
        at = self._at(quoted(name))
        bit = (at % 32_768).cast("int")
        joined = rows.withColumn("_slot", (at / 32_768).cast("int")).join(F.broadcast(self.table), "_slot", "left")  # at most 16 megabytes
        byte = F.conv(F.hex(F.substring("_bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        known = F.coalesce(F.getbit(byte, bit % 8) == 1, F.lit(False))
        return joined.withColumn(flag, known).drop("_slot", "_bits")

    def keep(self, rows: DataFrame, name: str) -> DataFrame:
        """The rows that may have one of the filter's identifiers."""
        return self.mark(rows, name).filter("_known").drop("_known")
