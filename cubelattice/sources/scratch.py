"""Tables of one run in the folder that driver and executors share: the session's spark.checkpoint.dir."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_FOLDERS: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir. A session in local mode that has none gets a temporary folder, which it then
    keeps; on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cubelattice-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def new_folder(spark: SparkSession, kind: str = "scratch") -> str:
    """A path that nothing has yet, to be removed by ``release``."""
    _FOLDERS.append(f"{shared_folder(spark)}/{kind}/{uuid.uuid4().hex}")
    return _FOLDERS[-1]


def stored(df: DataFrame) -> DataFrame:
    """The frame as a table of its own, so that it is computed once and its size is known; until ``release``."""
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def release(spark: SparkSession, since: int = 0, keep: tuple[str, ...] = ()) -> None:
    """Remove what was written after the first ``since`` folders, but for ``keep``."""
    for path in [p for p in _FOLDERS[since:] if p not in keep]:
        remove(spark, path)
        _FOLDERS.remove(path)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside are removed at its end."""
    since = len(_FOLDERS)
    try:
        yield
    finally:
        release(spark, since)
