"""Sharding by jump consistent hashing.

A row's shard depends on its key and the number of shards alone; with one more shard a row stays or
moves into the new one. No ring table exists: the jumps are computed from the key by a linear
congruential generator, for a whole Arrow batch at once.

Slots number each shard's rows from 0 in order of the key (then size, then checksum). Rows are range
partitioned by key (then size, then checksum, then the row's number, so rows that repeat a key and text or have
none can still be split); each task counts its own rows per shard in one pass, and the counts of earlier partitions are added.

A null text has no bytes; a null key takes the jumps of the constant -1 and sorts first. Rows that
repeat a key go to one shard and get a slot each. Texts, however long, are only measured: sizes and
checksums are shuffled. An empty table gives an empty result; other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cubelattice.llm.common import table, written

LCG = 2862933555777941757  # fixed multiplier of the published algorithm
SHARDS = 8


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = keys.astype(np.int64).view(np.uint64).copy()
    at, to = np.zeros(len(state), np.int64), np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    while len(live):
        at[live] = to[live]
        state[live] = state[live] * np.uint64(LCG) + np.uint64(1)
        to[live] = ((at[live] + 1) * (2.0**31 / ((state[live] >> np.uint64(33)) + np.uint64(1)).astype(np.float64))).astype(np.int64)
        live = live[to[live] < shards]
    return at.astype(np.int32)


def jump_shard(key: Column, shards: int) -> Column:
    """Column form; keys are whole numbers."""

    @F.pandas_udf("int")
    def shard(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64), shards))

    return shard(F.coalesce(key.cast("long"), F.lit(-1)))


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add each row's place among the task's rows of its shard."""
    seen: dict[int, int] = {}
    for batch in batches:
        shard = batch.column(batch.schema.get_field_index("shard")).to_numpy(zero_copy_only=False)
        place = np.empty(len(shard), np.int64)
        for s in np.unique(shard).tolist():
            mine = shard == s
            n = int(mine.sum())
            place[mine] = np.arange(n) + seen.get(s, 0)
            seen[s] = seen.get(s, 0) + n
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], names=[*batch.schema.names, "place"])


def shard_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """Identifier, size, text_crc32, law, shard, slot and grown_shard (the shard with one shard more)."""
    body = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    rows = df.select(F.col(id_col).cast("long").alias("id"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("crc"))
    order = ["id", "size", "crc", "row"]
    rows = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).drop("row")
    rows = rows.select("*", F.spark_partition_id().alias("part"), jump_shard(F.col("id"), shards).alias("shard"), jump_shard(F.col("id"), shards + 1).alias("grown"))
    numbered = written(rows.mapInArrow(_number, "id long, size long, crc long, part int, shard int, grown int, place long"))
    counts = numbered.groupBy("shard", "part").count()
    before = F.coalesce(F.sum("count").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # stored, so its size (partitions x shards rows) decides between a broadcast and a merge join
    offsets = written(counts.select("shard", "part", before.alias("offset")))
    joined = numbered.join(offsets, ["shard", "part"])
    return joined.select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        (F.col("place") + F.col("offset")).cast("long").alias("slot"),
        F.col("grown").alias("grown_shard"),
    )


def write_shards(df: DataFrame, path: str, id_col: str = "doc_id", shards: int = SHARDS, folder: str = "shard") -> None:
    """Write the rows, all columns, as one Parquet folder per shard, named after ``folder``, which must be no column."""
    cased = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    if any(c == folder or not cased and c.lower() == folder.lower() for c in df.columns):  # as Spark compares names
        raise ValueError(f"the rows have a column {folder}; name another folder")
    df.withColumn(folder, jump_shard(F.col(id_col), shards)).write.partitionBy(folder).parquet(path)


def op4_sharding(spark, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents"))


def crc32_sql(body: str) -> str:
    """The CRC-32 of hexadecimal bytes in DuckDB, by folding four bits a step."""
    steps = [0]
    for n in range(1, 16):  # the checksum's table of half bytes, by its rule
        x = n
        for _ in range(4):
            x = x >> 1 ^ (0xEDB88320 if x & 1 else 0)
        steps.append(x)
    half = lambda x, b: f"xor({x} >> 4, list_extract({steps}, (xor({x}, {b}) & 15) + 1))"
    return f"""xor(list_reduce([4294967295] || list_transform(regexp_extract_all({body}, '..'), lambda b: ('0x' || b)::BIGINT),
         lambda x, b: {half(half("x", "b"), "(b >> 4)")}), 4294967295)"""


def _oracle(shards: int = SHARDS) -> str:
    """Jumps as a recursive query over 128-bit numbers."""
    return f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, hex(encode(coalesce(text, ''))) AS body FROM documents
), sums AS (
  SELECT r, doc_id, size, {crc32_sql("body")} AS crc
  FROM docs
), jumps AS (
  SELECT r, (coalesce(doc_id, -1)::HUGEINT + 18446744073709551616) % 18446744073709551616 AS state, 0::BIGINT AS at, 0::BIGINT AS "to" FROM docs
  UNION ALL
  SELECT r, next, "to", floor(("to" + 1) * (2147483648.0::DOUBLE / ((next // 8589934592)::DOUBLE + 1)))::BIGINT
  FROM (SELECT *, (state * {LCG}::HUGEINT + 1) % 18446744073709551616 AS next FROM jumps WHERE "to" <= {shards})
), placed AS (
  SELECT r, max("to") FILTER ("to" < {shards}) AS shard, max("to") FILTER ("to" <= {shards}) AS grown FROM jumps GROUP BY r
)
SELECT doc_id, size, crc AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, crc) - 1 AS slot, grown::INTEGER AS grown_shard
FROM sums JOIN placed USING (r)
"""


ORACLE = _oracle()
