"""Beyond the batch job: landed pivot texts as a stream of micro-batches into the fact table.

Each micro-batch is upserted like a batch ingest; keys make a replayed batch harmless."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cubelattice.operators.ingest import parse_lines, resolve
from cubelattice.sources.sinks import upsert_facts

FACT_LINES = "matrix_id int, response long, line_no long, line string"


def ingest_stream(spark: SparkSession, landing: str, facts: str, options: DataFrame, unit_id: int, staging: str, checkpoint: str) -> StreamingQuery:
    """Read JSON lines (matrix_id, response, line_no, line) as they land; stop when all present are in."""

    def upsert(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            upsert_facts(spark, facts, resolve(parse_lines(batch), options, unit_id).filter(F.col("error").isNull()), staging)

    lines = spark.readStream.schema(FACT_LINES).json(landing)
    return lines.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
