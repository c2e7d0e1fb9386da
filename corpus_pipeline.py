"""A corpus pipeline over ``documents``; part of the subpackage ``cubelattice.llm``.

Language identification (what it rejects goes), exact deduplication, near-duplicate removal (one document
of each group stays), packing. Each stage works on all rows its predecessor kept.

Texts that are null, empty, blank or without a letter are rejected by the first stage. Rows without identifier
are never duplicates of another row and are packed one by one; of rows that repeat identifier and text one
stays; rows that repeat an identifier with other texts are rows of their own. Of equal texts the largest
identifier stays, of near copies the smallest. Long texts are read whole and cut by packing alone. Other
columns, whatever their names, are carried up to the last stage, and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from cubelattice.llm.common import intermediate, table
from cubelattice.llm.exact_dedup import drop_exact_duplicates
from cubelattice.llm.language import keep_identified
from cubelattice.llm.packing import pack_texts
from cubelattice.llm.simhash import drop_near_duplicates


def language_id(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs)


def exact_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_duplicates(docs, keep="largest")


def simhash(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def packing(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_texts(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("simhash", simhash), ("packing", packing)]

#: Language identification, fingerprints and packing have no SQL form; tests compare with plain Python.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        with intermediate(spark) as keep:
            docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
