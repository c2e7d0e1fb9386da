"""Classification filters by a bitmap index.

Facts of a matrix are dealt into groups of at most some 16,000 by their key, and numbered inside; a classification value's
facts of a group are a bitmap. "Any of" is the union of bitmaps, "all allowed" the union of the others, and one union per
type is looked up bit by bit; facts are stored in the order of their groups, so groups without a hit are skipped by the
row groups' statistics before a fact is read. The array and bridge forms of ``filters`` give the same rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cubelattice.sources.scratch import stored

GROUP = 16_384
#: Groups up to which they are named in the scan's filter.
NAMED = 2000


def write_grouped(facts: DataFrame, path: str, group: int = GROUP) -> None:
    """Write facts with their group and bit, sorted by group inside a matrix."""
    sizes = stored(facts.groupBy("matrix_id").agg(F.ceil(F.count("*") / group).cast("int").alias("groups")))  # a row per matrix
    dealt = facts.join(sizes, "matrix_id").withColumn("grp", F.pmod(F.xxhash64("natural_key"), "groups").cast("int")).drop("groups")
    bit = F.row_number().over(Window.partitionBy("matrix_id", "grp").orderBy("natural_key")) - 1
    order = ["matrix_id", "grp"]
    dealt.withColumn("bit", bit).repartitionByRange(*order).sortWithinPartitions(*order, "bit").write.partitionBy("matrix_id").parquet(path)


def write_index(spark: SparkSession, facts_path: str, path: str) -> None:
    """(matrix_id, value_id, grp, bits): the facts of a group that are linked to a value."""
    rows = spark.read.parquet(facts_path).select("matrix_id", F.explode("class_ids").alias("value_id"), "grp", "bit")
    rows.groupBy("matrix_id", "value_id", "grp").agg(F.bitmap_construct_agg(F.col("bit").cast("long")).alias("bits")).write.partitionBy("matrix_id").parquet(path)


def is_set(bits: Column, bit: Column) -> Column:
    """Whether a bitmap has a bit; null bitmaps have none."""
    byte = F.conv(F.hex(F.substring(bits, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, bit % 8) == 1, F.lit(False))


class BitmapIndex:
    def __init__(self, spark: SparkSession, facts_path: str, path: str, matrix_id: int):
        self.facts = spark.read.parquet(facts_path).filter(F.col("matrix_id") == matrix_id)
        self.index = spark.read.parquet(path).filter(F.col("matrix_id") == matrix_id)

    def union(self, wanted: Column, name: str) -> DataFrame:
        """(grp, name): of each group the facts linked to any of the values."""
        return self.index.filter(wanted).groupBy("grp").agg(F.bitmap_or_agg("bits").alias(name))

    def _met(self, unions: list[DataFrame]) -> DataFrame:
        """Facts of the groups that all unions have, with the unions' bitmaps."""
        groups = unions[0]
        for more in unions[1:]:
            groups = groups.join(more, "grp")
        groups = stored(groups)
        few = [r[0] for r in groups.select("grp").limit(NAMED + 1).collect()]
        facts = self.facts.filter(F.col("grp").isin(few)) if len(few) <= NAMED else self.facts
        return facts.join(groups, "grp")

    def any_of(self, value_ids: Iterable[int]) -> DataFrame:
        """``filters.any_class``."""
        return self.by_type([list(value_ids)])

    def by_type(self, value_ids: list[list[int]]) -> DataFrame:
        """Facts linked to one value of each list."""
        unions = [self.union(F.col("value_id").isin(list(ids)), f"u{k}") for k, ids in enumerate(value_ids)]
        rows = self._met(unions)
        for k in range(len(unions)):
            rows = rows.filter(is_set(F.col(f"u{k}"), F.col("bit")))
        return rows.drop(*[f"u{k}" for k in range(len(unions))], "grp", "bit")

    def all_in(self, value_ids: Iterable[int]) -> DataFrame:
        """``filters.all_classes_in``: facts that no other value is linked to; those without values pass."""
        others = self.union(~F.col("value_id").isin(list(value_ids)), "others")
        return self.facts.join(stored(others), "grp", "left").filter(~is_set(F.col("others"), F.col("bit"))).drop("others", "grp", "bit")
