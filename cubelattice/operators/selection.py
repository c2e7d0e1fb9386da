"""Exact quantiles of many groups at once, without a group's values in one task.

A wanted rank is looked for among the buckets between approximate quantiles of its group: rows are counted per bucket (and
per bound, whose equal values are one bucket and need no further look), the counts are added up, and only rows of the
buckets that hold a wanted rank go on to the next round, as groups of their own. A bucket of at most ``SMALL`` rows is sorted.
So a round passes once over what is left, about a share 1 / ``CUTS`` of it per wanted rank."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cubelattice.sources.scratch import stored

CUTS = 64
SMALL = 4096


KEY = ["g", "part"]


def _sizes(rows: DataFrame, cuts: int) -> DataFrame:
    """(g, part, n, bounds) of every group, stored."""
    shares = [k / cuts for k in range(cuts + 1)]
    return stored(rows.groupBy(*KEY).agg(F.count("*").alias("n"), F.approx_percentile("value", shares, 100 * cuts).alias("bounds")))


def ranked_values(rows: DataFrame, wanted: DataFrame, sizes: DataFrame, small: int = SMALL, cuts: int = CUTS) -> DataFrame:
    """(g, part, value), stored, their ``_sizes``, and (g, part, rank, goal) -> (g, goal, value): the value at each rank
    from 0 in the order of a group's values. All parts are 0 at first."""
    asked, key = wanted, KEY
    found: DataFrame | None = None
    while True:
        few = rows.join(sizes.filter(F.col("n") <= small).select(*key), key, "left_semi")
        order = F.row_number().over(Window.partitionBy(*key).orderBy("value")) - 1  # at most ``small`` rows
        done = few.withColumn("rank", order.cast("long")).join(asked, [*key, "rank"]).select("g", "goal", "value")
        found = done if found is None else found.unionByName(done)
        large = sizes.filter(F.col("n") > small).select(*key, "bounds")
        if large.isEmpty():
            return found
        below = F.size(F.filter("bounds", lambda b: b < F.col("value")))
        cut = rows.join(large, key).withColumn("bucket", (2 * below + F.array_contains("bounds", F.col("value")).cast("int")).cast("long"))
        before = F.sum("n").over(Window.partitionBy(*key).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
        counts = cut.groupBy(*key, "bucket").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(before, F.lit(0)))  # at most 2 x cuts + 3 of a group
        held = asked.join(counts, key).filter((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("n")))
        held = stored(held.select(*key, "bucket", (F.col("rank") - F.col("before")).alias("rank"), "goal"))
        equal = held.filter("bucket % 2 = 1").join(large, key).select("g", "goal", F.get("bounds", ((F.col("bucket") - 1) / 2).cast("int")).alias("value"))
        found = found.unionByName(equal)
        inner = held.filter("bucket % 2 = 0")
        part = (F.col("part") * (2 * cuts + 3) + F.col("bucket") + 1).alias("part")
        rows = stored(cut.join(inner.select(*key, "bucket").distinct(), [*key, "bucket"], "left_semi").select("g", part, "value"))
        asked = stored(inner.select("g", part, "rank", "goal"))
        sizes = _sizes(rows, cuts)


def quantiles(rows: DataFrame, keys: list[str], shares: list[float], small: int = SMALL, cuts: int = CUTS) -> DataFrame:
    """Rows with ``keys`` and a value, a stored table -> keys, and ``p``: the interpolated quantiles at the shares, of the
    values that are not null; groups without one have no row."""
    own = rows.filter("value is not null").select(F.struct(*keys).alias("g"), F.lit(0).cast("long").alias("part"), "value")
    sizes = _sizes(own, cuts)
    place = lambda p: (F.col("n") - 1) * F.lit(p)
    # a quantile is a weighted sum of the values at two ranks
    end = lambda k, goal, weight: F.struct(F.lit(k).alias("k"), goal.alias("goal"), weight.alias("weight"))
    spots = [x for k, p in enumerate(shares) for rest in [place(p) - F.floor(place(p))] for x in (end(k, F.floor(place(p)), 1 - rest), end(k, F.ceil(place(p)), rest))]
    spots = sizes.select("g", "part", F.explode(F.array(*spots)).alias("s")).select("g", "part", "s.*")
    goals = spots.select("g", "part", F.col("goal").alias("rank"), "goal").distinct()
    values = ranked_values(own, goals, sizes, small, cuts)
    each = spots.join(values, ["g", "goal"]).groupBy("g", "k").agg(F.sum(F.col("value") * F.col("weight")).alias("v"))
    found = each.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("k", "v"))).alias("s"))  # a few shares
    return found.select(*[F.col(f"g.{c}") for c in keys], F.col("s.v").alias("p"))
