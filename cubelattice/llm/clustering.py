"""Centroid clustering by sort-means.

In each round every centroid orders the other centroids by their distance from it. A vector starts from the centroid
of its previous assignment p and scans the centroids in p's order; since d(p, c) > 2 d(x, p) implies d(x, c) > d(x, p),
it stops at the first one strictly beyond twice its distance from p (one at exactly twice may tie). The vectors of a
batch with the same p are scanned together, one centroid at a time, for those vectors that have not stopped. Of
equally near centroids the one with the smaller number wins. In the first round every vector starts from centroid 0.

All numbers are whole: a component x becomes floor(scale * x), and comparisons are of squared distances. Double
precision holds them while 16 x dim x largest^2 stays below 2^53, 64-bit numbers while it stays below 2^63;
batches beyond that use Python's unbounded ones (a distance or inertia beyond 2^63 - 1 is given as that).

A round is one job: tasks read the vectors with their assignment, and write the new assignment beside, in a folder of
its own, their sums per cluster; those are added up on executors by cluster, and the driver reads one row of sums per
cluster. A round's table replaces the table before it. No row is shuffled, so repeated vectors gather nowhere.

Kept are vectors of exactly ``dim`` components, none null or non-finite; other rows have no row in the result. Initial
centroids are the ``k`` kept vectors whose SHA-256 of ``seed:id`` is smallest (of equal ones by their components; a
null identifier counts as empty), fewer where there are fewer vectors. Repeated rows, and rows that repeat an
identifier, are vectors of their own. An empty table gives an empty result; other columns, whatever their names, take
no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubelattice.llm.common import quoted, supersede, table, written

CENTROIDS = 40
ROUNDS = 5
DIM = 64
SCALE = 256
SEED = 2
MOST = (1 << 63) - 1
ROW = pa.schema([("id", pa.int64()), ("body", pa.binary()), ("cluster", pa.int32()), ("distance", pa.int64()), ("n", pa.int64()), ("inertia", pa.string()), ("sums", pa.string()), ("is_sum", pa.bool_())])
ROWS = "id long, body binary, cluster int, distance long, n long, inertia string, sums string, is_sum boolean"


def packed(x: np.ndarray, scale: int) -> bytes:
    """The whole numbers floor(scale * x): 4 bytes each where they fit, else 8 bytes of floor(scale * x) / scale."""
    with np.errstate(over="ignore"):
        whole = np.floor(x * scale)
    if np.abs(whole).max(initial=0) < 2**31:
        return whole.astype("<i4").tobytes()
    return np.where(np.isfinite(whole), whole / scale, x).astype("<f8").tobytes()


def unpacked(bodies: list[bytes], dim: int, scale: int) -> np.ndarray:
    """(rows x dim): 64-bit numbers, or Python's where one does not fit into 31 bits."""
    if all(len(b) == 4 * dim for b in bodies):
        return np.frombuffer(b"".join(bodies), "<i4").reshape(-1, dim).astype(np.int64)
    whole = lambda v: int(v) * scale if abs(v) >= 2.0**53 else int(v * scale)
    rows = [np.frombuffer(b, "<i4" if len(b) == 4 * dim else "<f8") for b in bodies]
    return np.array([[int(v) if row.dtype == "<i4" else whole(v) for v in row.tolist()] for row in rows], object).reshape(-1, dim)


class SortMeans:
    """The centroids of a round, and of each the others in the order of their distance."""

    def __init__(self, centroids: list[list[int]]):
        self.centroids = np.array(centroids, object)
        self.largest = max((abs(v) for c in centroids for v in c), default=0)
        gaps = ((self.centroids[:, None, :] - self.centroids[None, :, :]) ** 2).sum(-1)
        self.order = np.array([sorted(range(len(centroids)), key=lambda j, p=p: (j != p, gaps[p, j], j)) for p in range(len(centroids))], np.int64)
        self.gap = [[gaps[p, j] for j in self.order[p]] for p in range(len(centroids))]

    def kind(self, points: np.ndarray) -> type:
        """The narrowest type that holds every squared distance and four times it."""
        largest = max(self.largest, int(np.abs(points).max(initial=0)))
        most = 16 * points.shape[1] * largest**2
        return np.float64 if most < 2**53 else np.int64 if most < 2**63 else object

    def assign(self, points: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid and squared distance of each point."""
        kind = self.kind(points)
        x, centroids = points.astype(kind), self.centroids.astype(kind)
        cluster, nearest = before.astype(np.int64), np.zeros(len(x), kind)
        for p in np.unique(before).tolist():
            rows = np.flatnonzero(before == p)
            own = ((x[rows] - centroids[p]) ** 2).sum(1)
            best, at = own.copy(), np.full(len(rows), p, np.int64)
            gap = np.array(self.gap[p]).astype(kind)
            stop = np.searchsorted(gap, 4 * own, side="right") if kind is not object else np.array([sum(g <= 4 * d for g in self.gap[p]) for d in own], np.int64)
            live = np.argsort(-stop, kind="stable")  # those that scan furthest come first
            far = -stop[live]
            for k in range(1, len(centroids)):
                live = live[: int(np.searchsorted(far, -k))]  # stop > k
                far = far[: len(live)]
                if not len(live):
                    break
                c = self.order[p, k]
                d = ((x[rows[live]] - centroids[c]) ** 2).sum(1)
                better = (d < best[live]) | ((d == best[live]) & (c < at[live]))
                best[live[better]], at[live[better]] = d[better], c
            cluster[rows], nearest[rows] = at, best
        return cluster, nearest


def _assigned(centroids: list[list[int]], dim: int, scale: int, last: bool):
    """Rows (id, body, cluster) -> the same with the new cluster (and, in the last pass, the distance instead of the
    body), and one row of sums per cluster and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        means = SortMeans(centroids) if centroids else None
        k = len(centroids)
        count, inertia, sums = [0] * k, [0] * k, [[0] * dim for _ in range(k)]
        for batch in batches:
            if not batch.num_rows:
                continue
            points = unpacked(batch.column(1).to_pylist(), dim, scale)
            cluster, distance = means.assign(points, batch.column(2).to_numpy())
            whole = distance.astype(np.int64).astype(object) if distance.dtype != object else distance
            for c in np.unique(cluster).tolist():
                mine = cluster == c
                count[c] += int(mine.sum())
                inertia[c] += int(whole[mine].sum())
                if not last:
                    sums[c] = [a + int(b) for a, b in zip(sums[c], points[mine].sum(0).tolist(), strict=True)]
            n = batch.num_rows
            away = pa.array([min(MOST, int(d)) for d in whole], pa.int64()) if last else pa.nulls(n, pa.int64())
            body = pa.nulls(n, pa.binary()) if last else batch.column(1)
            yield pa.RecordBatch.from_arrays([batch.column(0), body, pa.array(cluster, pa.int32()), away, pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string()), pa.array([False] * n)], schema=ROW)
        own = [c for c in range(k) if count[c]]
        none = len(own)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(none, pa.int64()), pa.nulls(none, pa.binary()), pa.array(own, pa.int32()), pa.nulls(none, pa.int64()), pa.array([count[c] for c in own], pa.int64())]
            + [pa.array([str(inertia[c]) for c in own], pa.string()), pa.array([" ".join(map(str, sums[c])) for c in own], pa.string()), pa.array([True] * none)],
            schema=ROW,
        )

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tasks' sums of whole clusters -> one row per cluster."""
    found: dict[int, list] = {}
    for batch in batches:
        for c, n, inertia, sums in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            new = [n, int(inertia), [int(v) for v in sums.split()]]
            old = found.get(c)
            found[c] = [old[0] + new[0], old[1] + new[1], [a + b for a, b in zip(old[2], new[2], strict=True)]] if old else new
    rows = sorted(found.items())
    yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in rows], pa.int32()), pa.array([x[0] for _, x in rows], pa.int64()), pa.array([str(x[1]) for _, x in rows], pa.string()), pa.array([" ".join(map(str, x[2])) for _, x in rows], pa.string())], names=["cluster", "n", "inertia", "sums"])


def _pass(rows: DataFrame, centroids: list[list[int]], dim: int, scale: int, last: bool) -> tuple[DataFrame, dict[int, tuple]]:
    """The table of the new assignment, and (count, inertia, sums) of each cluster that has vectors."""
    found = written(rows.mapInArrow(_assigned(centroids, dim, scale, last), ROWS), by=("is_sum",))
    sums = found.filter("is_sum").select("cluster", "n", "inertia", "sums")
    added = sums.repartition("cluster").mapInArrow(_added, "cluster int, n long, inertia string, sums string").collect()  # a row per cluster
    return found.filter("not is_sum"), {r["cluster"]: (r["n"], int(r["inertia"]), [int(v) for v in r["sums"].split()]) for r in added}


def cluster_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """One row per kept vector: identifier, cluster, distance, cluster_inertia, inertia, centroid_sha256."""

    def prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = []
            for vector in batch.column(1):
                x = vector.values if vector.is_valid else None
                x = x.to_numpy(zero_copy_only=False) if x is not None and len(x) == dim and not x.null_count else None
                bodies.append(packed(x, scale) if x is not None and np.isfinite(x).all() else None)
            rows = pa.RecordBatch.from_arrays([batch.column(0), pa.array(bodies, pa.binary())], names=["id", "body"])
            yield rows.filter(rows.column(1).is_valid())

    spark = df.sparkSession
    vectors = df.select(quoted(id_col).cast("long").alias("id"), quoted(vector_col).cast("array<double>").alias("vector"))
    rows = written(vectors.mapInArrow(prepared, "id long, body binary"))
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = rows.orderBy(mark, F.hex("body")).limit(k).collect()  # k rows
    centroids = unpacked([bytes(r["body"]) for r in first], dim, scale).tolist()
    placed = rows.withColumn("cluster", F.lit(0))
    for n in range(rounds + 1):
        placed, sums = _pass(placed, centroids, dim, scale, last=n == rounds)
        supersede(spark)
        if n < rounds:
            centroids = [[v // sums[c][0] for v in sums[c][2]] if c in sums else old for c, old in enumerate(centroids)]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    whole = min(MOST, sum(x[1] for x in sums.values()))
    facts = [(c, min(MOST, x[1]), whole, digests[c]) for c, x in sums.items()]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = placed.select(F.col("id").alias(id_col), "cluster", "distance").join(F.broadcast(facts), "cluster")  # at most k rows
    return joined.select(F.col(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_clusters(spark, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def _oracle(k: int = CENTROIDS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = SEED) -> str:
    """The rounds one after the other, each a full comparison of vectors and centroids in whole numbers."""
    parts = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c, v AS m
  FROM kept QUALIFY c < {k}
)"""]  # fmt: skip
    for n in range(rounds + 1):
        parts.append(f"""
a{n} AS MATERIALIZED (
  SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, arg_min(c, (d, c)) AS c, min(d) AS d
  FROM (SELECT r, vec_id, v, c, list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM kept, c{n})
  GROUP BY r
)""")
        if n < rounds:
            parts.append(f"""
s{n} AS (SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{n}) GROUP BY c, i),
c{n + 1} AS MATERIALIZED (
  SELECT c, coalesce(f.m, c{n}.m) AS m
  FROM c{n} LEFT JOIN (SELECT c, list((s // n - CASE WHEN s % n < 0 THEN 1 ELSE 0 END)::BIGINT ORDER BY i) AS m FROM s{n} GROUP BY c) f USING (c)
)""")
    return f"""
WITH {", ".join(parts)}
SELECT vec_id, c::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY c)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (c)
"""


ORACLE = _oracle()
