"""Embedding near-duplicates by navigable small-world graphs.

Vectors are compared inside a label only. Equal vectors of a label are one class with a multiplicity. Classes are
dealt into shards of at most about ``SHARD``; each shard's hierarchical navigable small-world graph is built once
and stored, with its vectors, in the shared folder. Classes of a label are also dealt into ``WIDE`` blocks, of
``QUERIES`` to 4 x ``QUERIES``; a task holds the vectors of one block, and the graphs of all shards of the label pass by one after
the other, so every class queries every shard while a task holds one block and one graph, whatever the label's
share of the rows. Graphs search in single precision.

A query's beam widens until its worst member is below the threshold (a beam over an eighth of the shard takes in
all of it, by one matrix product). For every block and shard an audit compares evenly spaced queries with brute
force, a query's own class left out on both sides: the links found and, since there may be few, whether the
nearest other class is found (the latter alone is the evidence where a block sees no links). More queries are audited until ``LINKS`` links are seen or ``AUDITS`` queries are
taken; the beam doubles until ``RECALL`` of the links and ``NEAREST`` of the nearest are found (a beam as wide as the
shard ends it; beams widen beyond it for a query that has many links). The audits' sums are in the column ``recall``: links found by the first beams that passed, over the links there are (1 without any).

Links are verified by cosine in double precision, over vectors scaled by a power of two so that no square over- or
underflows. A task passes on a number of links per query and a spanning forest, never the pairs; components of the
forests give the groups. One shard per label makes the cost n log n; beyond that every shard is still queried, so
it grows with classes times shards, and graphs (a class's vector in double precision and its 24 links) are copied once per
block: of 100 million classes of 128 numbers in one label some 1,500 copies of 112 GB.

Vectors that are null, zero, or hold null or non-finite components, and vectors without label, link with
nothing and are their own component. Vectors of unlike lengths do not link. Null identifiers: such rows
count as copies and links, but represent nothing unless a class has no other (then its component is
null). Repeated rows are copies of each other; rows that repeat an identifier with other vectors are vectors of
their own. An empty table gives an empty result; other columns, whatever their names, take no part.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubelattice.llm.common import intermediate, quoted, table, written
from cubelattice.llm.components import components
from cubelattice.llm.simhash import Forest

COSINE = 0.98
SHARD = 8192
QUERIES, WIDE = 16_384, 64
DEGREE = 12
BEAM = 48
RECALL, NEAREST = 0.99, 0.9
AUDIT, AUDITS, LINKS = 64, 1024, 64
STRIDE = 4  # beam members expanded at once


class SmallWorld:
    """A layered graph over unit vectors; all searches run for a batch of queries at once."""

    def __init__(self, unit: np.ndarray, degree: int = DEGREE, beam: int = BEAM):
        self.unit, self.degree, self.beam = unit.astype(np.float32), degree, beam
        n = len(unit)
        draw = np.random.default_rng(11)
        level = np.minimum((-np.log(1 - draw.random(n)) / np.log(degree)).astype(int), 6)
        self.layers: list[tuple[np.ndarray, np.ndarray]] = []  # members, links among members (places, -1: none); top first
        for height in range(int(level.max(initial=0)), -1, -1):
            members = np.flatnonzero(level >= height)
            # in the order of the layer above, so the first members are those it enters by
            members = members[np.argsort(-level[members], kind="stable")]
            self.layers.append((members, self._build(members, degree * (2 if height == 0 else 1))))

    def nearest(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The beam (places, cosines) of each query."""
        place, value = self._descend(queries.astype(np.float32), min(beam, len(self.unit)))
        return np.where(place >= 0, self.layers[-1][0][place], -1), value

    def _build(self, members: np.ndarray, most: int) -> np.ndarray:
        n = len(members)
        links = np.full((n, most), -1, np.int32)
        vectors = self.unit[members]
        done = 0
        while done < n:
            size = min(n - done, 256 if done else 64, max(64, done))
            fresh = np.arange(done, done + size)
            own = vectors[fresh] @ vectors[fresh].T
            own[np.arange(size)[:, None] <= np.arange(size)[None, :]] = -2  # earlier ones of the batch
            width = min(self.beam, done + size)
            near = np.argpartition(-own, min(width, size) - 1, axis=1)[:, : min(width, size)]
            found, sims = fresh[near], np.take_along_axis(own, near, 1)
            if done:
                places, cosines = self._search(vectors, links[:done], vectors[fresh], self._entries(members, vectors[fresh], done), self.beam)
                found, sims = np.concatenate([found, places], 1), np.concatenate([sims, cosines], 1)
            found = np.where(sims > -2, found, -1)
            chosen = self._select(vectors, found, sims, self.degree)
            links[fresh, : chosen.shape[1]] = chosen
            self._return(vectors, links, fresh, chosen)
            done += size
        return links

    def _entries(self, members: np.ndarray, queries: np.ndarray, limit: int) -> np.ndarray:
        """Places among the members to start from: where the layer above ends, or the first member."""
        if not self.layers:
            return np.zeros((len(queries), 1), np.int64)
        above, links = self.layers[-1]
        found, _ = self._descend(queries, 8)
        # members of the layer above lead this layer's members, in the same order
        return np.where(found < min(limit, len(above)), found, 0)

    def _descend(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Search all finished layers, each from where the one above ended."""
        start = np.zeros((len(queries), 1), np.int64)
        sims = None
        for k, (members, links) in enumerate(self.layers):
            beam = width if k == len(self.layers) - 1 else 8
            start, sims = self._search(self.unit[members], links, queries, start, beam)
        return start, sims

    @staticmethod
    def _select(vectors: np.ndarray, found: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Of each row's candidates (-1: none), the near ones that are nearer to the row than to any chosen one."""
        order = np.argsort(-np.where(found >= 0, sims, -3), axis=1, kind="stable")[:, : 3 * most]
        found, sims = np.take_along_axis(found, order, 1), np.take_along_axis(sims, order, 1)
        held = vectors[np.maximum(found, 0)]
        mutual = held @ held.transpose(0, 2, 1)
        chosen = np.zeros(found.shape, bool)
        for k in range(found.shape[1]):
            rival = np.where(chosen, mutual[:, k], -3).max(1)
            chosen[:, k] = (found[:, k] >= 0) & (chosen.sum(1) < most) & (sims[:, k] > rival)
        # fill up with the nearest of the rest
        spare = (found >= 0) & ~chosen
        room = most - chosen.sum(1, keepdims=True)
        chosen |= spare & (np.cumsum(spare, 1) <= room // 2)
        rank = np.where(chosen, np.arange(found.shape[1]), found.shape[1])
        top = np.argsort(rank, axis=1, kind="stable")[:, :most]
        return np.where(np.take_along_axis(chosen, top, 1), np.take_along_axis(found, top, 1), -1)

    def _return(self, vectors: np.ndarray, links: np.ndarray, fresh: np.ndarray, chosen: np.ndarray) -> None:
        """Add the links back; a full node selects anew."""
        source = np.repeat(fresh, chosen.shape[1])[chosen.ravel() >= 0]
        target = chosen.ravel()[chosen.ravel() >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, starts, sizes = np.unique(target, return_index=True, return_counts=True)
        most = links.shape[1]
        for at in range(0, len(nodes), 512):
            own, width = nodes[at : at + 512], int(sizes[at : at + 512].max())
            given = np.full((len(own), width), -1, np.int64)
            for row, (s, n) in enumerate(zip(starts[at : at + 512].tolist(), sizes[at : at + 512].tolist(), strict=True)):
                given[row, :n] = source[s : s + n]
            both = np.concatenate([links[own], given], 1)
            keep = np.argsort(both < 0, axis=1, kind="stable")
            both = np.take_along_axis(both, keep, 1)
            full = (both >= 0).sum(1) > most
            links[own[~full]] = both[~full][:, :most]
            if full.any():
                some = both[full]
                sims = np.einsum("bkd,bd->bk", vectors[np.maximum(some, 0)], vectors[own[full]])
                picked = self._select(vectors, some, sims, most)
                links[own[full]] = np.pad(picked, ((0, 0), (0, most - picked.shape[1])), constant_values=-1)

    @staticmethod
    def _search(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, start: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The beam (places, cosines; -1: none) of each query over the first len(links) members."""
        n, b = len(links), len(queries)
        width = min(width, n)
        rows = np.arange(b)[:, None]
        seen = np.zeros((b, n + 1), bool)
        start = np.sort(np.where((start >= 0) & (start < n), start, 0), axis=1)
        repeated = np.zeros(start.shape, bool)
        repeated[:, 1:] = start[:, 1:] == start[:, :-1]
        seen[rows, start] = True
        place = np.full((b, width), -1, np.int64)
        value = np.full((b, width), -3, np.float32)
        todo = np.zeros((b, width), bool)
        sims = np.where(repeated, -3, np.einsum("bkd,bd->bk", vectors[start], queries))
        k = min(width, start.shape[1])
        top = np.argsort(-sims, axis=1)[:, :k]
        place[:, :k], value[:, :k] = np.take_along_axis(start, top, 1), np.take_along_axis(sims, top, 1)
        todo[:, :k] = value[:, :k] > -3
        place[value == -3] = -1
        live = np.arange(b)
        while len(live):
            v = np.where(todo[live], value[live], -3)
            stride = min(STRIDE if width <= 128 else 4 * STRIDE, width)
            pick = np.argpartition(-v, stride - 1, axis=1)[:, :stride] if stride < width else np.tile(np.arange(width), (len(live), 1))
            on = np.take_along_axis(v, pick, 1) > -3
            active = on.any(1)
            live, pick, on = live[active], pick[active], on[active]
            if not len(live):
                break
            todo[live[:, None], pick] = False
            fresh = np.where(on[:, :, None], links[np.where(on, place[live[:, None], pick], 0)], -1).reshape(len(live), -1)
            fresh = np.where((fresh >= 0) & (fresh < n), fresh, n)
            fresh.sort(axis=1)
            fresh[:, 1:][fresh[:, 1:] == fresh[:, :-1]] = n
            fresh[seen[live[:, None], fresh]] = n
            fresh.sort(axis=1)
            most = int((fresh < n).sum(1).max(initial=0))
            if not most:
                continue
            fresh = fresh[:, :most]
            ok = fresh < n
            seen[live[:, None], np.where(ok, fresh, n)] = True
            seen[:, n] = False
            sims = np.where(ok, np.einsum("bkd,bd->bk", vectors[np.where(ok, fresh, 0)], queries[live]), -3)
            all_values = np.concatenate([value[live], sims], 1)
            top = np.argpartition(-all_values, width - 1, axis=1)[:, :width]
            value[live] = np.take_along_axis(all_values, top, 1)
            place[live] = np.take_along_axis(np.concatenate([place[live], np.where(ok, fresh, -1)], 1), top, 1)
            todo[live] = np.take_along_axis(np.concatenate([todo[live], ok], 1), top, 1)
        return place, value

    def within(self, queries: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, vector) places of what the search finds at cosine ``least`` or more."""
        members = self.layers[-1][0]
        out, left, width = [], np.arange(len(queries)), min(beam, len(members))
        while len(left):
            again = []
            block = max(32, min(512, (1 << 22) // (len(members) + width * 8)))
            for at in range(0, len(left), block):
                part = left[at : at + block]
                if width >= len(members):  # such a beam takes in all members
                    row, k = np.nonzero(queries[part].astype(np.float32) @ self.unit.T >= least)
                    out.append(np.stack([part[row], k]))
                    continue
                place, value = self._descend(queries[part].astype(np.float32), width)
                full = value.min(1) >= least
                again.append(part[full])
                row, k = np.nonzero((value >= least) & ~full[:, None])
                out.append(np.stack([part[row], members[place[row, k]]]))
            left = np.concatenate(again) if again else left[:0]
            width = 4 * width if 32 * width < len(members) else len(members)
        q, v = np.concatenate(out, 1) if out else np.empty((2, 0), np.int64)
        return q, v


class Shard:
    """One shard: classes (representative, copies, vector) and their graph."""

    def __init__(self, rep: np.ndarray, copies: np.ndarray, vectors: np.ndarray):
        self.rep, self.copies, self.vectors = rep, copies, vectors
        self.norm = np.sqrt(np.einsum("nd,nd->n", vectors, vectors))
        self.graph = SmallWorld(vectors / self.norm[:, None])

    def __getstate__(self) -> dict:
        """Without the unit vectors, which the vectors give again."""
        graph = SmallWorld.__new__(SmallWorld)
        graph.__dict__.update(self.graph.__dict__, unit=None)
        return self.__dict__ | {"graph": graph}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.graph.unit = (self.vectors / self.norm[:, None]).astype(np.float32)

    def cosine(self, queries: np.ndarray) -> np.ndarray:
        return (queries @ self.vectors.T) / (np.sqrt(np.einsum("nd,nd->n", queries, queries))[:, None] * self.norm[None, :])

    def links(self, queries: np.ndarray, least: float, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """Verified (query, class) places, a class with itself included."""
        norm = np.sqrt(np.einsum("nd,nd->n", queries, queries))
        q, v = self.graph.within(queries / norm[:, None], least - 1e-5, beam)
        keep = []
        for at in range(0, len(q), 1 << 16):
            a, b = q[at : at + (1 << 16)], v[at : at + (1 << 16)]
            keep.append(np.einsum("nd,nd->n", queries[a], self.vectors[b]) / (norm[a] * self.norm[b]) >= least)
        kept = np.concatenate(keep) if keep else np.empty(0, bool)
        return q[kept], v[kept]

    def audited(self, rep: np.ndarray, queries: np.ndarray, least: float) -> tuple[int, int, int]:
        """(beam, links, links found) of the narrowest beam that passes the audit for these queries."""
        most = min(AUDITS, len(rep))
        order = np.unique(np.linspace(0, len(rep) - 1, most).astype(int))
        order = order[np.argsort(np.arange(len(order)) * 37 % max(len(order), 1), kind="stable")]  # early ones are spread, too
        sample, truth, closest = order[:0], 0, []
        while len(sample) < len(order) and (len(sample) < AUDIT or truth < LINKS):
            more = order[len(sample) : max(AUDIT, 2 * len(sample))]
            near = self.cosine(queries[more])
            near[rep[more][:, None] == self.rep[None, :]] = -2
            truth += int((near >= least).sum())
            closest.append(near.max(1))
            sample = order[: len(sample) + len(more)]
        closest = np.concatenate(closest)
        unit = queries[sample] / np.sqrt(np.einsum("nd,nd->n", queries[sample], queries[sample]))[:, None]
        beam = BEAM
        while True:
            q, v = self.links(queries[sample], least, beam)
            found = int((rep[sample][q] != self.rep[v]).sum())
            if beam >= len(self.rep):
                return beam, truth, found
            place, value = self.graph.nearest(unit, beam)
            value[(place < 0) | (self.rep[place] == rep[sample][:, None])] = -2
            met = (value.max(1) >= closest - 1e-5).mean()
            if found >= RECALL * truth and met >= NEAREST:
                return beam, truth, found
            beam *= 2


def _vectors(bodies: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(bodies), np.float64).reshape(len(bodies), -1)


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, label, vector) -> id, label, dim, digest and body (null where the row links with nothing)."""
    for batch in batches:
        dims, digests, bodies = [], [], []
        for label, vector in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
            values = vector.values if vector.is_valid and label is not None else None
            good = None
            if values is not None and len(values) and not values.null_count:
                x = values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
                most = np.abs(x).max()
                if 0 < most < np.inf:
                    good = np.ldexp(x, -np.frexp(most)[1])
            dims.append(None if good is None else len(good))
            bodies.append(None if good is None else good.tobytes())
            digests.append(None if good is None else hashlib.md5(bodies[-1]).digest())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(digests, pa.binary()), pa.array(bodies, pa.binary())], names=["id", "label", "dim", "digest", "body"])


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, rep, copies, body) sorted by shard -> (shard, graph): one pickled ``Shard`` each."""
    held: list[pa.RecordBatch] = []

    def out() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        found = Shard(rows.column("node").to_numpy(), rows.column("copies").to_numpy(), _vectors(rows.column("body").to_pylist()))
        return pa.RecordBatch.from_arrays([pa.array([held[0].column(0)[0].as_py()], pa.int64()), pa.array([pickle.dumps(found, 5)], pa.large_binary()).cast(pa.binary())], names=["shard", "graph"])

    for part in _runs(batches):
        if held and held[0].column(0)[0] != part.column(0)[0]:
            yield out()
            held = []
        held.append(part)
    if held:
        yield out()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices whose first column has one value."""
    for batch in batches:
        keys = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)] if len(keys) else []
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)


def _query(least: float):
    """Rows (block, part, node, copies, body) sorted by block and part, queries first (part -1), then the graphs
    -> link counts (a, null, n), forests (a, b, null) and audits (null, links, found)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, forest = None, Forest()
        held: list[pa.RecordBatch] = []
        rep = vectors = links = None
        for part in _runs(batches):
            if part.column(0)[0] != block:
                if links is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(rep), pa.nulls(len(rep), pa.int64()), pa.array(links)], schema=schema)
                block, held, links = part.column(0)[0], [], None
            first = int(np.searchsorted(part.column("part").to_numpy(), 0))
            if first:
                held.append(part.slice(0, first))
            for row in range(first, part.num_rows):
                if links is None:
                    rows = pa.Table.from_batches(held)
                    rep, vectors = rows.column("node").to_numpy(), _vectors(rows.column("body").to_pylist())
                    links, held = np.zeros(len(rep), np.int64), []
                shard = pickle.loads(part.column("body")[row].as_buffer())
                beam, truth, found = shard.audited(rep, vectors, least)
                yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.array([truth], pa.int64()), pa.array([found], pa.int64())], schema=schema)
                for at in range(0, len(rep), 4096):
                    own = rep[at : at + 4096]
                    q, v = shard.links(vectors[at : at + 4096], least, beam)
                    other = own[q] != shard.rep[v]
                    q, v = q[other], v[other]
                    links[at : at + len(own)] += np.bincount(q, weights=shard.copies[v], minlength=len(own)).astype(np.int64)
                    for a, b in zip(own[q].tolist(), shard.rep[v].tolist(), strict=True):
                        forest.link(a, b)
                    if len(forest.up) > 200_000:
                        yield from _edges(forest, schema)
                        forest = Forest()
        if links is not None:
            yield pa.RecordBatch.from_arrays([pa.array(rep), pa.nulls(len(rep), pa.int64()), pa.array(links)], schema=schema)
        yield from _edges(forest, schema)

    return run


def _edges(forest: Forest, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if forest.up:
        edges = forest.edges()
        yield pa.RecordBatch.from_arrays([*edges.columns, pa.nulls(edges.num_rows, pa.int64())], schema=schema)


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = COSINE, shard: int = SHARD, queries: int = QUERIES) -> DataFrame:
    """One row per vector: identifier, n_links, component_id, kept, recall."""
    raw = df.select(quoted(id_col).cast("long").alias("id"), quoted(label_col).cast("string").alias("label"), quoted(vector_col).cast("array<double>").alias("vector"))
    with intermediate(df.sparkSession) as keep:
        rows = keep(raw.mapInArrow(_prepare, "id long, label string, dim int, digest binary, body binary"))
        classes = rows.filter("digest is not null").groupBy("label", "dim", "digest").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("body").alias("body"))
        # classes go by numbers of their own, stored with them: identifiers may be null or repeat
        classes = written(classes.withColumn("node", F.monotonically_increasing_id()))
        sizes = classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / shard).cast("int").alias("shards"), F.ceil(F.count("*") / F.least(F.greatest(F.count("*") / WIDE, F.lit(queries)), F.lit(4 * queries))).cast("int").alias("blocks"))
        dealt = classes.join(written(sizes), ["label", "dim"])
        part = F.pmod(F.xxhash64("node"), "shards").cast("int")
        block = F.pmod(F.xxhash64("node", F.lit(1)), "blocks").cast("int")
        index = dealt.select(F.xxhash64("label", "dim", part).alias("shard"), "node", "copies", "body").repartition("shard").sortWithinPartitions("shard")
        graphs = written(index.mapInArrow(_build, "shard long, graph binary"))
        every = sizes.select("label", "dim", "blocks", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("part"))
        every = every.select(F.xxhash64("label", "dim", "part").alias("shard"), "label", "dim", "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        copied = graphs.join(written(every), "shard").select(F.xxhash64("label", "dim", "block").alias("block"), "part", F.lit(0).cast("long").alias("node"), F.lit(0).cast("long").alias("copies"), F.col("graph").alias("body"))
        asked = dealt.select(F.xxhash64("label", "dim", block).alias("block"), F.lit(-1).alias("part"), "node", "copies", "body")
        tasks = asked.unionByName(copied).repartition("block").sortWithinPartitions("block", "part")
        found = written(tasks.mapInArrow(_query(least), "a long, b long, n long"))
        seen = found.filter("a is null").agg(F.sum("b"), F.sum("n")).first()
        counts = found.filter("a is not null and b is null").groupBy("a").agg(F.sum("n").alias("n"))
        groups = components(found.filter("a is not null and b is not null").select("a", "b"))
        known = classes.select("label", "dim", "digest", "rep", "node", "copies")
        known = known.join(counts, known["node"] == counts["a"], "left").drop("a").join(groups.withColumnRenamed("node", "at"), F.col("node") == F.col("at"), "left")
        known = known.select("label", "dim", "digest", "rep", F.coalesce("component", "node").alias("root"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"))
        least_of = known.groupBy("root").agg(F.min("rep").alias("component"))
        known = keep(known.join(least_of, "root").select("label", "dim", "digest", "n", "component"))
    joined = rows.select("id", "label", "dim", "digest").join(known, ["label", "dim", "digest"], "left")
    component = F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("component"))
    recall = seen[1] / seen[0] if seen[0] else 1.0
    return joined.select(
        F.col("id").alias(id_col),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"),
        F.lit(float(recall)).alias("recall"),
    )


def op6_embedding(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
