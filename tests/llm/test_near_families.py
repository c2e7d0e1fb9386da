"""The exact prefix search: complete whatever lists are long, and no pairs for families of texts just below 0.8."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cubelattice.llm import simhash
from cubelattice.llm.common import written

SCHEMA = "doc_id long, text string"


def family(rng, n, size, changed):
    """Texts of ``size`` words that share a body; each has a run of ``changed`` words of its own at its end."""
    body = [f"b{int(k)}" for k in rng.integers(0, 10**9, size)]
    return [" ".join([*body[: size - changed], *(f"o{int(k)}" for k in rng.integers(0, 10**9, changed))]) for _ in range(n)]


def sets(text):
    words = text.split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}


def lost_of(texts):
    """Of each group of texts linked at 0.8 all but the first."""
    own, up = [sets(t) for t in texts], list(range(len(texts)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    by = defaultdict(list)
    for k, s in enumerate(own):
        for g in s:
            by[g].append(k)
    for a, b in {(a, b) for rows in by.values() for a in rows for b in rows if a < b}:
        if 5 * len(own[a] & own[b]) >= 4 * len(own[a] | own[b]):
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return {k for k in range(len(texts)) if root(k) != k}


def searched(spark, texts, long_over):
    """Pairs of the prefix search alone: every text is a component of its own."""
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(8)
    rows = written(simhash.profiles(df, "doc_id", "text", simhash.WIDE_SHINGLE))
    first = written(rows.select("id", F.col("id").alias("component")))
    return {tuple(r) for r in simhash.candidates(df, rows, first, "doc_id", "text", long_over).collect()}


@pytest.mark.parametrize(("long_over", "common"), [(1, 0), (3, 0), (3, 1 << 16), (64, 0)])
def test_no_alike_pair_is_lost(spark, monkeypatch, long_over, common):
    monkeypatch.setattr(simhash, "COMMON", common)
    rng = np.random.default_rng(3)
    texts = [t for size, changed in ((60, 3), (60, 6), (60, 7), (90, 9), (30, 2), (8, 1)) for t in family(rng, 9, size, changed)] + ["one two", "one two three four five six", ""]
    own = [sets(t) for t in texts]
    alike = {(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts)) if texts[a].split() and texts[b].split() and 5 * len(own[a] & own[b]) >= 4 * len(own[a] | own[b])}
    found = searched(spark, texts, long_over)
    assert alike and alike <= found


def test_a_family_below_the_threshold_gives_no_pairs(spark, monkeypatch):
    """600 texts of similarity 0.79 whose shingles are in no frequency list."""
    monkeypatch.setattr(simhash, "COMMON", 0)
    rng = np.random.default_rng(5)
    texts = family(rng, 600, 300, 34)
    own = [sets(t) for t in texts[:2]]
    assert 0.78 < len(own[0] & own[1]) / len(own[0] | own[1]) < 0.8
    assert searched(spark, texts, simhash.LONG) == set()


@pytest.mark.parametrize("long_over", [2, simhash.LONG])
def test_stage_keeps_one_of_each_group(spark, monkeypatch, long_over):
    monkeypatch.setattr(simhash, "COMMON", 0)
    rng = np.random.default_rng(7)
    texts = [t for size, changed in ((60, 4), (60, 6), (60, 9), (120, 11), (40, 3)) for t in family(rng, 12, size, changed)]
    kept = simhash.drop_near_duplicates(spark.createDataFrame(list(enumerate(texts)), SCHEMA), long_over=long_over)
    assert {r["doc_id"] for r in kept.collect()} == set(range(len(texts))) - lost_of(texts)


def test_lists_over_the_limit_are_told_by_their_key():
    import pyarrow as pa

    names = ["key", "kind", "rep", "component", "other", "n", "pos", "parity"]
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int32(), pa.int64()]
    rows = [(1, 1, k, k, k, 10, 0, 0) for k in range(3)]  # short
    rows += [(2, 1, k, 5, 5, 10, 0, 0) for k in range(20)]  # long, one component
    rows += [(3, 1, k, 5 + (k == 19), 5 + (k == 19), 10, 0, 0) for k in range(20)]  # long, two components
    rows += [(4, 0, 0, 7, 9, 0, 0, 0), (4, 1, 1, 7, 7, 10, 0, 0)]  # posted once for many
    rows += [(5, 1, 1, 1, 1, 10, 0, 0), (5, 1, 2, 2, 2, 100, 0, 0)]  # sizes too far apart
    for size in (1, 2, 7, 100):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[at : at + size], strict=True), kinds, strict=True)], names=names) for at in range(0, len(rows), size)]
        got = [tuple(r.values()) for b in simhash._short_lists(4)(iter(batches)) for r in b.to_pylist()]
        assert sorted(got, key=repr) == sorted([(0, 1, None), (0, 2, None), (1, 2, None), (None, None, 3), (None, None, 4)], key=repr)


@pytest.mark.parametrize("many", [0, 1, 5000])
def test_a_filter_knows_all_its_identifiers(spark, many):
    from cubelattice.llm.common import IdFilter

    ids = written(spark.range(many).selectExpr("id * 7 - 100 as x"))
    rows = spark.range(-200, 36_000).selectExpr("id", "id as _slot0").unionByName(spark.createDataFrame([(None, 1)], "id long, _slot0 long"))
    known = {r["id"] for r in IdFilter(ids, "x").keep(rows, "id").collect()}
    assert {7 * k - 100 for k in range(many)} <= known and len(known) <= many + 0.1 * 36_000


def test_counts_of_repeated_hashes():
    import pyarrow as pa

    rng = np.random.default_rng(2)
    h = np.sort(rng.integers(0, 40, 300))
    h = np.sort(np.concatenate([h, np.full(90, 7), [1000, 1001]]))
    rep = np.arange(len(h))
    sizes = {int(k): int((h == k).sum()) for k in set(h.tolist())}
    for step in (1, 7, 50, 1000):
        batches = [pa.RecordBatch.from_arrays([pa.array(h[a : a + step]), pa.array(rep[a : a + step])], names=["h", "rep"]) for a in range(0, len(h), step)]
        got = sorted(tuple(r.values()) for b in simhash._repeated(20)(iter(batches)) for r in b.to_pylist())
        assert got == [(int(r), int(k), min(sizes[int(k)], 20)) for r, k in zip(rep, h, strict=True) if sizes[int(k)] > 1]
