"""Embedding near-duplicates over several shards and blocks against all pairs."""

import pickle

import numpy as np
import pytest

from cubelattice.llm import embedding
from cubelattice.llm.common import table


def all_pairs(rows):
    """(links, component) per vector by the cosines of all vectors of a label."""
    ids = np.array([r[0] for r in rows])
    out = {}
    for label in {r[2] for r in rows if r[2] is not None}:
        own = [k for k, r in enumerate(rows) if r[2] == label and r[1] is not None and np.isfinite(np.array(r[1], float)).all() and np.any(r[1])]
        x = np.array([rows[k][1] for k in own], float)
        x /= np.sqrt((x * x).sum(1))[:, None]
        near = x @ x.T >= 0.98
        np.fill_diagonal(near, False)
        least = ids[own].copy()
        while True:
            now = np.minimum(least, np.where(near, least[None, :], np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max))
            if (now == least).all():
                break
            least = now
        out |= {int(ids[k]): (int(near[n].sum()), int(least[n])) for n, k in enumerate(own)}
    return {int(r[0]): out.get(int(r[0]), (0, int(r[0]))) for r in rows}


@pytest.mark.parametrize(("sf", "sizes"), [("sf0.01", {}), ("sf0.01", {"shard": 40, "queries": 25}), ("sf0.1", {"shard": 100, "queries": 60})])
def test_all_links_over_shards_and_blocks(spark, sf, sizes):
    df = table(spark, f"/root/testdata/{sf}", "embeddings")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding.near_vectors(df, **sizes).collect()}
    want = all_pairs(rows)
    linked = sum(n for n, _ in want.values())
    found = sum(got[k][0] for k in want)
    assert set(got) == set(want) and all(got[k][0] <= want[k][0] for k in want)
    assert found >= 0.99 * linked and sum(got[k] == want[k] for k in want) >= 0.99 * len(want)


def test_a_stored_graph_is_the_built_one():
    x = np.random.default_rng(1).normal(size=(300, 16))
    built = embedding.Shard(np.arange(300), np.ones(300, np.int64), x)
    read = pickle.loads(pickle.dumps(built, 5))
    assert (read.graph.unit == built.graph.unit).all() and read.graph.unit.dtype == built.graph.unit.dtype
    assert all((a == b).all() for a, b in zip(built.links(x[:50], 0.5), read.links(x[:50], 0.5), strict=True))
