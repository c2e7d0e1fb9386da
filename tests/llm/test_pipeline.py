"""The pipeline against its stages in plain Python."""

from collections import defaultdict

import corpus_pipeline
import numpy as np

from cubelattice.llm import language, simhash
from cubelattice.llm.common import table
from tests.llm.test_operators import HARD, SCHEMA, brute_components, check_packing, low, similar

SF = "/root/testdata/sf0.01"


def test_pipeline(spark):
    docs = table(spark, SF, "documents")
    got = corpus_pipeline.run(spark, SF).collect()
    model = language.fit(docs.filter(~language.held_out()))
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    guessed = {k: model.predict([t]) for k, t in rows.items()}
    rows = {k: t for k, t in rows.items() if guessed[k][0][0] != "und" and guessed[k][1][0] >= language.SHARE}
    owner = {}
    for k, t in rows.items():
        owner[low(t)] = max(owner.get(low(t), k), k)
    rows = {k: rows[k] for k in owner.values()}
    ids = sorted(rows)
    # all pairs that share a shingle, by their shingle sets: the stage must lose none
    places = defaultdict(list)
    for k in ids:
        for h in np.unique(simhash.hashes(rows[k], simhash.WIDE_SHINGLE)).tolist():
            places[h].append(k)
    met = {(a, b) for own in places.values() for n, a in enumerate(own) for b in own[n + 1 :]}
    pairs = [p for p in met if similar(rows[p[0]], rows[p[1]]) >= 0.8]
    assert pairs
    root = brute_components(ids, pairs)
    check_packing(got, {k: rows[k] for k in ids if root[k] == k})


def test_pipeline_hard(spark, tmp_path):
    """Nulls, empty, blank and long texts, repeated rows, clashing names; an empty table."""
    spark.createDataFrame(HARD, SCHEMA).selectExpr("*", "1 as id", "2 as `row`", "3 as node", "4 as `a.b`").write.parquet(str(tmp_path / "documents.parquet"))
    docs = table(spark, str(tmp_path), "documents")
    model = language.fit(docs.filter(~language.held_out()))
    kept = [r for r in HARD for lang, share in [model.predict([r[1]])] if lang[0] != "und" and share[0] >= language.SHARE]
    largest = {}
    for r in kept:
        if r[0] is not None:
            largest[low(r[1])] = max(r[0], largest.get(low(r[1]), r[0]))
    want = sorted([str(k) for k in largest.values()] + ["None" for r in kept if r[0] is None])
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(str(r["doc_id"]) for r in got if r["piece"] == 0) == want
    docs.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_stages_keep_the_columns(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == docs.columns
