"""Scores do not depend on the batch; language identification against brute force; all languages are learned; no cap, lost
column or hot key in the stages."""

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from cubelattice.llm import exact_dedup, language, scoring, sharding
from cubelattice.llm.common import table

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return [r["text"] for r in table(spark, SF, "documents").orderBy("doc_id").collect()]


def split(texts, size, seed):
    order = np.random.default_rng(seed).permutation(len(texts)).tolist()
    return [order[at : at + size] for at in range(0, len(order), size)]


# 5


def test_scores_are_those_of_the_text_alone(spark, texts):
    model, _ = scoring.fit(table(spark, SMALL, "documents"))
    model.log10([])
    state = model.__getstate__()
    found = {}
    for size in (1, 7, 512, len(texts)):
        fresh = scoring.Model.__new__(scoring.Model)  # a worker that has seen no context yet
        fresh.__dict__.update(state)
        for rows in split(texts, size, size):
            for n, score in zip(rows, fresh.log10([fresh.read(texts[n])[1] for n in rows]).tolist(), strict=True):
                assert found.setdefault(n, score) == score
    assert len(found) == len(texts)


def test_repeated_rows_have_equal_scores_in_any_partition(spark):
    docs = table(spark, SMALL, "documents")
    model, counts = scoring.fit(docs.filter(~scoring.held_out()))
    many = docs.unionByName(docs).unionByName(docs).repartition(13)
    rows = scoring.score(many, model, counts).groupBy("doc_id").agg(F.count_distinct("score").alias("s"), F.count_distinct("base_score").alias("b"), F.count("*").alias("n")).collect()
    assert {(r["s"], r["b"], r["n"]) for r in rows} == {(1, 1, 3)}


# 10


def test_predictions_are_those_of_the_text_alone(spark, texts):
    model = language.fit(table(spark, SMALL, "documents"))
    found = {}
    for size in (1, 7, 100, len(texts)):
        for rows in split(texts, size, size) if size > 1 else [[n] for n in range(0, len(texts), 3)]:
            langs, shares = model.predict([texts[n] for n in rows])
            for n, lang, share in zip(rows, langs, shares.tolist(), strict=True):
                assert found.setdefault(n, (lang, share)) == (lang, share)
    assert len(found) == len(texts)


def brute_language(sample, langs, asked, landmarks=language.LANDMARKS):
    """Kernel by sets of byte n-grams, weights by solving the normal equations, score by the softmax."""
    names = sorted(set(langs))
    chosen = [t for lang in names for t in [x for x, of in zip(sample, langs, strict=True) if of == lang][:landmarks]]
    grams = lambda t: [{t[k : k + n] for k in range(len(t) - n + 1)} for n in language.ORDERS]
    own = [grams(t.lower().encode()) for t in chosen]
    every = [set().union(*(g[k] for g in own)) for k in range(len(language.ORDERS))]

    def kernel(t):
        mine = [g & e for g, e in zip(grams(t.lower().encode()), every, strict=True)]
        return [sum(len(a & b) / np.sqrt(max(len(a), 1) * max(len(b), 1)) for a, b in zip(mine, other, strict=True)) / len(language.ORDERS) for other in own]

    gram = np.array([kernel(t) for t in chosen])
    values, vectors = np.linalg.eigh(gram)
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    x = np.c_[np.array([kernel(t) for t in sample]) @ whiten, np.ones(len(sample))]
    y = np.where(np.array(langs)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    w = np.array([1 / langs.count(lang) for lang in langs])
    weights = np.linalg.solve((x * w[:, None]).T @ x + language.RIDGE * np.eye(x.shape[1]), (x * w[:, None]).T @ y)
    out = []
    for t in asked:
        if not t or not regex.search(r"\p{L}", t):
            out.append(("und", 0.0))
            continue
        d = np.r_[np.array(kernel(t)) @ whiten, 1.0] @ weights
        out.append((names[int(d.argmax())], 1 / np.exp(language.SHARPNESS * (d - d.max())).sum()))
    return out


def test_language_against_brute_force(spark):
    rows = [r for r in table(spark, SMALL, "documents").collect() if r["text"] and r["lang"]][:90]
    sample, langs = [r["text"][:3000] for r in rows], [r["lang"] for r in rows]
    asked = [r["text"] for r in table(spark, SMALL, "documents").limit(60).collect()] + ["", None, "12 ½ ³", "é", "日本 text"]
    model = language.Classifier(sample, langs, landmarks=6)
    got_lang, got_score = model.predict(asked)
    want = brute_language(sample, langs, asked, 6)
    assert got_lang == [w[0] for w in want] and np.allclose(got_score, [w[1] for w in want], rtol=0, atol=1e-7)


def test_every_language_is_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "LANDMARKS_ALL", 30)
    words = lambda n: " ".join(f"{chr(97 + n % 26)}{chr(97 + n // 26 % 26)}x{k}" for k in range(20))
    rows = [(k * 100 + n, words(n), n) for n in range(70) for k in range(1 if n == 69 else 4)] + [(9000 + k, "long " * 20_000 + f"{k}", 777) for k in range(2)] + [(9999, "no letter only 1", None), (9998, "1 2 3", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang int")
    model = language.fit(docs)
    assert model.langs == sorted([str(n) for n in range(70)] + ["777"])
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs, model).collect()}
    assert all(got[i] == str(lang) for i, t, lang in rows if lang is not None and i != 9998) and got[9998] == "und"


def test_the_sample_keeps_its_bytes(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(language, "Classifier", lambda texts, langs: taken.append((texts, langs)))
    monkeypatch.setattr(language, "SAMPLE_BYTES", 60_000)
    docs = spark.range(4000).selectExpr("id as doc_id", "concat('a', repeat(char(98 + cast(id % 7 as int)), 2000), id) as text", "if(id % 2 = 0, 'en', 'fr') as lang")
    language.fit(docs)
    texts, langs = taken[-1]
    assert sum(map(len, texts)) <= 60_000 and min(langs.count("en"), langs.count("fr")) >= 12


# 4, 1


def test_shards_keep_columns_whatever_their_case(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 7)], "doc_id long, text string, Shard int")
    with pytest.raises(ValueError, match="name another folder"):
        sharding.write_shards(df, str(tmp_path / "x"))
    sharding.write_shards(df, str(tmp_path / "y"), folder="part")
    assert spark.read.parquet(str(tmp_path / "y")).first()["Shard"] == 7


def widest(df):
    return max(df.groupBy(F.spark_partition_id()).count().collect(), key=lambda r: r["count"])["count"]


def test_equal_rows_are_numbered_by_many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(8000).selectExpr("cast(null as long) as doc_id", "'same' as text")
    rows = sharding.shard_rows(df).collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r["slot"] for r in rows) == list(range(8000))


def test_rows_without_identifier_meet_nowhere(spark):
    df = spark.range(0, 20_000, 1, 16).selectExpr("if(id % 50 = 0, id % 500, null) as doc_id", "if(id % 50 = 0, concat('t', id % 500), 'same') as text", "id as other")
    found = exact_dedup.drop_exact_duplicates(df)
    assert found.filter("doc_id is null").count() == 19_600 and found.filter("doc_id is not null").count() == 10
    assert widest(found) < 4000
