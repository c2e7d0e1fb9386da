"""The training-data operators against brute force, on the small tables and on hard cases."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from cubelattice.llm import bpe, embedding, exact_dedup, language, licenses, lines, packing, queries, scoring, sharding, simhash
from cubelattice.llm.common import table
from cubelattice.llm.components import components
from tests.parity import duck, same

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
VOCAB = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, score string"
#: nulls in any column, empty, blank, letterless and long texts, repeated rows, ties, clashing names
HARD = [
    (1, None, None, None, None, "x", None),
    (2, "", "en", "a", 0, "x", "y"),
    (3, " \t\n ", "en", "a", 3, None, "y"),
    (4, "Under the MIT License under the mit-license", "en", "a", 9, "x", "y"),
    (5, "UNDER the mit license UNDER THE MIT LICENSE", None, "b", 9, "x", "y"),
    (5, "UNDER the mit license UNDER THE MIT LICENSE", None, "b", 9, "x", "y"),
    (None, "no id at all, no id", "en", "b", 5, "x", "y"),
    (None, "no id at all, no id", "en", None, 5, "x", "y"),
    (7, "12345 67890 !!", "fr", "c", 14, "x", "y"),
    (8, "word " * 30_000, "en", "c", 150_000, "x", "y"),
    (9, "z" * 20_000, "en", "c", 20_000, "x", "y"),
    (10, "Élan vital é è <|endoftext|> ﬁ 日本 \U0001f600 'S's", "fr", "c", 5, "x", "y"),
    (11, "no ID at all, NO id", "en", "d", 5, "x", "y"),
]


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame(HARD, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return [(r["doc_id"], r["text"], r["lang"]) for r in table(spark, SF, "documents").collect()]


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def low(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    assert same(queries.QUERIES[name](spark, SF), duck(SF), queries.ORACLES[name]) > 0


# components


def test_components_of_chains_stars_and_repeats(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(200, 260)] + [(7, 7), (3, None), (300, 301), (301, 300)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 100 for k in range(100, 141)} | {k: 7 for k in [7, *range(200, 260)]} | {300: 300, 301: 300}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# 1


def test_trie_spills_by_subtree_and_stays_exact():
    rng = np.random.default_rng(1)
    keys = [bytes(rng.integers(97, 100, int(rng.integers(0, 40))).astype(np.uint8)) + b"q" * 300 for _ in range(3000)]
    for budget in (4000, 60_000, 1 << 40):
        trie, want = exact_dedup.RadixTrie(min, budget), {}
        for n, k in enumerate(keys):
            trie.insert(k, n, 1, k)
            want[k] = (want.get(k, (n, 0))[0], want.get(k, (n, 0))[1] + 1)
        got = {payload: (owner, rows) for owner, rows, payload in trie.terminals()}
        assert got == want


def test_exact_dedup_hard(spark, hard):
    got = sorted(map(repr, exact_dedup.exact_duplicates(hard, keep="largest").collect()))
    groups = defaultdict(list)
    for r in HARD:
        groups[low(r[1])].append(r[0])
    want = []
    for r in HARD:
        g = groups[low(r[1])]
        known = [x for x in g if x is not None]
        keep = max(known) if known else None
        want.append((r[0], keep, len(g), keep is not None and keep == r[0], hashlib.sha256(low(r[1]).encode()).hexdigest()))
    assert sorted(map(tuple, exact_dedup.exact_duplicates(hard, keep="largest").collect()), key=repr) == sorted(want, key=repr)
    kept = exact_dedup.drop_exact_duplicates(hard, keep="largest")
    assert kept.columns == hard.columns and {r["doc_id"] for r in kept.collect()} == {2, 3, 4, 5, 7, 8, 9, 10, 11, None} - {None} | {None}
    assert exact_dedup.exact_duplicates(empty(spark)).count() == 0 and got


# 2


def check_packing(rows, texts):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(VOCAB)
    ids = {k: [*whole.encode(t or "", add_special_tokens=False).ids, 2] for k, t in texts.items()}
    by, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by) == set(ids)
    for k, own in by.items():
        own.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert sum(r["length"] for r in own) == len(ids[k])
        at = 0
        for r in own:
            assert r["start"] == at and r["length"] <= 1024 and (r["piece"] == 0 or r["length"] == 1024)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[k][at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert len(own) == math.ceil(len(ids[k]) / 1024)
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    return len(bins), sum(map(len, ids.values()))


def test_packing(spark, docs):
    rows = queries.QUERIES["op2_packing"](spark, SF).collect()
    used, tokens = check_packing(rows, {k: t for k, t, _ in docs})
    assert used <= 1.01 * math.ceil(tokens / 1024) + 1


def test_packing_hard(spark):
    texts = {n: r[1] for n, r in enumerate(HARD)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check_packing(packing.pack_texts(df, VOCAB).collect(), texts)
    # rows without identifier and rows that repeat one are packed row by row
    rows = packing.pack_texts(spark.createDataFrame(HARD, SCHEMA), VOCAB).collect()
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert Counter(r["doc_id"] for r in rows if r["piece"] == 0) == Counter(r[0] for r in HARD)
    assert all(b == a + n for own in map(sorted, bins.values()) for (a, n), (b, _) in zip(own, own[1:], strict=False))
    assert packing.pack_texts(empty(spark), VOCAB).count() == 0


def test_groups_are_packed_apart(spark):
    # one identifier, or none, for all: the groups are dealt by row
    df = spark.createDataFrame([(None if n % 2 else 1, 0, 0, 1 + n * 7919 % 1024, 0) for n in range(5000)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    rows = packing.pack(df, group=500).collect()
    fill = defaultdict(int)
    for r in rows:
        fill[r["sequence_id"]] += r["length"]
    assert len(rows) == 5000 and max(fill.values()) <= 1024 and len({s >> 32 for s in fill}) == 10


def test_placement_is_close_to_the_bound():
    lengths = np.random.default_rng(3).integers(1, 1025, 6000)
    sequence, _ = packing.place(lengths)
    assert sequence.max() + 1 <= 1.02 * math.ceil(lengths.sum() / 1024)


# 3


def brute_fingerprint(text):
    words = regex.findall(r"[^\x20\x09-\x0D]+", low(text))
    if not words:
        return 0
    grams = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(nodes, linked):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_turan_triples():
    from itertools import combinations

    assert len(simhash.FOURS) == 70 and len(set(simhash.SPARSE)) == 64 and all(len(set(t)) == 3 for t in simhash.SPARSE)
    assert len(simhash.TRIPLES) == 20 and all(any(set(t) <= set(q) for t in simhash.TRIPLES) for q in combinations(range(8), 4))


def test_simhash(spark, docs):
    rows = queries.QUERIES["op3_simhash"](spark, SF).collect()
    fps = {k: brute_fingerprint(t) for k, t, _ in docs}
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == {k: f"{f:016x}" for k, f in fps.items()}
    ids, x = list(fps), np.array(list(fps.values()), np.uint64)
    pairs = [(ids[i], ids[j]) for i in range(len(x)) for j in np.flatnonzero(np.bitwise_count(x[i] ^ x) <= 4) if i < j]
    assert {r["doc_id"]: r["component_id"] for r in rows} == brute_components(ids, pairs)


@pytest.mark.parametrize("short", [simhash.SHORT_KEYS, 10])
def test_simhash_links_across_blocks_of_long_lists(spark, monkeypatch, short):
    monkeypatch.setattr(simhash, "BLOCK", 40)
    monkeypatch.setattr(simhash, "SHORT_KEYS", short)
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 62, 6).astype(np.int64)
    fps = sorted({int(b ^ np.bitwise_or.reduce(np.left_shift(np.int64(1), rng.choice(62, int(rng.integers(0, 6)), replace=False)), initial=np.int64(0))) for b in base for _ in range(120)})
    df = spark.createDataFrame([(f, n) for n, f in enumerate(fps)], "fp0 long, rep long")
    got = {r["node"]: r["component"] for r in components(simhash.links(df)).collect()}
    x = np.array(fps)
    pairs = [(i, j) for i in range(len(x)) for j in np.flatnonzero(np.bitwise_count((x[i] ^ x).view(np.uint64)) <= 4).tolist() if i < j]
    want = brute_components(range(len(x)), pairs)
    touched = {n for p in pairs for n in p}
    assert got == {n: want[n] for n in touched}


def similar(a, b):
    sets = []
    for t in (a, b):
        w = low(t).split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_near_copies_go_and_clean_texts_stay(spark):
    rng = np.random.default_rng(8)
    words = np.array([f"w{k}" for k in range(5000)])
    rows, copies = [], []
    for n in range(150):
        body = list(rng.choice(words, int(rng.integers(60, 400))))
        rows.append((10 * n, " ".join(body)))
        edited = list(body)
        for k in rng.choice(len(body), max(1, len(body) // 100), replace=False):
            edited[k] = "changed"
        if similar(rows[-1][1], " ".join(edited)) >= 0.85:
            copies.append((10 * n + 1, " ".join(edited)))
    got = {r["doc_id"] for r in simhash.drop_near_duplicates(spark.createDataFrame(rows + copies, "doc_id long, text string")).collect()}
    assert {k for k, _ in rows} <= got and len(copies) > 100
    assert len(got - {k for k, _ in rows}) <= 0.03 * len(copies)


@pytest.mark.parametrize("short", [simhash.SHORT_WIDE_KEYS, 10])
def test_no_link_at_the_least_similarity_is_lost(spark, monkeypatch, short):
    """Pairs at 0.8 or little more, short and long: the groups are those of all pairs by shingle sets."""
    monkeypatch.setattr(simhash, "SHORT_WIDE_KEYS", short)
    rng = np.random.default_rng(11)
    words, rows = np.array([f"w{k}" for k in range(4000)]), []
    for n in range(400):
        body = list(rng.choice(words, (8, 9, 13, 49, 58)[n % 5]))
        rows.append((len(rows), " ".join(body)))
        # one shingle more; or the edges of the text changed until similarity is just 0.8
        if n % 5 < 2:
            rows.append((len(rows), " ".join([*body, f"x{n}"])))
        else:
            k = {13: 1, 49: 5, 58: 6}[len(body)]
            rows.append((len(rows), " ".join([*body[k:], *[f"x{n}y{i}" for i in range(k)]])))
    rows += [(len(rows) + k, t) for k, t in enumerate(["", "one", "one two", "One  two"])]
    pairs = [(a, b) for a, s in rows for b, t in rows[a + 1 :] if set(s.lower().split()) & set(t.lower().split()) and similar(s, t) >= 0.8]
    root = brute_components([k for k, _ in rows], pairs)
    want = {k for k, _ in rows if root[k] == k}
    assert len(rows) - len(want) > 300
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"] for r in simhash.drop_near_duplicates(df).collect()} == want


def test_verified_links_are_those_of_alike_sets(spark, monkeypatch):
    """One coarse group of texts in chains of edits, whole and cut into blocks: components of all pairs at 0.8."""
    rng = np.random.default_rng(3)
    words, rows = np.array([f"w{k}" for k in range(900)]), []
    for n in range(6):
        body = list(rng.choice(words, 120))
        for k in range(40):
            rows.append((len(rows), " ".join(body)))
            for at in rng.choice(120, 1 + k % 5, replace=False):
                body[at] = f"v{n}x{k}"
    rows += [(len(rows) + k, t) for k, t in enumerate(["", "one", "one two"])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    distinct = simhash.distinct_of(simhash.fingerprints(df, "doc_id", "text", simhash.WIDE_SHINGLE, simhash.WIDE), simhash.WIDE)
    coarse = distinct.selectExpr("rep as node", "0L as component")
    pairs = [(a, b) for a, s in rows for b, t in rows if a < b and similar(s, t) >= 0.8]
    want = brute_components([k for k, _ in rows], pairs)
    touched = {n for p in pairs for n in p}
    assert 20 < len(touched) and len(set(want.values())) > 20
    for name, value in (("BLOCK_BYTES", simhash.BLOCK_BYTES), ("BLOCK_TEXTS", 50), ("BLOCK_BYTES", 20_000)):
        monkeypatch.setattr(simhash, name, value)
        found = components(simhash.verified(df, distinct, coarse, "doc_id", "text")).collect()
        assert {r["node"]: r["component"] for r in found} == {n: want[n] for n in touched}


def test_simhash_hard(spark, hard):
    rows = simhash.near_duplicates(hard).collect()
    assert len(rows) == len(HARD)
    assert {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] in (1, 2, 3, 5, 11)} == {1: 1, 2: 1, 3: 1, 5: 5, 11: 11}
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [11, 11]
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.drop_near_duplicates(hard).columns == hard.columns


# 4


def brute_jump(key, shards):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def check_shards(rows, texts):
    want = sorted((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "key", brute_jump(-1 if k is None else k, 8), brute_jump(-1 if k is None else k, 9)) for k, t in texts) if all(k is not None for k, _ in texts) else None
    if want is not None:
        assert sorted((r["doc_id"], r["size"], r["text_crc32"], r["law"], r["shard"], r["grown_shard"]) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 8)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_sharding(spark, docs):
    check_shards(queries.QUERIES["op4_sharding"](spark, SF).collect(), [(k, t) for k, t, _ in docs])


def test_sharding_hard(spark, hard, tmp_path):
    rows = sharding.shard_rows(hard).collect()
    assert len(rows) == len(HARD)
    check_shards(rows, [(r[0], r[1]) for r in HARD])
    assert sharding.shard_rows(empty(spark)).count() == 0
    sharding.write_shards(hard, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(HARD)
    clash = hard.withColumn("shard", F.lit("own"))
    with pytest.raises(ValueError, match="column shard"):
        sharding.write_shards(clash, str(tmp_path / "clash"))
    sharding.write_shards(clash, str(tmp_path / "clash"), folder="part")
    assert {r["shard"] for r in spark.read.parquet(str(tmp_path / "clash")).collect()} == {"own"}
    with pytest.raises(ValueError, match="shard"):
        sharding.jump(np.array([1]), 0)


# 5


def brute_scores(docs):
    words = {k: [*regex.findall(r"[^\x20\x09-\x0D]+", low(t)), None] for k, t in docs}
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in words}
    c = Counter(w for k, ws in words.items() if not held[k] for w in ws)
    n, v = sum(c.values()), len(c)
    return {k: (held[k], len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for k, ws in words.items()}


def test_scoring(spark, docs, monkeypatch):
    monkeypatch.setattr(scoring.fit, "__defaults__", ("text", scoring.HEAD, 3000))  # so that many tokens meet the join
    rows = {r["doc_id"]: r for r in queries.QUERIES["op5_scoring"](spark, SF).collect()}
    want = brute_scores([(k, t) for k, t, _ in docs])
    assert set(rows) == set(want)
    for k, (held, n, known, train, base) in want.items():
        r = rows[k]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, train)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
    held = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) + 0.02 * abs(sum(r["base_score"] for r in held))


def brute_score(model, c, text):
    """log10 P(text) token by token: the model's softmax over all classes, then the token's share of its bucket."""
    p, found = model.parameters, 0.0
    before = [model.classes] * scoring.BEFORE
    for w in scoring.tokens(text):
        kind = model.own.get(w, model.head + scoring.bucket(w))
        q = sum(p["context"][k] @ m for k, m in zip(before, p["through"], strict=True))
        logits = p["target"] @ q + p["bias"]
        chances = np.exp(logits - logits.max())
        found += math.log10(chances[kind] / chances.sum())
        if kind >= model.head:
            found += math.log10((c.get(w, 0) + 1) / (model.mass[kind - model.head] + 1))
        before = [kind, *before[:-1]]
    return found


def test_scores_are_those_of_brute_force(spark, docs):
    df = table(spark, SMALL, "documents")
    model, counts = scoring.fit(df.filter(~scoring.held_out()), known=500)
    c = {bytes(r["token"]): r["c"] for r in counts.collect()}
    inside = np.zeros(scoring.BUCKETS)
    for w, n in c.items():
        if w not in model.own:
            inside[scoring.bucket(w)] += n + 1
    assert (inside == model.mass).all()  # so the shares (c + 1) / (mass + 1), unseen included, sum to one
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    for r in scoring.score(df, model, counts).collect()[:60]:
        assert r["score"] == pytest.approx(brute_score(model, c, texts[r["doc_id"]]), rel=1e-5)
    words = [b"a", b"xyz", b"\xc3\xa9", b"q" * 65]
    assert scoring.buckets(words).tolist() == [scoring.bucket(w) for w in words]


def test_scoring_hard(spark, hard):
    model, counts = scoring.fit(hard)
    rows = scoring.score(hard, model, counts).collect()
    assert sorted(r["n_tokens"] for r in rows) == sorted(len(low(r[1]).split()) + 1 for r in HARD)
    assert all(np.isfinite([r["score"], r["base_score"]]).all() for r in rows)
    twice = [tuple(r) for r in rows if r["doc_id"] == 5]
    assert len(twice) == 2 and twice[0] == twice[1]
    model, counts = scoring.fit(empty(spark))
    rows = scoring.score(hard, model, counts).collect()
    assert all(r["base_score"] == 0 and r["n_known"] == 0 for r in rows) and len(rows) == len(HARD)
    context = model.log10([np.array([0, 1, 2]), np.array([5])])
    assert context == pytest.approx(-np.log10(model.classes) * np.array([3, 1]), rel=1e-6)
    assert scoring.score(empty(spark), model, counts).count() == 0


def test_rows_are_told_apart_without_identifier(spark):
    """Texts of equal 32-bit hash, long tokens, and repeated rows, all without identifier."""
    texts = ["t t t t t 23949", "t t t t 285768", "z" * 300, "z" * 300, "z" * 301, "a"]
    df = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    assert df.select(F.hash("text")).distinct().count() < 5
    model, counts = scoring.fit(df.limit(3), known=2)
    c = {bytes(r["token"]): r["c"] for r in counts.collect()}
    rows = scoring.score(df, model, counts).collect()
    assert sorted(r["n_tokens"] for r in rows) == [2, 2, 2, 2, 6, 7]
    want = sorted((len(w), sum(w in c for w in ws), round(brute_score(model, c, t), 4)) for t in texts for ws in [scoring.tokens(t)] for w in [ws])
    assert sorted((r["n_tokens"], r["n_known"], round(r["score"], 4)) for r in rows) == want
    rows = [(None, "y541996\nkeep\nz"), (None, "common\nown")] + [(n, "common\nmine") for n in range(3)]
    df = spark.createDataFrame([(*r, f"s{n}") for n, r in enumerate(rows)], "doc_id long, text string, source string")
    got = sorted((str(r["doc_id"]), r["n_removed"], r["clean_text"]) for r in lines.clean_lines(df, sites=2).collect())
    assert got == sorted([("None", 0, "y541996\nkeep\nz"), ("None", 1, "own")] + [(str(n), 1, "mine") for n in range(3)])


# 6


def brute_vectors(rows):
    good = [(i, lab, np.array(v, float)) for i, v, lab in rows if lab is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links, pairs = Counter(), []
    for a in range(len(good)):
        for b in range(a):
            (i, la, x), (j, lb, y) = good[a], good[b]
            if la == lb and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.98:
                links[i] += 1
                links[j] += 1
                pairs.append((i, j))
    root = brute_components([r[0] for r in rows], pairs)
    return {i: (links[i], root[i], root[i] == i) for i, _, _ in rows}


def test_vectors(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table(spark, SMALL, "embeddings").collect()]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in queries.QUERIES["op6_embedding"](spark, SMALL).collect()}
    assert got == brute_vectors(rows)


def test_vectors_hard(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=16)
    near = [(100 + k, (centre + 0.02 * rng.normal(size=16)).tolist(), 1) for k in range(150)]
    odd = [(1, None, 1), (2, [], 1), (3, [0.0] * 16, 1), (4, [float("nan")] + [1.0] * 15, 1), (5, [float("inf")] + [1.0] * 15, 1), (6, [None] + [1.0] * 15, 1), (7, near[0][1], None), (8, near[0][1], 2), (9, near[0][1], 1), (10, near[0][1], 1), (11, near[0][1][:8], 1), (12, (-np.array(near[0][1])).tolist(), 1)]
    df = spark.createDataFrame(near + odd, "vec_id long, embedding array<double>, label int").withColumns({"n": F.lit(1), "digest": F.lit("x"), "recall": F.lit("own")})
    want = brute_vectors(near + odd)
    for options in ({}, {"shard": 40}, {"shard": 40, "queries": 30}):
        rows = embedding.near_vectors(df, **options).collect()
        assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in rows} == want
        assert {r["recall"] for r in rows} == {1.0}
    assert embedding.near_vectors(df.limit(0)).count() == 0


def test_vectors_of_any_length_and_rows_without_or_with_repeated_identifier(spark):
    rows = [(1, [1e-200, 1e-200], 1), (2, [1.0, 1.0], 1), (3, [2.0, 2.0], 1), (4, [1e300, 1.1e300], 1), (None, [3.0, 3.0], 1), (None, [-1.0, 0.0], 1), (7, [0.0, -1.0], 1), (7, [0.0, -2.0], 1), (7, [1.0, -1.0], 1)]
    got = sorted((str(r["vec_id"]), r["n_links"], r["component_id"]) for r in embedding.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect())
    assert got == sorted([("1", 4, 1), ("2", 4, 1), ("3", 4, 1), ("4", 4, 1), ("None", 4, 1), ("None", 0, None), ("7", 1, 7), ("7", 1, 7), ("7", 0, 7)])


def test_graph_recall(spark):
    x = np.array([r["embedding"] for r in table(spark, "/root/testdata/sf0.1", "embeddings").collect()], float)
    rep = np.arange(len(x))
    shard = embedding.Shard(rep, np.ones(len(x), int), x)
    q, _ = shard.links(x, 0.98)
    assert len(q) >= 0.99 * (shard.cosine(x) >= 0.98).sum()
    # queries from elsewhere, and an audit that widens a beam which finds too little
    other = x[:300] + 1e-3
    beam, links, found = shard.audited(rep[:300] + 10**6, other, 0.98)
    assert embedding.LINKS <= links <= (shard.cosine(other) >= 0.98).sum() and found >= embedding.RECALL * links
    shard.graph.layers[-1][1][:] = -1
    assert shard.audited(rep[:300] + 10**6, other, 0.98)[0] > beam


# 7


def test_lines(spark):
    rows = [(n, f"common line {n % 2}\nown {n}\n\n rare \r" if n < 30 else None, f"s{n}") for n in range(40)] + [(50, "common line 0", None), (51, "", "s1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("place", F.lit(1))
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["clean_text"]) for r in lines.clean_lines(df, sites=12).collect()}
    assert got[0] == (3, 2, "own 0\n") and got[50] == (1, 1, "") and got[35] == (0, 0, "") and got[51] == (0, 0, "")
    kept = {r["doc_id"]: r["n_removed"] for r in lines.clean_lines(df, sites=16).collect()}
    assert kept[0] == 1 and kept[50] == 0
    assert lines.clean_lines(empty(spark)).count() == 0


def test_lines_hard(spark, hard):
    """Exact copies count once; null identifiers, repeated rows, blank and very long texts stay whole."""
    got = sorted((str(r["doc_id"]), r["n_removed"], r["clean_text"]) for r in lines.clean_lines(hard, sites=2).collect())
    assert got == sorted((str(r[0]), 0, r[1] or "") for r in HARD)
    long = "\n".join(f"line {n}" for n in range(50_000))
    rows = [(n, "copied\nshared", f"s{n}") for n in range(5)] + [(7, "other\nshared", "s9"), (8, long, "s1"), (8, long, "s2"), (9, "line 49999", "s3")]
    got = sorted((r["doc_id"], r["n_removed"]) for r in lines.clean_lines(spark.createDataFrame(rows, "doc_id long, text string, source string"), sites=2).collect())
    assert got == [*[(n, 1) for n in range(5)], (7, 1), (8, 1), (8, 1), (9, 1)]


# 8


def brute_licenses(texts):
    """n_words, n_base, first, last, base labels, labels, score of each text, place by place."""
    every = [[w for w in regex.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t)) if w] for t in texts]
    sets = [set(w) for w in every]
    weight = {w: math.log((len(every) + 1) / (sum(w in s for s in sets) + 1)) for _, notice, _, _ in licenses.TEMPLATES for w in notice.split()}
    out = []
    for words in every:
        base, labels, based, score = set(), set(), set(), 0.0
        for label, notice, phrase, counts in licenses.TEMPLATES:
            n, p = notice.split(), phrase.split()
            lead = next(k for k in range(len(n)) if n[k : k + len(p)] == p)
            for i in range(len(words) - len(p) + 1):
                if words[i : i + len(p)] == p:
                    labels.add(label)
                    met = sum(weight[w] for k, w in enumerate(n) if 0 <= i - lead + k < len(words) and words[i - lead + k] == w)
                    mass = sum(weight[w] for w in n)
                    score = max(score, met / mass if mass > 0 else 1.0)
                    if counts:
                        base.add((label, i))
                        based.add(label)
        starts = sorted(i for _, i in base)
        out.append((len(words), len(base), starts[0] if starts else None, starts[-1] if starts else None, ",".join(sorted(based)), ",".join(sorted(labels)), round(score, 5)))
    return out


def test_licenses_hard(spark, hard):
    def check(df, rows):
        got = [(r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], round(r["score"], 5)) for r in licenses.scan(df).collect()]
        assert sorted(map(str, got)) == sorted(map(str, brute_licenses([r[1] for r in rows])))

    check(hard, HARD)
    notices = [(n, f"x{n} {notice.upper().replace(' ', '--', 2)}, {notice}") for n, (_, notice, _, _) in enumerate(licenses.TEMPLATES)]
    notices += [(100, "under the mit"), (101, "the the mit license under the mit license mit license"), (102, "apache license version 2 apache license version 2"), (103, "cc by nc sa nc by cc by by nc"), (104, "cc by nc"), (105, None)]
    check(spark.createDataFrame(notices, "doc_id long, text string").withColumns({"words": F.lit("own"), "found": F.lit(1)}), notices)
    plain = [(n, f"nothing here {n}") for n in range(5)]  # no template word at all: every IDF is a tie
    check(spark.createDataFrame(plain, "doc_id long, text string"), plain)
    same = [(n, "under the mit license") for n in range(5)]  # words in every file weigh nothing
    check(spark.createDataFrame(same, "doc_id long, text string"), same)
    assert licenses.scan(empty(spark)).count() == 0


# 9


def test_bpe_round_trip(spark, docs):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(VOCAB)
    rows = {r["doc_id"]: r for r in queries.QUERIES["op9_bpe"](spark, SF).collect()}
    for k, t, _ in docs:
        ids = whole.encode(t or "", add_special_tokens=False).ids
        assert rows[k]["n_tokens"] == len(ids)
        assert rows[k]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[k]["decoded_sha256"] == hashlib.sha256(whole.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_hard(spark, hard):
    from tokenizers import Tokenizer

    whole, machine, fast = Tokenizer.from_file(VOCAB), bpe.automaton(VOCAB), packing.encoder(VOCAB)
    rng = np.random.default_rng(9)
    texts = [r[1] or "" for r in HARD] + ["".join(chr(int(c)) for c in rng.choice([32, 10, 39, 97, 104, 116, 233, 0x1C, 0x85, 0xA0, 0xB2, 0x301, 0x2160, 0x3000, 0x65E5, 0x1F600], int(rng.integers(1, 40)))) for _ in range(300)]
    for t in texts:
        want = whole.encode(t, add_special_tokens=False).ids
        assert machine.encode(t) == want and fast(t) == want
        assert machine.decode(want) == whole.decode(want, skip_special_tokens=False)
    full = bpe.encode_texts(hard, VOCAB).collect()
    assert len(full) == len(HARD) and all(len(r["ids"]) == 0 and r["decoded"] == "" for r in full if r["doc_id"] in (1, 2))
    assert sorted((str(r["doc_id"]), r["ids"]) for r in full) == sorted((str(r[0]), whole.encode(r[1] or "", add_special_tokens=False).ids) for r in HARD)
    assert bpe.digests(empty(spark), VOCAB).count() == 0


def test_gadgets_with_and_without_table(monkeypatch):
    """The transition table, on which gadgets work as written, has the arcs that the references give."""
    whole = bpe.Automaton(VOCAB)
    rng = np.random.default_rng(4)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, bpe.TABLE, (20_000, 2))] + [(k, k) for k in range(bpe.TABLE)]
    monkeypatch.setattr(bpe, "TABLE", 256)
    small = bpe.Automaton(VOCAB)
    assert [bool(whole.rows[a][b]) for a, b in pairs] == [small.arc(a, b) for a, b in pairs]


# 10


def test_language(spark, docs):
    rows = {r["doc_id"]: r for r in queries.QUERIES["op10_language"](spark, SF).collect()}
    held = [(rows[k]["lang_pred"], lang) for k, t, lang in docs if rows[k]["held_out"] and lang and rows[k]["lang_pred"] != "und"]
    assert len(held) > 200 and sum(a == b for a, b in held) >= 0.97 * len(held)
    for k, t, _ in docs:
        assert rows[k]["held_out"] == (zlib.crc32(str(k).encode()) % 3 == 1) and 0 <= rows[k]["score"] <= 1
        assert (rows[k]["lang_pred"] == "und") == (not t or not any(c.isalpha() for c in t))


def test_language_hard(spark, hard):
    model = language.fit(table(spark, SMALL, "documents"))
    rows = {r["doc_id"]: r for r in language.identify(hard, model).collect()}
    assert {k for k, r in rows.items() if r["lang_pred"] == "und"} == {1, 2, 3, 7}
    nothing = language.fit(empty(spark))
    assert {r["lang_pred"] for r in language.identify(hard, nothing).collect()} == {"und"}
    assert language.identify(empty(spark), model).count() == 0
    kept = language.keep_identified(hard)
    learned = language.fit(hard.filter(~language.held_out()))
    want = sorted(str(r[0]) for r in HARD for lang, share in [learned.predict([r[1]])] if lang[0] != "und" and share[0] >= language.SHARE)
    assert kept.columns == hard.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == want and "4" in want


def test_a_text_that_no_language_claims_is_rejected(spark):
    rows = [(n, f"der die das und {n}" if n % 2 else f"le la les et {n}", "de" if n % 2 else "fr") for n in range(60)] + [(100, "der la die les das le und et", None), (101, "und die", None), (102, "7", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as score", "2 as pred", "3 as lang_pred", "4 as `a.b`", "5 as id")
    model = language.fit(docs.filter(~language.held_out()))
    shares = {n: model.predict([t]) for n, t, _ in rows}
    order = sorted(float(s[0]) for _, s in shares.values())
    middle = next((a + b) / 2 for a, b in zip(order[1:], order[2:], strict=False) if b - a > 1e-4)
    kept = language.keep_identified(docs, middle)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {n for n, (lang, s) in shares.items() if lang[0] != "und" and s[0] >= middle} < {r[0] for r in rows} - {102}


def test_equal_languages_go_to_the_first_and_equal_rows_alike(spark):
    rows = [(None, "abc abc", "xx"), (1, "abc abc", "aa"), (1, "abc abc", "aa"), (None, "abc abc", "xx")]
    model = language.Classifier(["abc abc", "abc abc"], ["xx", "aa"])
    got = language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), model).collect()
    assert {(r["lang_pred"], r["score"]) for r in got} == {("aa", 0.5)} and len(got) == 4


def test_texts_with_letters_stay_where_no_language_was_learned(spark):
    rows = [(1, "some words", None), (2, "12 34", None), (3, None, None), (4, "și încă", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r["doc_id"] for r in language.keep_identified(docs).collect()} == {1, 4}


def test_dropping_stages_tell_rows_by_identifier_and_text(spark):
    words = [f"w{k}" for k in range(60)]
    near = " ".join([*words, "more"])
    rows = [(1, "a b"), (5, "a b"), (5, "own text"), (7, "twice"), (7, "twice"), (None, "twice"), (8, " ".join(words)), (9, near), (9, "own of nine"), (9, "own of nine")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = [r for r in rows if r not in {(5, "a b"), (7, "twice"), (9, "own of nine")}] + [(7, "twice"), (9, "own of nine")]
    order = lambda found: sorted(map(str, found))
    assert order(tuple(r) for r in exact_dedup.drop_exact_duplicates(docs, keep="largest").collect()) == order([r for r in known if r != (1, "a b")] + [(5, "a b")])
    assert order(tuple(r) for r in exact_dedup.drop_exact_duplicates(docs, keep="smallest").collect()) == order(known)
    assert order(tuple(r) for r in simhash.drop_near_duplicates(docs).collect()) == order([r for r in known if r != (9, near)])


def test_sample_is_not_all_rows_without_identifier(spark, monkeypatch):
    rows = [(n if n % 2 else None, f"text number {n}", "en") for n in range(2000)] + [(None, "repeated text", "en")] * 100
    monkeypatch.setattr(language, "Classifier", lambda texts, langs: texts)
    found = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample=30)
    odd = sum(int(t.split()[-1]) % 2 for t in found if t != "repeated text")
    assert 0 < odd < len(found) and len(set(found)) == len(found)
    taken = []
    kind = type(spark.range(1))
    monkeypatch.setattr(kind, "collect", lambda self, f=kind.collect: taken.append(f(self)) or taken[-1])
    many = spark.range(30_000).selectExpr("cast(null as long) as doc_id", "concat('text ', id, repeat('x', 100000 * int(id % 5000 = 0))) as text", "'en' as lang")
    language.fit(many, sample=30)
    assert 30 <= len(taken[-1]) <= 120 and max(len(r["text"]) for r in taken[-1]) <= language.LONGEST
