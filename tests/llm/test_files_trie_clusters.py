"""Token files, the prefix trie and sort-means against brute force, on the small tables and on hard cases."""

import hashlib
import math
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cubelattice.llm import clustering, packing, prefix_trie, queries, token_files
from cubelattice.llm.common import table

SF = "/root/testdata/sf0.01"
VOCAB = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, part string, body string, id int, size long"


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCAB)


# 2, 11: any text


@pytest.mark.parametrize("text", [" " * 1_000_000, "a" + "\n" * 1_000_000 + "b", "　" * 1_000_000, " \n" * 600_000, "z" * 1_000_000, " " * 5_000_000, "\n" * 5_000_000, "z" * 5_000_000], ids=lambda t: f"{ascii(t[:3])}-{len(t)}")
def test_encoder_reads_any_text(whole, text):
    assert packing.encoder(VOCAB)(text) == whole.encode(text, add_special_tokens=False).ids


def test_packing_of_a_million_blanks(spark):
    rows = packing.pack_texts(spark.createDataFrame([(1, " " * 1_000_000), (2, "x")], "doc_id long, text string"), VOCAB).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 1) == 1_000_001 and sum(r["length"] for r in rows) == 1_000_003


# 11


@pytest.mark.parametrize(("n", "top"), [(0, 5), (1, 1), (7, 3), (511, 9), (512, 70_000), (513, 2), (5000, 300)])
def test_wavelet_matrix(n, top):
    x = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
    body = token_files.WaveletMatrix.of(x, np.array([n] if n else [])).to_bytes()
    m = token_files.WaveletMatrix.from_bytes(body)
    assert (m.ids() == x).all() and m.size == n and m.to_bytes() == body
    assert all(m.access(k) == x[k] for k in range(0, n, max(1, n // 60)))
    with pytest.raises(IndexError):
        m.access(n)
    for v in [*x[:9].tolist(), top, 1 << 20, -1]:
        at = np.flatnonzero(x == v).tolist()
        assert m.places(v) == at and m.count(v) == len(at) and m.select(v, len(at)) == -1
        assert all(m.select(v, k) == at[k] for k in range(0, len(at), max(1, len(at) // 9)))
        for a, b in ((0, n), (n // 3, n // 2), (n // 2, n // 3), (0, 0)):
            assert m.count(v, a, b) == int((x[a:b] == v).sum()) and m.rank(v, b) == int((x[:b] == v).sum())
    with pytest.raises(ValueError, match="no token file"):
        token_files.WaveletMatrix.from_bytes(b"PAR1" + body[4:])


def brute_files(whole, docs, end=0):
    at, out = 0, []
    for ident, text in docs:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, end], "<u4")
        out.append((ident, at, len(ids), zlib.crc32(ids.tobytes()), ids.tolist()))
        at += len(ids)
    return out


def test_token_files_of_the_table(spark, whole):
    docs = sorted((r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect())
    got = queries.QUERIES["op11_token_files"](spark, SF).collect()
    assert sorted(map(tuple, got)) == [x[:4] for x in brute_files(whole, docs)]


def test_token_files_hard(spark, whole, tmp_path):
    rows = [(None, "no id"), (None, "no id"), (None, None), (3, ""), (3, "b c"), (3, "b c"), (-7, "word " * 3000), (9, "Élan <|endoftext|> 日本"), (10, None), (11, " " * 2000)]
    df = spark.createDataFrame([(*r, "x", "y", 1, 2) for r in rows], DOCS).repartition(4)
    path = str(tmp_path / "files")
    token_files.write_token_files(df, path, VOCAB, shard=40, part=100)
    got = sorted(map(tuple, token_files.read_documents(spark, path, with_ids=True).collect()), key=lambda r: r[1])
    assert spark.read.parquet(path).count() > 3
    assert [(r[0] is not None, r[0]) for r in got] == sorted(((r[0] is not None, r[0]) for r in rows), key=lambda r: (r[0], r[1] or 0))
    at = 0
    for _, start, n, crc, ids in got:
        assert start == at and n == len(ids) and crc == zlib.crc32(np.array(ids, "<u4").tobytes()) and ids[-1] == 0
        at += n
    by = defaultdict(list)
    for ident, _, _, _, ids in got:
        by[ident].append(ids)
    for ident, text in rows:
        assert [*whole.encode(text or "", add_special_tokens=False).ids, 0] in by[ident]
    stream = [i for r in got for i in r[4]]
    word, end = whole.encode(" word", add_special_tokens=False).ids[0], 0
    found = token_files.find_tokens(spark, path, [word, end, 49_999]).collect()
    for ident in (word, end):
        assert sorted(r["start"] for r in found if r["id"] == ident) == [k for k, i in enumerate(stream) if i == ident]
    assert {(r["doc_id"], r["at"]) for r in found if r["id"] == word} == {(-7, k) for k, i in enumerate(by[-7][0]) if i == word}
    assert {r["id"]: r["n"] for r in token_files.count_tokens(spark, path, [word, end, 1_000_000]).collect()} == {word: stream.count(word), end: len(rows), 1_000_000: 0}


def test_token_files_of_nothing(spark, tmp_path):
    path = str(tmp_path / "none")
    token_files.write_token_files(spark.createDataFrame([], DOCS), path, VOCAB)
    assert token_files.read_documents(spark, path).count() == 0 and token_files.find_tokens(spark, path, [1]).count() == 0


def test_equal_rows_are_cut_among_tasks(spark, tmp_path):
    df = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("one text").alias("text"))
    path = str(tmp_path / "equal")
    token_files.write_token_files(df, path, VOCAB, part=4000)
    parts = spark.read.parquet(path).select("part", F.size("doc_ids").alias("n")).collect()
    assert sum(r["n"] for r in parts) == 4000 and max(r["n"] for r in parts) < 1000
    starts = sorted(r["start"] for r in token_files.read_documents(spark, path).collect())
    assert starts == list(range(0, 4000 * 3, 3))


# 12


def brute_trie(convs):
    """{conv: [(turn, words)]} -> rows of every prefix."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(t for t, _ in turns[:d])].append(c)
    words = {tuple(t for t, _ in turns[:d]): turns[d - 1][1] if d else 0 for turns in convs.values() for d in range(len(turns) + 1)}
    kids = defaultdict(int)
    for path in members:
        if path:
            kids[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, own in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not kids[path]
            saved[path[:d]] += (len(own) - 1) * words[path]
    out = []
    for path, own in members.items():
        ended = ",".join(str(c) for c in sorted(own) if len(convs[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(own), len(path), parent, len(own), kids[path], leaves[path], saved[path], hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r[n] for n in prefix_trie.NODES) for r in df.collect()), key=repr)


@pytest.mark.parametrize("most", [1, 3, 40])
def test_multikey_quicksort_emits_nodes(most):
    rng = np.random.default_rng(most)
    convs = {int(c): [(7, 2), *((int(t), int(t) + 1) for t in rng.integers(0, most, int(rng.integers(0, 9))))] for c in rng.choice(10_000, 200, replace=False)}
    keys = sorted(convs)
    size = np.array([len(convs[c]) for c in keys])
    flat = [x for c in keys for x in convs[c]]
    got = prefix_trie.finish(np.array(keys), np.cumsum(size) - size, size, np.array([t for t, _ in flat]), np.array([w for _, w in flat]), 1, -5)
    want = [x for x in brute_trie(convs) if x[1]]
    assert sorted(zip(*got, strict=True), key=repr) == sorted(((*x[:2], -5 if x[1] == 1 else x[2], *x[3:]) for x in want), key=repr)


@pytest.mark.parametrize(("limit", "most_turns"), [(1, 1 << 18), (5, 1 << 18), (32, 12), (1000, 1 << 18)])
def test_trie_open_and_local(spark, limit, most_turns):
    rng = np.random.default_rng(limit)
    convs = {c: [int(t) for t in rng.integers(0, 3, int(rng.integers(0, 6)))] for c in range(-20, 60)}
    convs |= {c: [1, 2, 0, 1, 1, 2] for c in range(100, 180)}  # copies
    convs[500] = [1] * 60
    turns = spark.createDataFrame([(c, d + 1, t, t + 1) for c, ts in convs.items() for d, t in enumerate(ts)], "c long, d long, tid long, words long")
    lens = spark.createDataFrame([(c, len(ts)) for c, ts in convs.items()], "c long, len long")
    got = prefix_trie.trie(turns, lens, limit, most_turns)
    assert rows_of(got) == brute_trie({c: [(t, t + 1) for t in ts] for c, ts in convs.items()})


def test_conversations_hard(spark):
    long = [(30, n, "user", f"turn {n % 7} of it") for n in range(300)]
    rows = [(0, 1, "user", "a b"), (0, None, None, "c"), (0, 2, "assistant", None), (1, 0, "user", "x"), (1, 0, "user", "x"), (21, 5, "user", "alone"), (None, 1, "user", "nobody"), (-3, 1, "user", " "), *long]
    df = spark.createDataFrame([(*r, "z", 1) for r in rows], "conv_id long, turn int, role string, text string, tid string, c int").repartition(5)
    by = defaultdict(list)
    for c, turn, role, text, _, _ in df.collect():
        if c is not None:
            key = hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest()
            by[c].append(((turn is not None, turn), key, len([w for w in (text or "").split() if w])))
    own = {c: [(k, n) for _, k, n in sorted(ts)] for c, ts in by.items()}
    assert rows_of(prefix_trie.conversation_trie(df)) == brute_trie(own)
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    base = {c: own.get(c - int(math.fmod(c, 20)), []) for c in own}
    again = {c: base[c][: h[c]] + own[c][h[c] :] for c in own}
    assert rows_of(prefix_trie.conversation_trie(df, build=prefix_trie.rebuilt)) == brute_trie(again)
    assert prefix_trie.conversation_trie(df.limit(0)).count() == 0


def test_a_long_conversation_is_cut_among_tasks(spark):
    n = 20_000
    df = spark.range(n).select(F.lit(4).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.concat(F.lit("t "), F.col("id")).alias("text"))
    own = prefix_trie.turn_ids(df.union(df.filter("turn < 3").withColumn("conv_id", F.lit(5))))
    assert own.filter("c = 4").agg(F.count("*"), F.count_distinct("i"), F.max("i")).first() == (n, n, n - 1)
    nodes = prefix_trie.conversation_trie(df)
    assert nodes.count() == n + 1 and nodes.filter("n_children = 0").first()["depth"] == n


# 13


def brute_clusters(vectors, k, rounds, scale=256, seed=2):
    kept = [(i, [math.floor(scale * Fraction(x)) for x in v]) for i, v in vectors]
    first = sorted(kept, key=lambda x: hashlib.sha256(f"{seed}:{'' if x[0] is None else x[0]}".encode()).hexdigest())[:k]
    centroids = [v for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(groups[n]) for x in zip(*groups[n], strict=True)] if n in groups else c for n, c in enumerate(centroids)]
    placed = [(i, nearest(v)) for i, v in kept]
    inertia = defaultdict(int)
    for _, (d, c) in placed:
        inertia[c] += d
    total, most = sum(inertia.values()), (1 << 63) - 1
    return sorted(((i, c, min(d, most), min(inertia[c], most), min(total, most), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for i, (d, c) in placed), key=repr)


@pytest.mark.parametrize("size", [1.0, 30_000.0, 3e6, 1e12, 1e306])
def test_clusters_of_any_size(spark, size):
    rng = np.random.default_rng(5)
    vectors = [(n, (rng.normal(0, 1, 4) * size).tolist()) for n in range(90)]
    vectors += [(n % 5, [size, 0.0, -size, 0.25]) for n in range(30)] + [(None, [0.1, 0.2, 0.3, 0.4])]
    bad = [(1000, None), (1001, [1.0, 2.0, 3.0]), (1002, [1.0, 2.0, 3.0, math.nan]), (1003, [math.inf, 0.0, 0.0, 0.0]), (1004, [1.0, None, 0.0, 0.0]), (1005, [])]
    df = spark.createDataFrame([(i, v, "c", 1) for i, v in vectors + bad], "vec_id long, embedding array<double>, cluster string, body int").repartition(4)
    got = clustering.cluster_vectors(df, k=7, rounds=3, dim=4)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_clusters(vectors, 7, 3)


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(1, [0.5, 0.0]), (1, [0.5, 0.0])], "vec_id long, embedding array<float>")
    assert [r["cluster"] for r in clustering.cluster_vectors(df, dim=2).collect()] == [0, 0]
    assert clustering.cluster_vectors(df.limit(0), dim=2).count() == 0 and clustering.cluster_vectors(df, dim=3).count() == 0


def test_scan_stops_beyond_twice_the_distance():
    means = clustering.SortMeans([[0, 0], [4, 0], [100, 0], [-4, 0]])
    cluster, distance = means.assign(np.array([[2, 0], [3, 0], [-2, 0], [99, 0]]), np.array([1, 0, 3, 2]))
    assert cluster.tolist() == [0, 1, 0, 2] and distance.tolist() == [4, 1, 4, 1]
