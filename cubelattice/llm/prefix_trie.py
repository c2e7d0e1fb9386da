"""The prefix trie of conversations by distributed radix partitioning.

Turns are dictionary-encoded: a turn's key is the SHA-256 of its role and text, and each different key gets a number.
A conversation is then a sequence of numbers, and a bucket is the set of conversations that share a prefix: a node of
the trie. Partitioning goes by the most significant digit first, which is the next turn's number. In a round all open
buckets of one depth are counted by (bucket, number) with partial counts, and so split into their child nodes. A
child is open, and split again in the next round, while it holds over ``limit`` conversations (one in ``BUCKETS`` of
all, within ``LEAST`` and ``MOST``) or over ``TURNS`` turns. The others are local: one task finishes each by multikey
quicksort, whose middle part on a turn's number is a child node, so the recursion emits the nodes. A bucket of one
conversation is a chain; its nodes are its rows, and it meets in no task. Rounds are as many as the depth of the deepest
open bucket. Leaves and saved tokens of open nodes are summed upwards, a depth at a time.

Positions of turns are counted over a range partitioning, so a conversation with very many turns is cut among tasks.
Members of an open node that end there are written in chunks of neighbouring identifiers and digested as a stream.

Turns go by turn number, null first; equal numbers go by the key. Null role or text counts as empty. Rows without
conversation identifier belong to no conversation. Repeated rows are turns of their own. Texts are read whole, and
only their keys and numbers of words are shuffled. An empty table gives an empty result; other columns, whatever
their names, take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cubelattice.llm.common import intermediate, quoted, table, written
from cubelattice.llm.sharding import crc32_sql

BUCKETS, LEAST, MOST = 2048, 32, 4096
TURNS = 1 << 18
WORD = "[^\\x20\\x09-\\x0D]+"
EMPTY = hashlib.sha256(b"").hexdigest()
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
NODES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


# turns


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by their first column -> the same with each row's place among the task's rows of its value."""
    last, seen = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy()
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        place = np.arange(len(keys)) - np.repeat(starts, np.diff(np.r_[starts, len(keys)]))
        if keys[0] == last:
            first = int(starts[1]) if len(starts) > 1 else len(keys)
            place[:first] += seen
        last, seen = keys[-1], int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], names=[*batch.schema.names, "place"])


def turn_ids(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(c, i, tid, words): of every turn its conversation, its place there from 0, its number, and its words."""
    role, text = (F.coalesce(quoted(x).cast("string"), F.lit("")) for x in (role_col, text_col))
    key = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    rows = df.select(quoted(conv_col).cast("long").alias("c"), quoted(turn_col).alias("turn"), key.alias("key"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    rows = written(rows.filter("c is not null"))
    known = written(rows.groupBy("key").agg(F.first("words").alias("words")).withColumn("tid", F.monotonically_increasing_id()))
    coded = written(rows.drop("words").join(known, "key"))
    order = ["c", "turn", "key"]
    parts = coded.repartitionByRange(*order).sortWithinPartitions(*order).select("c", "tid", "words", F.spark_partition_id().alias("part"))
    placed = written(parts.mapInArrow(_numbered, "c long, tid long, words long, part int, place long"))
    # a conversation cut among partitions is the last one of each but its last partition, and the first one of the others
    ends = placed.groupBy("part").agg(F.min("c").alias("first"), F.max("c").alias("last"), F.max_by("place", F.struct("c", "place")).alias("most"))
    given = ends.select(F.col("last").alias("c"), "part", (F.col("most") + 1).alias("n"), F.lit(False).alias("asks"))
    asked = ends.select(F.col("first").alias("c"), "part", F.lit(0).cast("long").alias("n"), F.lit(True).alias("asks"))
    before = F.sum("n").over(Window.partitionBy("c").orderBy("part", F.desc("asks")).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    offsets = written(given.union(asked).withColumn("before", before).filter("asks").select("part", F.col("c").alias("first"), "before"))  # a row per partition
    joined = placed.join(offsets, "part")
    return joined.select("c", (F.col("place") + F.when(F.col("c") == F.col("first"), F.col("before")).otherwise(0)).alias("i"), "tid", "words")


def rebuilt(own: DataFrame, family: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first h turns, h = crc32(identifier) % ``most``, are those of the first one of their
    family (c - c % ``family``), and follow on with their own turns after their first h: (c, d, tid, words), d from 1,
    and (c, len)."""
    convs = own.groupBy("c").agg(F.count("*").alias("n"))
    convs = convs.withColumns({"h": F.crc32(F.col("c").cast("string").cast("binary")) % most, "base": F.col("c") - F.col("c") % family})
    heads = own.filter((F.col("c") % family == 0) & (F.col("i") < most - 1)).select(F.col("c").alias("base"), "i", "tid", "words")
    convs = written(convs.join(heads.groupBy("base").agg(F.count("*").alias("has")), "base", "left").withColumn("shared", F.least("h", F.coalesce("has", F.lit(0)))))
    shared = convs.join(heads, "base").filter("i < h").select("c", (F.col("i") + 1).alias("d"), "tid", "words")
    rest = own.join(convs.select("c", "h", "shared"), "c").filter("i >= h").select("c", (F.col("i") - F.col("h") + F.col("shared") + 1).alias("d"), "tid", "words")
    return shared.union(rest), convs.select("c", (F.col("shared") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len"))


def plain(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as they are: (c, d, tid, words) and (c, len)."""
    return own.select("c", (F.col("i") + 1).alias("d"), "tid", "words"), own.groupBy("c").agg(F.count("*").alias("len"))


# local buckets


def finish(conv: np.ndarray, start: np.ndarray, size: np.ndarray, tid: np.ndarray, words: np.ndarray, at: int, parent: int) -> list[list]:
    """The nodes of one bucket, as columns. Conversation ``conv[k]`` (ascending) has the turns ``start[k]`` to
    ``start[k] + size[k]`` from depth ``at`` on, and the first of them is the same turn in all."""
    rep, depth, up, members, children, saved, ends = ([] for _ in range(7))
    todo: list[tuple[bool, np.ndarray, int, int]] = [(True, np.arange(len(conv)), 1, -1)]
    while todo:
        node, group, k, of = todo.pop()
        if node:
            if of >= 0:
                children[of] += 1
            first = group[0]
            here = len(rep)
            if len(group) == 1:  # a chain
                n = int(size[first]) - k + 1
                rep += [int(conv[first])] * n
                depth += range(at + k - 1, at + k - 1 + n)
                up += [of, *range(here, here + n - 1)]
                members += [1] * n
                children += [1] * (n - 1) + [0]
                saved += [0] * n
                ends += [EMPTY] * (n - 1) + [hashlib.sha256(b"%d" % conv[first]).hexdigest()]
                continue
            rep.append(int(conv[first]))
            depth.append(at + k - 1)
            up.append(of)
            members.append(len(group))
            children.append(0)
            saved.append((len(group) - 1) * int(words[start[first] + k - 1]))
            over = size[group] == k
            ends.append(hashlib.sha256(",".join(map(str, conv[group[over]].tolist())).encode()).hexdigest() if over.any() else EMPTY)
            group, of = group[~over], here
        if not len(group):
            continue
        keys = tid[start[group] + k]
        pivot = sorted((keys[0], keys[len(keys) // 2], keys[-1]))[1]
        same = keys == pivot
        for part in (group[keys < pivot], group[keys > pivot]):
            if len(part):
                todo.append((False, part, k, of))
        todo.append((True, group[same], k + 1, of))
    leaves = [int(not n) for n in children]
    for k in range(len(rep) - 1, 0, -1):  # children stand after their parents
        leaves[up[k]] += leaves[k]
        saved[up[k]] += saved[k]
    return [rep, depth, [rep[u] if u >= 0 else parent for u in up], members, children, leaves, saved, ends]


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (rep, at, parent, c, tid, words) sorted by bucket (rep, at), conversation and depth -> nodes."""
    held: list[pa.RecordBatch] = []
    schema = pa.schema([*((n, pa.int64()) for n in NODES[:-1]), ("ends_sha256", pa.string()), ("at", pa.int64())])

    def out() -> pa.RecordBatch:
        rep, at, parent, c, tid, words = (x.to_numpy() for x in pa.Table.from_batches(held).columns)
        start = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
        nodes = finish(c[start], start, np.diff(np.r_[start, len(c)]), tid, words, int(at[0]), int(parent[0]))
        nodes.append([int(at[0])] * len(nodes[0]))
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(nodes, schema, strict=True)], schema=schema)

    key = None
    for batch in batches:
        rep, at = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cuts = np.flatnonzero((rep[1:] != rep[:-1]) | (at[1:] != at[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(rep)], strict=True) if len(rep) else []:
            if held and key != (rep[a], at[a]):
                yield out()
                held = []
            key = (rep[a], at[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield out()


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (rep, depth, text) sorted by node and chunk -> the SHA-256 of each node's joined chunks."""
    key, sha = None, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]]), pa.array([sha.hexdigest()])], names=["rep", "depth", "sha"])

    for batch in batches:
        for rep, depth, body in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if key != (rep, depth):
                if key:
                    yield out()
                key, sha = (rep, depth), hashlib.sha256(body.encode())
            else:
                sha.update(b"," + body.encode())
    if key:
        yield out()


# the trie


def trie(turns: DataFrame, convs: DataFrame, limit: int | None = None, most_turns: int = TURNS) -> DataFrame:
    """One row per node of the trie of (c, d, tid, words) and (c, len), both stored tables; see ``NODES``."""
    spark = convs.sparkSession
    with intermediate(spark) as keep:
        total, root = convs.agg(F.count("*"), F.min("c")).first()
        limit = limit or max(LEAST, min(MOST, total // BUCKETS))
        members = convs.withColumn("node", F.lit(root).cast("long"))
        levels: list[tuple[DataFrame, DataFrame]] = []  # of each depth: members of open nodes, and the nodes' children
        closed: list[DataFrame] = []
        while total:
            depth = len(levels)
            at = written(members.join(turns.filter(F.col("d") == depth + 1).select("c", "tid", "words"), "c"))
            children = at.groupBy("node", "tid").agg(F.count("*").alias("n"), F.min("c").alias("rep"), F.first("words").alias("words"), F.sum(F.col("len") - depth).alias("left"))
            is_open = (F.col("n") > limit) | (F.col("n") > 1) & (F.col("left") > most_turns)
            children = written(children.withColumn("open", is_open))
            levels.append((members, children))
            split = at.select("c", "len", "node", "tid").join(children.select("node", "tid", "rep", "n", "open"), ["node", "tid"])
            split = written(split.select("c", "len", F.col("node").alias("parent"), "rep", "n", "open"), by=("open",))
            closed.append(split.filter("not open").select("c", "len", "parent", "rep", "n", F.lit(depth + 1).cast("long").alias("at")))
            if children.filter("open").isEmpty():
                break
            members = split.filter("open").select("c", "len", F.col("rep").alias("node"))
        if not closed:
            return spark.createDataFrame([], NODE)
        closed = keep(reduce(DataFrame.union, closed))
        own = closed.join(turns, "c").filter("d >= at")
        chain = own.filter("n = 1").select(
            F.col("c").alias("conv_id"),
            F.col("d").alias("depth"),
            F.when(F.col("d") == F.col("at"), F.col("parent")).otherwise(F.col("c")).alias("parent_conv_id"),
            F.lit(1).cast("long").alias("n_convs"),
            (F.col("d") < F.col("len")).cast("long").alias("n_children"),
            F.lit(1).cast("long").alias("n_leaves"),
            F.lit(0).cast("long").alias("saved_tokens"),
            F.when(F.col("d") == F.col("len"), F.sha2(F.col("c").cast("string").cast("binary"), 256)).otherwise(EMPTY).alias("ends_sha256"),
        )
        local = own.filter("n > 1").select("rep", "at", "parent", "c", "tid", "words", "d").repartition("rep", "at").sortWithinPartitions("rep", "at", "c", "d")
        local = keep(local.drop("d").mapInArrow(_finished, NODE + ", at long"))
        opened = _opened(levels, local, root, total)
        ends = reduce(DataFrame.union, [m.filter(F.col("len") == k).select(F.col("node").alias("rep"), F.lit(k).cast("long").alias("depth"), "c") for k, (m, _) in enumerate(levels)])
        # chunks of at most 1,024 different identifiers
        chunks = ends.groupBy("rep", "depth", F.shiftright("c", 10).alias("chunk")).agg(F.sort_array(F.collect_list("c")).alias("cs"))
        chunks = chunks.withColumn("text", F.array_join(F.transform("cs", lambda c: c.cast("string")), ","))
        digests = chunks.repartition("rep", "depth").sortWithinPartitions("rep", "depth", "chunk").select("rep", "depth", "text").mapInArrow(_digested, "rep long, depth long, sha string")
        opened = keep(opened.join(digests, ["rep", "depth"], "left").select(F.col("rep").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha", F.lit(EMPTY)).alias("ends_sha256")))
    return opened.union(local.drop("at")).union(chain)


def _opened(levels: list[tuple[DataFrame, DataFrame]], local: DataFrame, root: int, total: int) -> DataFrame:
    """Open nodes with their sums, deepest first."""
    whole: Callable[[Column], Column] = lambda x: F.coalesce(x, F.lit(0)).cast("long")
    found: list[DataFrame] = []
    below = None
    for depth in range(len(levels) - 1, -1, -1):
        children = levels[depth][1]
        sums = [
            children.filter("n = 1 and not open").select("node", F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens")),
            children.filter("n > 1 and not open").join(local.filter((F.col("at") == depth + 1) & (F.col("depth") == depth + 1)), F.col("rep") == F.col("conv_id")).select("node", "n_leaves", "saved_tokens"),
        ]
        if below is not None:
            sums.append(children.filter("open").select("node", "rep").join(below.select("rep", "n_leaves", "saved_tokens"), "rep").select("node", "n_leaves", "saved_tokens"))
        sums = reduce(DataFrame.union, sums).groupBy("node").agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
        if depth:
            nodes = levels[depth - 1][1].filter("open").select("rep", F.col("node").alias("parent"), F.col("n").alias("n_convs"), ((F.col("n") - 1) * F.col("words")).alias("own"))
        else:
            nodes = local.sparkSession.createDataFrame([(root, None, total, 0)], "rep long, parent long, n_convs long, own long")
        below = written(
            nodes.join(sums, F.col("rep") == sums["node"], "left").select(
                "rep", F.lit(depth).cast("long").alias("depth"), "parent", "n_convs", whole("n_children").alias("n_children"), F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"), (F.col("own") + whole("saved_tokens")).alias("saved_tokens")
            )
        )
        found.append(below)
    return reduce(DataFrame.union, found)


def conversation_trie(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", build: Callable[[DataFrame], tuple[DataFrame, DataFrame]] = plain) -> DataFrame:
    """The trie's nodes: smallest member, depth, parent's smallest member, members, children, leaves below, tokens that
    sharing saves below, and the digest of the members that end here. ``build`` may rebuild the conversations first."""
    with intermediate(df.sparkSession) as keep:
        turns, convs = build(turn_ids(df, conv_col, turn_col, role_col, text_col))
        turns, convs = keep(turns), keep(convs)
    return trie(turns, convs)


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"), build=rebuilt)


ORACLE = rf"""
WITH own AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS i
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, c - c % 20 AS base, count(*) AS n, any_value({crc32_sql("hex(encode(c::VARCHAR))")}) % 4 AS h FROM own GROUP BY c
), turns AS (
  SELECT k.c, o.i + 1 AS d, o.role, o.text FROM convs k JOIN own o ON o.c = k.base AND o.i < k.h
  UNION ALL
  SELECT k.c, o.i - k.h + least(k.h, coalesce(b.n, 0)) + 1, o.role, o.text
  FROM convs k JOIN own o ON o.c = k.c AND o.i >= k.h LEFT JOIN convs b ON b.c = k.base
), paths AS (
  SELECT c, d, list({{'role': role, 'text': text}}) OVER (PARTITION BY c ORDER BY d) AS path FROM turns
  UNION ALL
  SELECT c, 0, [] FROM convs
), lens AS (
  SELECT c, max(d) AS len FROM paths GROUP BY c
), nodes AS (
  SELECT path, d AS depth, min(c) AS rep, count(*) AS n, string_agg(CASE WHEN d = len THEN c::VARCHAR END, ',' ORDER BY c) AS ends,
         (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(path[-1].text, '[^\x20\x09-\x0D]+')) END AS saved
  FROM paths JOIN lens USING (c) GROUP BY path, d
), kids AS (
  SELECT list_slice(path, 1, depth - 1) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
), below AS (
  SELECT list_slice(x.path, 1, x.k) AS path, sum(x.saved) AS saved, sum(CASE WHEN kids.n IS NULL THEN 1 ELSE 0 END) AS leaves
  FROM (SELECT path AS whole, path, saved, unnest(generate_series(0, depth)) AS k FROM nodes) x LEFT JOIN kids ON kids.path = x.whole GROUP BY 1
)
SELECT nodes.rep AS conv_id, nodes.depth::BIGINT AS depth, p.rep AS parent_conv_id, nodes.n AS n_convs, coalesce(kids.n, 0)::BIGINT AS n_children,
       below.leaves::BIGINT AS n_leaves, below.saved::BIGINT AS saved_tokens, sha256(coalesce(nodes.ends, '')) AS ends_sha256
FROM nodes JOIN below ON below.path = nodes.path LEFT JOIN kids ON kids.path = nodes.path
LEFT JOIN nodes p ON nodes.depth > 0 AND p.path = list_slice(nodes.path, 1, nodes.depth - 1)
"""
