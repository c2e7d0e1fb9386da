"""Exact deduplication with Patricia-trie owners.

1. Each input task folds its rows into compressed radix tries, one per byte length; a terminal node keeps
   the owner (smallest or largest identifier) and the number of rows. A task passes on one row per
   distinct text it has seen, so a text with a third of all rows crosses the shuffle once per task.
2. Those rows are dealt by (byte length, content hash) and folded into the owning tries, which compare
   whole byte strings. A trie over its memory budget spills its heaviest subtree to an unnamed
   temporary file in Spark's local folder that only this task reads and that goes with it (at most the
   bytes of the task's distinct texts); spilled subtrees are folded again, one at a time, so memory stays
   bounded by the budget and the longest text. A lost executor's task starts anew on another one.
3. The owners of repeated texts are joined back by digest to (identifier, digest) rows. Both inputs of
   that join are plain exchanges, so adaptive execution splits a hot digest.

Nulls count as empty texts; empty texts are equal to each other. Rows without identifier count in
``group_size`` and never own a text unless no row of it has one (then ``keep_id`` is null and none is
kept). Rows that repeat an identifier and its text are the same row and share its fate. An empty table
gives an empty result. Other columns of the input, whatever their names, take no part.
"""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubelattice.llm.common import lower_ascii, quoted, table, task_dir, written

FOLD_BYTES = 48 << 20
TRIE_BYTES = 160 << 20
NODE_BYTES = 260
FOLDED = "length long, hash long, digest binary, body binary, owner long, rows long"
OWNED = "digest binary, owner long, rows long"


class Node:
    __slots__ = ("children", "file", "label", "terminal")

    def __init__(self, label: bytes, terminal: list | None = None):
        self.label, self.terminal, self.children, self.file = label, terminal, {}, None


def shared_prefix(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by bisection over slice comparisons."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


class RadixTrie:
    """Byte strings -> [owner, rows, payload], compressed; spills by subtree beyond ``budget`` bytes."""

    def __init__(self, pick=min, budget: int = TRIE_BYTES):
        self.pick, self.budget, self.held, self.root = pick, budget, 0, Node(b"")

    def insert(self, key: bytes, owner: int | None, rows: int, payload: bytes) -> None:
        node, at = self.root, 0
        while True:
            if node.file is not None:
                pickle.dump((key[at:], owner, rows, payload), node.file)
                return
            if at == len(key):
                self._merge(node, owner, rows, payload)
                return
            child = node.children.get(key[at])
            if child is None:
                node.children[key[at]] = Node(key[at:], [owner, rows, payload])
                self.held += len(key) - at + NODE_BYTES
                break
            if key.startswith(child.label, at):
                node, at = child, at + len(child.label)
                continue
            cut = shared_prefix(child.label, key[at:])
            fork = Node(child.label[:cut])
            child.label = child.label[cut:]
            fork.children[child.label[0]] = child
            node.children[key[at]] = fork
            self.held += NODE_BYTES
            node, at = fork, at + cut
        if self.held > self.budget:
            self._spill()

    def _merge(self, node: Node, owner: int | None, rows: int, payload: bytes) -> None:
        if node.terminal is None:
            node.terminal = [owner, rows, payload]
            return
        held = node.terminal
        held[0] = owner if held[0] is None else held[0] if owner is None else self.pick(held[0], owner)
        held[1] += rows

    @staticmethod
    def _subtree(node: Node) -> Iterator[tuple[bytes, Node]]:
        stack = [(b"", node)]
        while stack:
            path, x = stack.pop()
            yield path, x
            stack += [(path + c.label, c) for c in x.children.values()]

    def _spill(self) -> None:
        """Move the heaviest child of the first branching node to a file; a trie of one chain stays."""
        node = self.root
        while len(node.children) == 1 and node.terminal is None:
            node = next(iter(node.children.values()))
        weights = [(sum(len(x.label) + NODE_BYTES for _, x in self._subtree(c) if x.file is None), k) for k, c in node.children.items() if c.file is None]
        if not weights or node is self.root and len(node.children) == 1:
            return
        weight, k = max(weights)
        child, file = node.children[k], tempfile.TemporaryFile(dir=task_dir())
        for path, x in self._subtree(child):
            if x.terminal is not None:
                pickle.dump((path, *x.terminal), file)
            if x.file is not None:
                for rest, *terminal in _records(x.file):
                    pickle.dump((path + rest, *terminal), file)
        child.children, child.terminal, child.file = {}, None, file
        self.held -= weight

    def terminals(self) -> Iterator[list]:
        """[owner, rows, payload] of each distinct string; spilled subtrees follow, one in memory at a time."""
        stack, spilled = [self.root], []
        while stack:
            node = stack.pop()
            if node.terminal is not None:
                yield node.terminal
            if node.file is not None:
                spilled.append(node.file)
            stack += node.children.values()
        self.root, self.held = Node(b""), 0
        for file in spilled:
            inner = RadixTrie(self.pick, self.budget)
            for record in _records(file):
                inner.insert(*record)
            yield from inner.terminals()


def _records(file) -> Iterator[tuple]:
    file.seek(0)
    try:
        while True:
            yield pickle.load(file)
    except EOFError:
        file.close()


def _fold(pick):
    """Input rows -> one row per distinct text of the task (or of a part of it, where memory is short)."""
    schema = pa.schema([("length", pa.int64()), ("hash", pa.int64()), ("digest", pa.binary()), ("body", pa.binary()), ("owner", pa.int64()), ("rows", pa.int64())])

    def drain(tries: dict[int, RadixTrie]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for length, trie in tries.items():
            for owner, n, (body, digest, code) in trie.terminals():
                rows.append((length, code, digest, body, owner, n))
                held += length
                if held > FOLD_BYTES // 4 or len(rows) >= 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries: dict[int, RadixTrie] = {}
        held = 0
        for batch in batches:
            for ident, body, digest, code in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                trie = tries.get(len(body))
                if trie is None:
                    trie = tries[len(body)] = RadixTrie(pick, 1 << 62)
                before = trie.held
                trie.insert(body, ident, 1, (body, digest, code))
                held += 2 * (trie.held - before)
                if held > FOLD_BYTES:
                    yield from drain(tries)
                    tries, held = {}, 0
        yield from drain(tries)

    return run


def _own(pick, budget: int):
    """Rows of whole (length, hash) partitions -> one row per distinct text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = RadixTrie(pick, budget)
        for batch in batches:
            for digest, body, owner, rows in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # texts of one length are never prefixes of each other; the length leads, so lengths stay apart
                trie.insert(len(body).to_bytes(8, "big") + body, owner, rows, digest)
        out = []
        for owner, rows, digest in trie.terminals():
            out.append((digest, owner, rows))
            if len(out) == 20_000:
                yield _owned(out)
                out = []
        if out:
            yield _owned(out)

    return run


def _owned(rows: list[tuple]) -> pa.RecordBatch:
    digest, owner, n = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(digest, pa.binary()), pa.array(owner, pa.int64()), pa.array(n, pa.int64())], names=["digest", "owner", "rows"])


def owners(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", budget: int = TRIE_BYTES) -> DataFrame:
    """(digest, owner, rows) of every distinct text; digest is the SHA-256 of the normalised UTF-8 bytes."""
    pick = {"smallest": min, "largest": max}[keep]
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.encode(lower_ascii(F.col(text_col)), "UTF-8").alias("body"))
    rows = rows.select("id", "body", F.unhex(F.sha2("body", 256)).alias("digest"), F.xxhash64("body").alias("hash"))
    folded = rows.mapInArrow(_fold(pick), FOLDED)
    return folded.repartition("length", "hash").select("digest", "body", "owner", "rows").mapInArrow(_own(pick, budget), OWNED)


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """One row per input row: identifier, keep_id, group_size, kept, text_sha256."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.unhex(F.sha2(F.encode(lower_ascii(F.col(text_col)), "UTF-8"), 256)).alias("digest"))
    groups = owners(df, id_col, text_col, keep).filter("rows > 1")
    joined = rows.join(groups, "digest", "left")
    keep_id = F.when(F.col("rows").isNull(), F.col("id")).otherwise(F.col("owner"))
    return joined.select(
        F.col("id").alias(id_col),
        keep_id.alias("keep_id"),
        F.coalesce("rows", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(keep_id == F.col("id"), F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The input's rows that own their text, all columns; rows without identifier stay, and meet nowhere. Rows are told by
    identifier and text, and of rows that repeat both one stays: the first one that each task has goes on, and of these
    the first. Rows that repeat nothing are not aggregated."""
    key = quoted(id_col)
    found = written(exact_duplicates(df.filter(key.isNotNull()), id_col, text_col, keep).select(key.alias("_id"), F.col("text_sha256").alias("_text"), "kept"))
    keys = ["_id", "_text"]
    # one row of those that repeat identifier and text: aggregated before and after the shuffle
    repeated = written(found.filter("kept").groupBy(*keys).count().filter("count > 1").select(*keys))
    lost = found.filter("not kept").select(*keys).union(repeated).distinct()
    own = F.struct(*[quoted(c) for c in df.columns]).alias("_row")
    rows = df.select(own, key.cast("long").alias("_id"), F.sha2(F.encode(lower_ascii(F.col(text_col)), "UTF-8"), 256).alias("_text"))
    left = rows.filter("_id is not null").join(lost.hint("merge"), keys, "left_anti").select("_row")
    left = left.unionByName(rows.filter("_id is null").select("_row"))
    if not repeated.isEmpty():
        left = left.unionByName(rows.join(repeated, keys, "left_semi").groupBy(*keys).agg(F.first("_row").alias("_row")).select("_row"))
    return left.select("_row.*")


def op1_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")


ORACLE = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents
)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY body) AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       coalesce(doc_id = max(doc_id) OVER (PARTITION BY body), false) AS kept,
       sha256(body) AS text_sha256
FROM t
"""
