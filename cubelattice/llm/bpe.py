"""Byte-level BPE by a tokenization automaton.

A state is the last token read, an arc the token that may follow it. The automaton of single bytes, where every
byte may follow every byte, is compiled merge by merge. The gadget of the merge u v -> t (``_gadget``):

1. state t gets the arcs that state v has now (after t stands what stood after v);
2. state u loses its arc v (there the merge has fired);
3. every state that now has an arc u gets an arc t (t stands where u stood before a v).

That order settles repeated tokens as well: of u u u the first two merge. The result is deterministic over token
labels and has exactly one path for the bytes of a text: its tokens. The ``TABLE`` earliest states, which take most
steps, have their arcs spelled out in a transition table, on which the gadgets work as written. For 50,000 states the
whole table would have 2.5 billion arcs, so a later gadget keeps what it copies from as a reference, and its arcs
are read through the references, down to the table, at the time of the gadget (arcs are only ever lost, so one that
is in the table was always there); what was read once is kept up to a size limit.

Words from the vocabulary's own splitter run through the tables: from every reached place, the labels of the arcs are
read along a trie, and one pass from left to right finds the last token of every prefix. Decoding emits the
labels of the arcs. Strings of special tokens inside a text become their ids, as the library does by default. Null
and empty texts have no ids and decode to an empty text. Long texts take memory in proportion to one text. Repeated
rows are encoded alike; null and repeated identifiers are carried along; other columns, whatever their names, take no
part. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubelattice.llm.common import quoted, table

#: Fixed value: the public splitter of byte-level BPE vocabularies.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORDS_KEPT = 400_000
LONGEST_KEPT = 64
ARCS_KEPT = 2_000_000
TABLE = 4096
NEVER = 1 << 40


def byte_letters() -> dict[str, int]:
    """The letters that vocabulary files use for bytes: printable ones for themselves, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Automaton:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        self.labels = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for word, n in vocab.items():
            self.labels[n] = bytes(letters[c] for c in word)
        for word, n in self.special.items():
            self.labels[n] = word.encode()
        self.decimals = [str(n) for n in range(len(self.labels))]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        # states are numbered as they are made: the single bytes, then one per merge
        self.ids = [vocab[c] for c in letters if c in vocab] + [vocab[u + v] for u, v in pairs]
        if len(set(self.ids)) != len(self.ids):
            raise ValueError("two merges make the same token")
        self.singles = len(self.ids) - len(pairs)
        self.state = {n: k for k, n in enumerate(self.ids)}
        self.parts: list[tuple[int, int] | None] = [None] * self.singles
        self.lost: dict[int, int] = {}  # arc -> the gadget that took it away
        self.reached = [True] * self.singles
        size = min(TABLE, len(self.ids))
        self.table = np.zeros((size, size), bool)
        self.table[: self.singles, : self.singles] = True
        self.rows: list[bytes] = []
        for u, v in pairs:
            self._gadget(self.state[vocab[u]], self.state[vocab[v]])
        self.rows = [row.tobytes() for row in self.table]
        del self.table
        self.trie: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        for k, n in enumerate(self.ids):
            if self.reached[k]:
                self._spell(k, self.labels[n])
        self.arcs: dict[int, bool] = {}
        self.words: dict[str, tuple[int, ...]] = {}
        self.find = regex.compile(SPLIT).findall
        self.cut = regex.compile("(" + "|".join(regex.escape(x) for x in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None

    def _gadget(self, u: int, v: int) -> None:
        """Add the state of the next merge, of u and v."""
        t, size = len(self.parts), len(self.table)
        fires = self.arc(u, v)
        if t < size and fires:
            self.table[t] = self.table[v]
        if u < size and v < size:
            self.table[u, v] = False
        if t < size and fires:
            self.table[:, t] = self.table[:, u]
        self.parts.append((u, v))
        self.reached.append(fires)
        self.lost.setdefault(u << 32 | v, t)

    def _spell(self, state: int, label: bytes) -> None:
        node = 0
        for b in label:
            to = self.trie[node].get(b)
            if to is None:
                to = self.trie[node][b] = len(self.trie)
                self.trie.append({})
                self.token.append(-1)
            node = to
        self.token[node] = state

    def arc(self, a: int, b: int, before: int = NEVER) -> bool:
        """Whether state a has the arc b before the gadget of state ``before`` works."""
        while True:
            gone = self.lost.get(a << 32 | b)
            if gone is not None and gone < before:
                return False
            most = max(a, b)
            if most < self.singles:
                return True
            if most < TABLE and (self.rows[a][b] if self.rows else self.table[a, b]):
                return True
            if not self.reached[most]:
                return False
            u, v = self.parts[most]
            if a == b:  # step 3 finds u among the arcs of the new state, which are those of v
                a, b, before = v, u, most
            elif a > b:
                a, before = v, most
            else:
                b, before = u, most + 1

    def word(self, body: bytes) -> tuple[int, ...]:
        """Ids of one pre-split word."""
        n, size = len(body), len(self.rows)
        last = [-1] * (n + 1)
        trie, token, arcs, rows = self.trie, self.token, self.arcs, self.rows
        for j in range(n):
            a = last[j]
            if j and a < 0:
                continue
            node = 0
            for i in range(j, n):
                node = trie[node].get(body[i], -1)
                if node < 0:
                    break
                b = token[node]
                if b < 0 or last[i + 1] >= 0:
                    continue
                if j:
                    if a < size and b < size:
                        ok = rows[a][b]
                    else:
                        key = a << 32 | b
                        ok = arcs.get(key)
                        if ok is None:
                            if len(arcs) >= ARCS_KEPT:
                                arcs.clear()
                            ok = arcs[key] = self.arc(a, b)
                    if not ok:
                        continue
                last[i + 1] = b
        out = []
        while n:
            out.append(self.ids[last[n]])
            n -= len(self.labels[out[-1]])
        return tuple(reversed(out))

    def _plain(self, text: str) -> list[int]:
        words = self.words
        split = self.find(text)
        try:
            return list(chain.from_iterable(map(words.__getitem__, split)))
        except KeyError:
            pass
        out: list[int] = []
        for w in split:
            ids = words.get(w)
            if ids is None:
                ids = self.word(w.encode())
                if len(w) <= LONGEST_KEPT:
                    if len(words) >= WORDS_KEPT:
                        words.clear()
                    words[w] = ids
            out += ids
        return out

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if self.cut is None or not self.cut.search(text):
            return self._plain(text)
        out: list[int] = []
        for part in self.cut.split(text):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out += self._plain(part)
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(4)
def automaton(path: str) -> Automaton:
    """One automaton per vocabulary and worker process."""
    return Automaton(path)


def encode_texts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Identifier, ids (array of int) and decoded text per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(path)
        for batch in batches:
            ids = [machine.encode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([machine.decode(x) for x in ids], pa.string())], names=["id", "ids", "decoded"])

    found = df.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).cast("string").alias("text")).mapInArrow(run, "id long, ids array<int>, decoded string")
    return found.withColumnRenamed("id", id_col)


def digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Identifier, n_tokens, ids_sha256, decoded_sha256 per row; ids and texts do not leave the worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(path)
        decimals = machine.decimals
        for batch in batches:
            sizes, ids_sha, text_sha = [], [], []
            for text in batch.column(1):
                ids = machine.encode(text.as_py())
                sizes.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join(map(decimals.__getitem__, ids)).encode()).hexdigest())
                text_sha.append(hashlib.sha256(machine.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    found = df.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).cast("string").alias("text")).mapInArrow(run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return found.withColumnRenamed("id", id_col)


def op9_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
