"""Best-fit packing by sums of squares.

Texts are tokenized and cut into pieces of at most ``size`` tokens; of a longer document all pieces but
the first are full. Pieces are dealt at random into groups of about ``GROUP`` pieces, by their number in the
stored table, so that null or repeated identifiers do not gather in one group. Each group is packed on its own,
largest piece first: a piece goes to the open sequence whose use makes the sum of the squared counts of open
sequences per residual gap smallest (of equals, to the smallest gap). Two departures from the online rule, for
fewer sequences: pieces come largest first, and a new sequence is no candidate while an open one fits. A group's
state is one counter and one stack per gap. Groups of this size have the whole corpus's length distribution, so
dealing costs a fraction of a sequence each.

The ids are those of the ``tokenizers`` file; they are computed by the ``tiktoken`` library over the same
ranks, which gives the same ids several times faster (tests compare both), where the file's ids follow
its merge order (a text with about a million blanks in a row, which its splitter cannot read, goes through operator 9's automaton),
else by ``tokenizers`` itself. Null and empty texts have the end id alone. Rows that
repeat an identifier are packed separately. A text's ids must fit in memory, however long it is. An empty table
gives an empty result; other columns, whatever their names, take no part.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubelattice.llm.bpe import SPLIT, automaton, byte_letters
from cubelattice.llm.common import table, written

SIZE = 1024
END = 2
GROUP = 16_384
TASKS = 4096
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def encoder(path: str) -> Callable[[str], list[int]]:
    return encoders(path)[0]


@lru_cache(4)
def encoders(path: str) -> tuple[Callable[[str], list[int]], Callable[[str], np.ndarray]]:
    """Functions that give a text's ids as a list and as an array."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    letters, vocab = byte_letters(), spec["model"]["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    in_order = all(vocab.get(u + v) == 256 + n for n, (u, v) in enumerate(pairs)) and sum(len(w) == 1 for w in vocab) == 256
    if not in_order or spec["normalizer"] or spec["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        return lambda text: whole.encode(text, add_special_tokens=False).ids, lambda text: np.array(whole.encode(text, add_special_tokens=False).ids, np.uint32)
    import tiktoken

    special = {x["content"]: x["id"] for x in spec["added_tokens"]}
    ranks = {bytes(letters[c] for c in w): n for w, n in vocab.items() if w not in special}
    fast = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> list[int]:
        try:
            return fast.encode(text, allowed_special="all")
        except ValueError:  # a run of white space on which the library's splitter runs out of stack
            return automaton(path).encode(text)

    def encode_array(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            return np.array(automaton(path).encode(text), np.uint32)

    return encode, encode_array


def pieces(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            rows = []
            for ident, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encode(text.as_py() or ""), end], "<u4")
                bounds = [0, *range(len(ids) % size or size, len(ids) + 1, size)] if len(ids) > size else [0, len(ids)]
                rows += [(ident, n, a, b - a, zlib.crc32(ids[a:b].tobytes())) for n, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def place(lengths: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece of one group."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    count = np.zeros(size + 1, np.int64)  # of open sequences per gap
    stacks: list[list[int]] = [[] for _ in range(size + 1)]
    opened = 0
    for k in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[k])
        fits = count[n:size]
        if n < size and fits.any():
            # change of the sum of squares, halved; a sequence that gets full leaves it
            change = np.where(fits > 0, count[: size - n] - fits + 1.0, np.inf)
            if fits[0]:
                change[0] = 0.5 - fits[0]
            gap = n + int(change.argmin())
            s = stacks[gap].pop()
            count[gap] -= 1
        else:
            gap, s = size, opened
            opened += 1
        sequence[k], offset[k] = s, size - gap
        if gap > n:
            stacks[gap - n].append(s)
            count[gap - n] += 1
    return sequence, offset


def pack(cut: DataFrame, size: int = SIZE, group: int = GROUP) -> DataFrame:
    """Pieces, as a stored table -> pieces with sequence_id and offset."""
    groups = max(1, -(-cut.count() // group))
    tasks = min(groups, TASKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out() -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(held).combine_chunks()
            g = whole.column("g")[0].as_py()
            sequence, offset = place(whole.column("length").to_numpy(), size)
            whole = whole.drop_columns(["g"]).append_column("sequence_id", pa.array((np.int64(g) << 32) + sequence)).append_column("offset", pa.array(offset))
            yield from whole.to_batches()

        for batch in batches:
            g = batch.column(0).to_numpy()
            for part in np.split(np.arange(len(g)), np.flatnonzero(g[1:] != g[:-1]) + 1) if len(g) else []:
                rows = batch.slice(int(part[0]), len(part))
                if held and held[-1].column(0)[0].as_py() != g[part[0]]:
                    yield from out()
                    held = []
                held.append(rows)
        if held:
            yield from out()

    dealt = cut.select(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).alias("g"), "*")
    dealt = dealt.repartitionById(tasks, F.pmod("g", F.lit(tasks)).cast("int")).sortWithinPartitions("g")
    return dealt.mapInArrow(run, PACKED)


def pack_texts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, end: int = END) -> DataFrame:
    packed = pack(written(pieces(df, path, id_col, text_col, size, end)), size)
    return packed.withColumnRenamed("doc_id", id_col)


def op2_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
