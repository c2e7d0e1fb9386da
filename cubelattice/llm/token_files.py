"""Token files: a wavelet matrix per shard.

The ids of all documents, each followed by an end id, are one sequence in ascending order of the identifier. It is cut
between documents into shards of at least ``SHARD`` ids (the last of a task may have fewer), and a shard is one file
body (``WaveletMatrix.to_bytes``) that holds:

* ``MAGIC``, then as little-endian 64-bit numbers the ids, the bits of an id, and the documents;
* the documents' lengths (little-endian 32-bit, 2^32 - 1 where a 64-bit length stands behind them);
* the planes, from the highest bit of the ids to the lowest: the number of zeros (64 bits), the ones before each
  block of ``BLOCK`` bits (32 bits each), and the bits. The ids of the next plane are those with a zero, then
  those with a one, both in their order.

Bits before a place are counted by the block's number and at most ``BLOCK`` bits. So from the one body, without
unpacking the ids: ``access`` gives the id at a place, ``rank`` the number of times that an id stands before a place,
``select`` the place of its k-th time, ``count`` its times in a range; ``ids`` gives all of them.

Documents are range partitioned by identifier, then by length and hash of the text and the row's number, so rows
that repeat an identifier, or have none (they come first), are cut among tasks. Tasks encode and write their
shards as rows of one Parquet table (compressed by Zstandard), with identifiers, so that files appear by Spark's committer on
any store. Readers decode one shard at a time; a place counts from the start of the corpus, the sum of the shards
before.

Ids come from ``packing.encoders``. Null and empty texts have the end id alone. Repeated rows are documents of their
own. A text's ids must fit in memory, however long it is; it is never cut among shards. Empty tables give empty files
and results; other columns, whatever their names, take no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cubelattice.llm.common import new_folder, quoted, table
from cubelattice.llm.packing import encoders

MAGIC = b"WMX1"
SHARD = 1 << 20
PART = 1 << 23
END = 0
BLOCK = 512
WORDS = BLOCK // 8
LONG = (1 << 32) - 1
FILE = "part int, file int, n_tokens long, doc_ids array<long>, body binary"


class WaveletMatrix:
    def __init__(self, size: int, lengths: np.ndarray, planes: list[tuple[int, np.ndarray, np.ndarray]]):
        self.size, self.lengths, self.planes = size, lengths, planes  # of a plane: zeros, ones before blocks, packed bits

    @classmethod
    def of(cls, ids: np.ndarray, lengths: np.ndarray) -> WaveletMatrix:
        planes = []
        bits = max(1, int(ids.max(initial=0)).bit_length())
        kind = np.uint16 if bits <= 16 else np.uint32
        ids = ids.astype(kind)
        for bit in range(bits - 1, -1, -1):
            one = (ids & kind(1 << bit)) != 0
            packed = np.packbits(one, bitorder="little")
            packed = np.concatenate([packed, np.zeros(-len(packed) % WORDS, np.uint8)])
            inside = np.bitwise_count(packed.reshape(-1, WORDS)).sum(1, dtype=np.uint32)
            planes.append((len(ids) - int(inside.sum()), np.concatenate([[0], np.cumsum(inside)]).astype("<u4"), packed))
            ids = np.concatenate([ids[~one], ids[one]])
        return cls(len(ids), lengths.astype(np.int64), planes)

    def to_bytes(self) -> bytes:
        parts = [MAGIC, np.array([self.size, len(self.planes), len(self.lengths)], "<i8").tobytes(), np.minimum(self.lengths, LONG).astype("<u4").tobytes(), self.lengths[self.lengths >= LONG].astype("<i8").tobytes()]
        for zeros, before, bits in self.planes:
            parts += [np.array([zeros], "<i8").tobytes(), before.tobytes(), bits.tobytes()]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, body: bytes) -> WaveletMatrix:
        if body[:4] != MAGIC:
            raise ValueError("this is no token file")
        at = 4

        def take(n: int, kind: str) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(body, kind, n, at)
            at += found.nbytes
            return found

        size, bits, docs = take(3, "<i8").tolist()
        lengths = take(docs, "<u4").astype(np.int64)
        lengths[lengths == LONG] = take(int((lengths == LONG).sum()), "<i8")
        blocks = -(-size // BLOCK)
        return cls(size, lengths, [(int(take(1, "<i8")[0]), take(blocks + 1, "<u4"), take(blocks * WORDS, "u1")) for _ in range(bits)])

    @staticmethod
    def _ones(plane: tuple[int, np.ndarray, np.ndarray], at: int) -> int:
        """Ones before a place of a plane."""
        _, before, bits = plane
        block, rest = divmod(at, BLOCK)
        found = int(before[block])
        if rest:
            here = bits[block * WORDS : block * WORDS + (rest + 7) // 8]
            found += int(np.bitwise_count(here).sum())
            if rest % 8:
                found -= (int(here[-1]) >> rest % 8).bit_count()
        return found

    def access(self, at: int) -> int:
        """The id at a place."""
        if not 0 <= at < self.size:
            raise IndexError(at)
        found = 0
        for plane in self.planes:
            one = int(plane[2][at >> 3]) >> (at & 7) & 1
            ones = self._ones(plane, at)
            at = plane[0] + ones if one else at - ones
            found = found << 1 | one
        return found

    def _bits(self, ident: int) -> list[int] | None:
        n = len(self.planes)
        return [ident >> k & 1 for k in range(n - 1, -1, -1)] if 0 <= ident < 1 << n else None

    def rank(self, ident: int, at: int) -> int:
        """How often an id stands before a place."""
        return self.count(ident, 0, at)

    def count(self, ident: int, start: int = 0, stop: int | None = None) -> int:
        """How often an id stands in a range of places."""
        a, b = max(0, start), self.size if stop is None else min(stop, self.size)
        bits = self._bits(ident)
        if bits is None or a >= b:
            return 0
        for one, plane in zip(bits, self.planes, strict=True):
            x, y = self._ones(plane, a), self._ones(plane, b)
            a, b = (plane[0] + x, plane[0] + y) if one else (a - x, b - y)
        return b - a

    def select(self, ident: int, k: int) -> int:
        """The place of an id's k-th time, from 0; -1 where it stands less often."""
        return (self.places(ident, k, k + 1) or [-1])[0]

    def places(self, ident: int, first: int = 0, last: int | None = None) -> list[int]:
        """The places of an id's times ``first`` to ``last`` (all of them by default), ascending."""
        bits = self._bits(ident)
        if bits is None or not self.size:
            return []
        a, b = 0, self.size
        for one, plane in zip(bits, self.planes, strict=True):
            x, y = self._ones(plane, a), self._ones(plane, b)
            a, b = (plane[0] + x, plane[0] + y) if one else (a - x, b - y)
        at = np.arange(a, b)[first:last]
        for one, (zeros, before, packed) in zip(reversed(bits), reversed(self.planes), strict=True):
            if not len(at):
                break
            # the place of the k-th one (or zero) of the plane: its block, then its bit
            k = at - zeros if one else at
            upto = before if one else np.arange(len(before), dtype=np.int64) * BLOCK - before
            block = np.searchsorted(upto, k, side="right") - 1
            held = packed.reshape(-1, WORDS)[block]
            inside = np.cumsum(np.unpackbits(held if one else ~held, axis=1, bitorder="little"), axis=1, dtype=np.int16)
            at = block * BLOCK + (inside <= (k - upto[block])[:, None]).sum(1)
        return at.tolist()

    def ids(self) -> np.ndarray:
        """All ids, from the lowest plane up."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        out = np.zeros(self.size, kind)
        for bit, (zeros, _, packed) in enumerate(reversed(self.planes)):
            one = np.unpackbits(packed, count=self.size, bitorder="little").view(bool)
            above = np.empty(self.size, kind)
            above[~one], above[one] = out[:zeros], out[zeros:] | kind(1 << bit)
            out = above
        return out.astype(np.uint32)


def write_token_files(df: DataFrame, path: str, vocab: str, id_col: str = "doc_id", text_col: str = "text", end: int = END, shard: int = SHARD, part: int = PART) -> None:
    """Encode the texts of all rows and write the shards to a folder; tasks take texts of about ``part`` bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last = encoders(vocab)[1], np.array([end], np.uint32)
        idents, ids, held, file = [], [], 0, 0

        def out(at: int) -> pa.RecordBatch:
            body = WaveletMatrix.of(np.concatenate(ids), np.fromiter(map(len, ids), np.int64, len(ids))).to_bytes()
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([file], pa.int32()), pa.array([held]), pa.array([idents], pa.list_(pa.int64())), pa.array([body], pa.binary())], names=["part", "file", "n_tokens", "doc_ids", "body"])

        at = 0
        for batch in batches:
            for ident, text, at in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):  # noqa: B007
                idents.append(ident)
                ids.append(np.concatenate([encode(text.as_py() or ""), last]))
                held += len(ids[-1])
                if held >= shard:
                    yield out(at)
                    idents, ids, held, file = [], [], 0, file + 1
        if ids:
            yield out(at)

    texts = df.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).cast("string").alias("text"))
    size = texts.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0
    order = ["id", "size", "hash", "row"]
    keyed = texts.withColumns({"size": F.octet_length("text"), "hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    dealt = keyed.repartitionByRange(max(1, -(-size // part)), *order).sortWithinPartitions(*order)
    dealt.select("id", "text", F.spark_partition_id().alias("part")).mapInArrow(run, FILE).write.option("compression", "zstd").parquet(path)


def _shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILE).parquet(path)


def _starts(shards: DataFrame) -> DataFrame:
    """(part, file, before): the ids before each shard. Totals go over parts, then over thousands of parts."""
    own = Window.partitionBy("part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    sizes = shards.select("part", "file", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn("many", F.shiftright("part", 10))
    many = parts.groupBy("many").agg(F.sum("n").alias("n")).select("many", F.coalesce(F.sum("n").over(Window.orderBy("many").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("a"))
    inside = Window.partitionBy("many").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", "many", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("b")).join(many, "many")
    return sizes.select("part", "file", F.coalesce(F.sum("n_tokens").over(own), F.lit(0)).alias("c")).join(parts, "part").select("part", "file", (F.col("a") + F.col("b") + F.col("c")).alias("before"))


def read_documents(spark: SparkSession, path: str, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32), and ids as an array if asked for, of every document in the files."""
    names = ["part", "file", "id", "at", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int64())] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                matrix = WaveletMatrix.from_bytes(batch.column(3)[row].as_buffer().to_pybytes())
                ids, n = matrix.ids().astype("<u4"), len(matrix.lengths)
                ends = np.cumsum(matrix.lengths)
                own = [ids[a:b] for a, b in zip((ends - matrix.lengths).tolist(), ends.tolist(), strict=True)]
                columns = [[batch.column(0)[row].as_py()] * n, [batch.column(1)[row].as_py()] * n, batch.column(2)[row].as_py(), ends - matrix.lengths, matrix.lengths, [zlib.crc32(x.tobytes()) for x in own]]
                columns += [[x.tolist() for x in own]] * with_ids
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    shards = _shards(spark, path)
    schema = "part int, file int, id long, at long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    found = shards.select("part", "file", "doc_ids", "body").mapInArrow(run, schema).join(_starts(shards), ["part", "file"])
    return found.select(F.col("id").alias(id_col), (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def find_tokens(spark: SparkSession, path: str, idents: list[int], id_col: str = "doc_id") -> DataFrame:
    """(id, doc_id, start, at): every place of the given ids, counted from the start of the corpus and from that of its
    document. Only the ids asked for are looked up; the sequence is not unpacked."""
    wanted = sorted(set(idents))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                matrix = WaveletMatrix.from_bytes(batch.column(3)[row].as_buffer().to_pybytes())
                docs, ends = batch.column(2)[row].as_py(), np.cumsum(matrix.lengths)
                for ident in wanted:
                    at = np.array(matrix.places(ident), np.int64)
                    doc = np.searchsorted(ends, at, side="right")
                    inside = at - (ends - matrix.lengths)[doc]
                    columns = [batch.column(0)[row].as_py(), batch.column(1)[row].as_py(), ident]
                    yield pa.RecordBatch.from_arrays([*(pa.array([c] * len(at), k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.int64()), strict=True)), pa.array([docs[d] for d in doc.tolist()], pa.int64()), pa.array(at), pa.array(inside)], names=["part", "file", "id", "doc", "place", "at"])

    shards = _shards(spark, path)
    found = shards.select("part", "file", "doc_ids", "body").mapInArrow(run, "part int, file int, id long, doc long, place long, at long")
    return found.join(_starts(shards), ["part", "file"]).select("id", F.col("doc").alias(id_col), (F.col("before") + F.col("place")).alias("start"), "at")


def count_tokens(spark: SparkSession, path: str, idents: list[int]) -> DataFrame:
    """(id, n): how often each given id stands in the files, by the planes' counts alone."""
    wanted = sorted(set(idents))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column(0):
                matrix = WaveletMatrix.from_bytes(body.as_buffer().to_pybytes())
                yield pa.RecordBatch.from_arrays([pa.array(wanted, pa.int64()), pa.array([matrix.count(x) for x in wanted], pa.int64())], names=["id", "n"])

    return _shards(spark, path).select("body").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def op11_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = new_folder(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_documents(spark, path)
