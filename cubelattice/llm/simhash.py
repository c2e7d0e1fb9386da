"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Fingerprints that differ in at most 4 of 64 bits differ in at most 4 of their 8 bytes, so they share at
least 4 (position, byte) entries: the guaranteed minimum. Postings of single bytes would be as long as
the corpus, so the index holds the triples of byte positions of a Turán system: of the 20 triples, at
least one lies inside any 4 positions. Beyond ``SHORT_KEYS`` fingerprints it holds all 70 sets of 4 positions,
so that the lists of unlike texts stay short as the corpus grows; no link is lost either way. A posting list is dealt to one task, which tallies the equal
bytes of each pair in it, retains pairs with 4 or more, verifies the differing bits, and passes on a
spanning forest of the links (never the pairs). Posting lists over ``BLOCK`` entries are cut into
blocks, and every pair of blocks becomes a list of its own, so no task holds an unbounded list and no
pair is lost. Connected components of the forests give the groups.

``drop_near_duplicates`` looks for a shingle similarity (shared over all distinct shingles) of 0.8 or more
instead of a few bits. It takes five-word shingles, without repeats, and fingerprints of four 64-bit words;
at similarity 0.8 about 39 of 256 bits differ (deviation 6). The index then holds pairs of positions: the 32
positions form ``CLASSES`` classes and every pair inside a class is a key (beyond ``SHORT_WIDE_KEYS`` fingerprints
the 64 triples of ``SPARSE`` are, so that lists do not grow with the corpus). Texts that share a list are tallied:
``WIDE_SHARED`` equal bytes and at most ``WIDE_BITS`` differing bits make them candidates (at 0.8 there are 8.6
equal bytes in the mean; two unlike texts have one or two). Candidates form coarse groups; the distinct texts of a
coarse group then meet in one task (or, beyond ``BLOCK_BYTES`` of text or ``BLOCK_TEXTS`` texts, in one task per
pair of blocks), where every pair within ``WIDE_BITS`` that is not connected yet is verified by its shingle sets
(64-bit hashes). Only verified links make groups. A similarity of 0.8 guarantees no number of equal bytes, so what
this way loses, an exact one finds (``missed``): of n shingles in one order for all texts, two texts at 0.8 or more
share one among their first n - ceil(0.8 n) + 1. Texts of different groups that share such a shingle are compared
by bounds that no pair at 0.8 breaks (sizes, place of the shingle, parities and counts of shingles per class), and
what is left is verified like the others, without ``WIDE_BITS``. The order puts shingles that are frequent in a
sample last, and rows that meet in lists over ``LONG`` rows nevertheless get prefixes in the order of exact counts, so
that a family of texts just below 0.8 breaks the bounds; orders decide the cost, never the result.

Words are runs of anything but space and the ASCII controls 9-13; A-Z is lower-cased; shingles repeat.
A text of fewer words than a shingle is one shingle; a text without words (null, empty, blank) has
fingerprint 0 and links like any other. Equal fingerprints are one node, represented by the smallest
identifier. Rows whose fingerprint no identified row has get a null component. Repeated rows and ties
share a component. An empty table gives an empty result. Texts are read whole, one row of a batch at a time,
however long. Other columns, whatever their names, take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubelattice.llm.common import IdFilter, intermediate, quoted, table, written
from cubelattice.llm.components import components

BITS = 4
BLOCK = 2048
SHORT = 65
FOREST = 200_000


def _triples() -> list[tuple[int, int, int]]:
    """Turán's construction: three classes in a ring; triples inside a class, or two of one and one of the next."""
    part = {p: p * 3 // 8 for p in range(8)}
    found = []
    for t in combinations(range(8), 3):
        of = [part[p] for p in t]
        if len(set(of)) == 1 or any(of.count(c) == 2 and (c + 1) % 3 in of for c in set(of)):
            found.append(t)
    return found


CLASSES = 6


def _pairs() -> list[tuple[int, int]]:
    """All pairs inside the classes of 32 positions."""
    part = [p * CLASSES // 32 for p in range(32)]
    return [(a, b) for a, b in combinations(range(32), 2) if part[a] == part[b]]


TRIPLES = _triples()
FOURS = list(combinations(range(8), 4))
PAIRS = _pairs()
#: Of 32 positions, each with others at two pairs of distances.
SPARSE = [tuple(sorted((p + d) % 32 for d in (0, *step))) for step in ((1, 9), (5, 18)) for p in range(32)]
#: Distinct fingerprints up to which the shorter keys are taken: a list of unlike ones then has 16 entries in the mean.
SHORT_KEYS, SHORT_WIDE_KEYS = 1 << 28, 1 << 20
WIDE = 4
WIDE_BITS = 60
WIDE_SHARED = 4
WIDE_SHINGLE = 5
#: Similarity of shingle sets from which texts are near copies, as a fraction.
SIMILAR = (4, 5)
BLOCK_BYTES = 16 << 20
BLOCK_TEXTS = 512
#: The frequent shingles of one row in ``SAMPLED`` come last in the order of prefixes; ``COMMON`` of them at most.
SAMPLED = 16
COMMON = 1 << 16
COUNTS = 256
#: Rows of a prefix shingle up to which its list is compared where the postings meet.
LONG = 64
#: Numbers of rows that have a shingle are told apart up to this one.
MOST_COUNTED = 1 << 16
POSTING = "key long, kind int, rep long, component long, other long, n int, pos int, parity long"
#: Odd constants that turn one hash into further ones.
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def spread(h: np.ndarray, width: int) -> np.ndarray:
    """hashes -> hashes x width words; the first word is the hash itself."""
    out = np.empty((len(h), width), np.uint64)
    out[:, 0] = h
    for k in range(1, width):
        x = h + np.uint64(k * MIX[0] & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[1])
        x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[2])
        out[:, k] = x ^ (x >> np.uint64(31))
    return out


def hashes(text: str | None, shingle: int) -> np.ndarray:
    """Unsigned hash of every shingle, repeats included; none for a text without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    flat = b" ".join(words)
    if len(words) <= shingle:
        grams = [flat]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        grams = [flat[i:j] for i, j in zip((ends - sizes)[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist(), strict=True)]
    return np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(42)), np.uint64, len(grams))


def fold(grams: np.ndarray, width: int) -> np.ndarray:
    """Fingerprint of shingle hashes: ``width`` words of 64 bits, unsigned."""
    total = np.zeros(64 * width, np.int64)
    for at in range(0, len(grams), 1 << 14):
        h = spread(grams[at : at + (1 << 14)], width)
        total += np.unpackbits(h.view(np.uint8).reshape(len(h), -1), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(total * 2 > len(grams), bitorder="little").view(np.uint64)


def fingerprint(text: str | None, shingle: int = 4, width: int = 1) -> np.ndarray:
    """Of a text; several words count every shingle once."""
    grams = hashes(text, shingle)
    return fold(np.unique(grams) if width > 1 else grams, width)


def alike(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sets of shingle hashes (distinct, sorted) are at least SIMILAR."""
    few, many = sorted((len(x), len(y)))
    if few * SIMILAR[1] < many * SIMILAR[0]:
        return False
    both = np.concatenate((x, y))
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return shared * SIMILAR[1] >= (few + many - shared) * SIMILAR[0]


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, width: int = 1) -> DataFrame:
    """(id, fp0, fp1, ..): the fingerprint's words as signed longs."""
    names = [f"fp{k}" for k in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(x, shingle, width) for x in batch.column(1).to_pylist()], np.uint64).reshape(-1, width).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(np.ascontiguousarray(fps[:, k])) for k in range(width)]], names=["id", *names])

    return df.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).cast("string").alias("text")).mapInArrow(run, "id long, " + ", ".join(f"{n} long" for n in names))


class Forest:
    """Union-find over identifiers; gives star edges."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while (y := self.up.get(root, root)) != root:
            root = y
        while (y := self.up.get(x, x)) != root:
            self.up[x], x = root, y
        return root

    def link(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def edges(self) -> pa.RecordBatch:
        nodes = list(self.up)
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([self.find(x) for x in nodes], pa.int64())], names=["a", "b"])


def linked(x: np.ndarray, y: np.ndarray, bits: int, shared: int) -> np.ndarray:
    """Places where two arrays of fingerprints (last axis: words) link: at least ``shared`` equal bytes (the
    count filter), then at most ``bits`` differing bits."""
    diff = x ^ y
    found = ((diff.view(np.uint8) == 0).sum(-1) >= shared).nonzero()
    # of signed numbers bitwise_count would count the absolute value
    kept = np.bitwise_count(diff[found].view(np.uint64)).sum(-1) <= bits
    return np.stack([f[kept] for f in found])


def _tally(bits: int, shared: int):
    """Rows (list, side, rep, fp0, ..) sorted by list -> spanning edges between representatives.

    side is 0 for a whole list, else 1 or 2: then only pairs of unlike sides are compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for (lists, side, rep, *words), last in _whole_lists(batches):
            fp = np.stack(words, axis=1)
            starts = np.flatnonzero(np.r_[True, lists[1:] != lists[:-1]])
            sizes = np.diff(np.r_[starts, len(lists)])
            # short lists all at once: the pairs at each distance inside a list
            for gap in range(1, min(int(sizes.max(initial=1)), SHORT)):
                i = np.flatnonzero((lists[gap:] == lists[:-gap]) & (side[gap:] == 0)) if gap < len(lists) else np.empty(0, np.int64)
                for k in linked(fp[i], fp[i + gap], bits, shared)[0].tolist():
                    forest.link(int(rep[i[k]]), int(rep[i[k] + gap]))
            for s, n in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
                if side[s] == 0 and n <= SHORT:
                    continue
                own = np.arange(s, s + n)
                left = own[side[s : s + n] <= 1]
                right = left if side[s] == 0 else own[side[s : s + n] == 2]
                for at in range(0, len(left), 128):
                    rows = left[at : at + 128]
                    for i, j in linked(fp[rows][:, None], fp[right][None, :], bits, shared).T.tolist():
                        if rows[i] != right[j]:
                            forest.link(int(rep[rows[i]]), int(rep[right[j]]))
            if len(forest.up) > FOREST or last:
                if forest.up:
                    yield forest.edges()
                forest = Forest()

    return run


def _whole_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[np.ndarray], bool]]:
    """Regroup sorted batches so that no list is cut; the second value tells the last group."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held is not None:
            columns = [np.concatenate(x) for x in zip(held, columns, strict=True)]
        cut = int(np.searchsorted(columns[0], columns[0][-1], "left"))
        if cut:
            yield [c[:cut] for c in columns], False
        held = [c[cut:] for c in columns]
    if held is not None:
        yield held, True


def links(fps: DataFrame, width: int = 1, bits: int = BITS, keys: list[tuple[int, ...]] | None = None) -> DataFrame:
    """(fp0, .., rep) of distinct fingerprints, a stored table -> (a, b) edges between representatives that span all
    links of pairs that share a list; one 64-bit word at up to 4 bits by default, then no link is lost."""
    names = [f"fp{k}" for k in range(width)]
    if keys is None:
        many = fps.count()
        keys = (TRIPLES if many <= SHORT_KEYS else FOURS) if width == 1 else (PAIRS if many <= SHORT_WIDE_KEYS else SPARSE)
    shared = WIDE_SHARED if width > 1 else 8 - bits
    rows = fps.filter("rep is not null").select("rep", *names)
    byte = [F.shiftrightunsigned(f"fp{p // 8}", 8 * (p % 8)).bitwiseAND(F.lit(255)) for p in range(8 * width)]

    def key(n: int, places: tuple[int, ...]):
        found = F.lit(n << 8 * len(places)).cast("long")
        for k, p in enumerate(places):
            found = found.bitwiseOR(F.shiftleft(byte[p], 8 * k))
        return found

    posted = rows.select(F.explode(F.array(*[key(n, places) for n, places in enumerate(keys)])).alias("key"), "rep", *names)
    dealt = deal(posted, F.lit(1), BLOCK, "rep", *names)
    return dealt.mapInArrow(_tally(bits, shared), "a long, b long").filter("a != b")


def deal(posted: DataFrame, weight: Column, block: int, *columns: str) -> DataFrame:
    """Rows (key, rep, ..) -> (list, side, ..) sorted by list: a key's rows are one list; where they weigh more
    than ``block`` they are cut into blocks, and every pair of blocks is a list. The weighty keys are stored, so
    Spark knows their size: it broadcasts them where they are few and merge-joins them beyond."""
    weights = posted.groupBy("key").agg(F.sum(weight).alias("weight"))
    long_lists = weights.filter(F.col("weight") > block).select("key", F.ceil(F.col("weight") / block).cast("int").alias("blocks"))
    posted = posted.join(written(long_lists), "key", "left")
    own = F.pmod(F.xxhash64("rep"), F.coalesce("blocks", F.lit(1))).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1),
        lambda other: F.struct(
            F.xxhash64("key", F.least(other, own), F.greatest(other, own)).alias("list"),
            F.when(other == own, 0).when(own < other, 1).otherwise(2).alias("side"),
        ),
    )
    whole = F.array(F.struct(F.col("key").alias("list"), F.lit(0).alias("side")))
    dealt = posted.select(*columns, F.explode(F.when(F.col("blocks").isNull(), whole).otherwise(pairs)).alias("x"))
    return dealt.select("x.list", "x.side", *columns).repartition("list").sortWithinPartitions("list")


def _verify(bits: int, shingle: int):
    """Rows (list, side, rep, fp0, .., text) sorted by list -> spanning edges of the pairs whose shingle sets
    are alike. Rows are taken in growing steps, so a large group is connected early and its other pairs
    need no look."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for (lists, side, rep, *words, text), last in _whole_lists(batches):
            fp = np.ascontiguousarray(np.stack(words, axis=1)).view(np.uint64)
            starts = np.flatnonzero(np.r_[True, lists[1:] != lists[:-1]]).tolist()
            for s, e in zip(starts, [*starts[1:], len(lists)], strict=True):
                own = np.arange(s, e)
                left = own[side[s:e] <= 1]
                right = left if side[s] == 0 else own[side[s:e] == 2]
                _connect(forest, left, right, fp, rep, text, bits, shingle)
            if len(forest.up) > FOREST or last:
                if forest.up:
                    yield forest.edges()
                forest = Forest()

    return run


def _connect(forest: Forest, left: np.ndarray, right: np.ndarray, fp: np.ndarray, rep: np.ndarray, text: np.ndarray, bits: int, shingle: int) -> None:
    sets: dict[int, np.ndarray] = {}

    def of(k: int) -> np.ndarray:
        if k not in sets:
            sets[k] = np.unique(hashes(text[k], shingle))
        return sets[k]

    def roots(rows: np.ndarray) -> np.ndarray:
        return np.array([forest.find(x) for x in rep[rows].tolist()], np.int64)

    same, at, step = left is right, 0, 1
    ends = roots(right)
    while at < len(left):
        rows = left[at : at + step]
        others = right[at + 1 :] if same else right
        starts = roots(rows)
        far = np.bitwise_count(fp[rows][:, None] ^ fp[others][None, :]).sum(-1, dtype=np.int64)
        found = (far <= bits) & (starts[:, None] != (ends[at + 1 :] if same else ends)[None, :])
        i, j = found.nonzero()
        changed = False
        for n in np.argsort(far[i, j], kind="stable").tolist():
            x, y = int(rows[i[n]]), int(others[j[n]])
            a, b = int(rep[x]), int(rep[y])
            if forest.find(a) != forest.find(b) and alike(of(x), of(y)):
                forest.link(a, b)
                changed = True
        if changed:
            ends = roots(right)
        at, step = at + step, min(step * 2, 128)


def verified(df: DataFrame, distinct: DataFrame, coarse: DataFrame, id_col: str, text_col: str, bits: int = WIDE_BITS) -> DataFrame:
    """Coarse groups (node, component) of representatives -> (a, b) edges that span all their links of texts
    with alike shingle sets and at most ``bits`` differing bits."""
    names = [f"fp{k}" for k in range(WIDE)]
    nodes = written(coarse.join(distinct, coarse["node"] == distinct["rep"]).select(F.col("component").alias("key"), "rep", *names))
    texts = df.select(quoted(id_col).cast("long").alias("rep"), F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("text"))
    members = written(nodes.hint("merge").join(IdFilter(nodes, "rep").keep(texts, "rep"), "rep"))
    dealt = deal(members, F.greatest(F.octet_length("text") + 64, F.lit(BLOCK_BYTES // BLOCK_TEXTS)), BLOCK_BYTES, "rep", *names, "text")
    return dealt.mapInArrow(_verify(bits, WIDE_SHINGLE), "a long, b long").filter("a != b")


def common_shingles(df: DataFrame, text_col: str, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) of shingles that are frequent in a sample of the rows, and their counts there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(hashes(x, shingle)) for x in batch.column(0).to_pylist()]
            h, n = np.unique(np.concatenate([np.empty(0, np.uint64), *found]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])

    text = quoted(text_col).cast("string")
    counts = df.select(text.alias("text")).filter(F.pmod(F.xxhash64("text"), F.lit(SAMPLED)) == 0).mapInArrow(run, "h long, n long")
    rows = counts.groupBy("h").agg(F.sum("n").alias("n")).filter("n >= 4").orderBy(F.desc("n"), "h").limit(COMMON).collect()
    h, n = np.array([r[0] for r in rows], np.int64).view(np.uint64), np.array([r[1] for r in rows], np.int64)
    return h[np.argsort(h)], n[np.argsort(h)]


def prefix(grams: np.ndarray, common: np.ndarray, often: np.ndarray) -> np.ndarray:
    """The first n - ceil(SIMILAR n) + 1 of n distinct hashes: the rare ones first, ties by hash."""
    rank = np.zeros(len(grams), np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, grams), len(common) - 1)
        rank = np.where(common[at] == grams, often[at], 0)
    n = len(grams)
    return grams[np.lexsort((grams, rank))[: n + SIMILAR[0] * -n // SIMILAR[1] + 1]] if n else grams


def profiles(df: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, fp0, .., n, parity, counts, prefix) of every row, in one pass over the texts: the wide fingerprint, the
    number of distinct shingles, the parity of 64 classes of them as bits, the numbers (up to 255) in ``COUNTS``
    classes as bytes, and the prefix."""
    common, often = common_shingles(df, text_col, shingle)
    names = [f"fp{k}" for k in range(WIDE)]
    kinds = [*[pa.int64()] * WIDE, pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64())]

    def row(text: str | None) -> tuple:
        grams = np.unique(hashes(text, shingle))
        counts = np.bincount((grams >> np.uint64(48)).astype(np.int64) % COUNTS, minlength=COUNTS)
        odd = np.packbits(counts.reshape(-1, 64).sum(0) % 2 == 1, bitorder="little").view(np.int64)
        return *fold(grams, WIDE).view(np.int64).tolist(), len(grams), int(odd[0]), np.minimum(counts, 255).astype(np.uint8).tobytes(), prefix(grams, common, often).view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                columns = zip(*[row(text.as_py()) for text in part.column(1)], strict=True)
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names=["id", *names, "n", "parity", "counts", "prefix"])

    texts = df.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, "id long, " + ", ".join(f"{n} long" for n in names) + ", n int, parity long, counts binary, prefix array<long>")


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (list, side, rep, component, n, pos, parity) sorted by list -> pairs of different components that may
    be alike."""
    for (lists, side, rep, component, n, pos, parity), _ in _whole_lists(batches):
        starts = np.flatnonzero(np.r_[True, lists[1:] != lists[:-1]])
        ends = np.r_[starts[1:], len(lists)]
        # most shingles stand in one group only
        mixed = np.minimum.reduceat(component, starts) < np.maximum.reduceat(component, starts)
        out: list[np.ndarray] = []
        held = 0

        def drain(out: list[np.ndarray]) -> pa.RecordBatch:
            pairs = np.unique(np.concatenate(out), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for s, e in zip(starts[mixed].tolist(), ends[mixed].tolist(), strict=True):
            own = np.arange(s, e)
            left = own[side[s:e] <= 1]
            right = left if side[s] == 0 else own[side[s:e] == 2]
            for at in range(0, len(left), 128):
                pairs = _may_be_alike(left[at : at + 128], right[at:] if side[s] == 0 else right, side[s] == 0, rep, component, n, pos, parity)
                if len(pairs):
                    out.append(pairs)
                    held += len(pairs)
                    if held > FOREST:
                        yield drain(out)
                        out, held = [], 0
        if out:
            yield drain(out)


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, n, m, counts, others) -> the pairs (a, b) that the counts per class leave."""
    few, many = SIMILAR
    for batch in batches:
        x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, COUNTS).astype(np.int16) for k in (4, 5))
        both = batch.column(2).to_numpy().astype(np.int64) + batch.column(3).to_numpy()
        kept = np.abs(x - y).sum(1, dtype=np.int64) * (few + many) <= both * (many - few)
        yield pa.RecordBatch.from_arrays([c.filter(pa.array(kept)) for c in batch.columns[:2]], names=["a", "b"])


def _post(long_over: int):
    """Rows (rep, component, n, parity, prefix) -> postings (key, kind, rep, component, other, n, pos, parity). A key
    that over ``long_over`` rows of a batch have is posted once for all of them (kind 0, with the smallest and the largest
    component in place of one), so a key that a third of all rows have sends few postings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = batch.column(4)
            sizes = prefix.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = prefix.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(sizes)), sizes)
            pos = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            rep, component, n, parity = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            keys, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
            many = counts > long_over
            own = np.flatnonzero(~many[inverse])
            at = row[own]
            lost = np.flatnonzero(many[inverse])
            lost = lost[np.argsort(inverse[lost], kind="stable")]
            starts = np.flatnonzero(np.r_[True, inverse[lost][1:] != inverse[lost][:-1]]) if len(lost) else np.empty(0, np.int64)
            held = component[row[lost]]
            low, high = (f.reduceat(held, starts) if len(starts) else held for f in (np.minimum, np.maximum))
            none = np.zeros(len(starts), np.int64)
            columns = [
                (np.concatenate([flat[own], flat[lost[starts]]]), pa.int64()),
                (np.concatenate([np.ones(len(own), np.int64), none]), pa.int32()),
                (np.concatenate([rep[at], none]), pa.int64()),
                (np.concatenate([component[at], low]), pa.int64()),
                (np.concatenate([component[at], high]), pa.int64()),
                (np.concatenate([n[at], none]), pa.int32()),
                (np.concatenate([pos[own], none]), pa.int32()),
                (np.concatenate([parity[at], none]), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64), k, safe=False) for c, k in columns], names=["key", "kind", "rep", "component", "other", "n", "pos", "parity"])

    return run


def _short_lists(long_over: int):
    """Postings sorted by key -> (a, b, null) pairs of the lists of at most ``long_over`` rows, and (null, null, key) of
    longer ones that hold rows of different components. No more than ``long_over`` rows of a list are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[np.ndarray] = []
        long: list[int] = []
        waiting: tuple[int, int, int] | None = None  # a long list so far: key, smallest and largest component
        held: list[np.ndarray] | None = None

        def drain() -> pa.RecordBatch:
            pairs = np.unique(np.concatenate([*out, np.empty((0, 2), np.int64)]), axis=0)
            found = pa.RecordBatch.from_arrays([pa.array([*pairs[:, 0].tolist(), *[None] * len(long)], pa.int64()), pa.array([*pairs[:, 1].tolist(), *[None] * len(long)], pa.int64()), pa.array([*[None] * len(pairs), *long], pa.int64())], names=["a", "b", "key"])
            out.clear()
            long.clear()
            return found

        def whole(columns: list[np.ndarray]) -> None:
            key, kind, rep, component, other, n, pos, parity = columns
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            sizes = np.diff(np.r_[starts, len(key)])
            mixed = np.minimum.reduceat(component, starts) < np.maximum.reduceat(other, starts)
            over = (sizes > long_over) | (np.minimum.reduceat(kind, starts) == 0)
            long.extend(key[starts[mixed & over]].tolist())
            for s, size in zip(starts[mixed & ~over].tolist(), sizes[mixed & ~over].tolist(), strict=True):
                own = np.arange(s, s + size)
                pairs = _may_be_alike(own, own, True, rep, component, n, pos, parity)
                if len(pairs):
                    out.append(pairs)

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if waiting is not None:
                more = int(np.searchsorted(columns[0], waiting[0], "right"))
                if more:
                    waiting = (waiting[0], min(waiting[1], int(columns[3][:more].min())), max(waiting[2], int(columns[4][:more].max())))
                    columns = [c[more:] for c in columns]
                if not len(columns[0]):
                    continue
                if waiting[1] < waiting[2]:
                    long.append(waiting[0])
                waiting = None
            if held is not None:
                columns = [np.concatenate(x) for x in zip(held, columns, strict=True)]
            cut = int(np.searchsorted(columns[0], columns[0][-1], "left"))
            if cut:
                whole([c[:cut] for c in columns])
            held = [c[cut:] for c in columns]
            if len(held[0]) > long_over:
                waiting, held = (int(held[0][0]), int(held[3].min()), int(held[4].max())), None
            if sum(map(len, out)) > FOREST:
                yield drain()
        if held is not None:
            whole(held)
        if waiting is not None and waiting[1] < waiting[2]:
            long.append(waiting[0])
        yield drain()

    return run


def _may_be_alike(left: np.ndarray, right: np.ndarray, same: bool, rep: np.ndarray, component: np.ndarray, n: np.ndarray, pos: np.ndarray, parity: np.ndarray) -> np.ndarray:
    """The pairs (smaller and larger rep) of rows of different components that the bounds leave. They hold at the first
    shingle that two prefixes share, so each alike pair passes there."""
    few, many = SIMILAR
    out = [np.empty((0, 2), np.int64)]
    n, pos, parity = n.astype(np.int64), pos.astype(np.int64), parity.view(np.uint64)
    left_over = n - pos
    for at in range(0, len(left), 128):
        x, y = left[at : at + 128][:, None], right[None, :]
        both = n[x] + n[y]
        # shared >= few / (few + many) of both; so at most (many - few) / (few + many) of both differ
        found = (component[x] != component[y]) & (np.minimum(n[x], n[y]) * many >= np.maximum(n[x], n[y]) * few)
        found &= np.minimum(left_over[x], left_over[y]) * (few + many) >= both * few
        found &= np.bitwise_count(parity[x] ^ parity[y]).astype(np.int64) * (few + many) <= both * (many - few)
        if same:
            found &= x < y
        i, j = found.nonzero()
        if len(i):
            a, b = rep[x[i, 0]], rep[y[0, j]]
            out.append(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1))
    return np.concatenate(out)


def _repeated(most: int):
    """Rows (h, rep) sorted by h -> (rep, h, c) of those whose h more than one row has, with their number, ``most`` at
    most; no more than ``most`` rows of an h are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64), np.empty(0, np.int64)]
        many: int | None = None  # an h that over ``most`` rows have

        def out(h: np.ndarray, rep: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(rep), pa.array(h), pa.array(c.astype(np.int64))], names=["rep", "h", "c"])

        def whole(h: np.ndarray, rep: np.ndarray) -> pa.RecordBatch:
            starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            c = np.repeat(sizes := np.diff(np.r_[starts, len(h)]), sizes)
            return out(h[c > 1], rep[c > 1], np.minimum(c[c > 1], most))

        for batch in batches:
            h, rep = (c.to_numpy() for c in batch.columns)
            if many is not None and len(h):
                n = int(np.searchsorted(h, many, "right"))
                if n:
                    yield out(h[:n], rep[:n], np.full(n, most))
                    h, rep = h[n:], rep[n:]
                if len(h):
                    many = None
            if not len(h):
                continue
            h, rep = np.concatenate([held[0], h]), np.concatenate([held[1], rep])
            cut = int(np.searchsorted(h, h[-1], "left"))
            if cut:
                yield whole(h[:cut], rep[:cut])
            held = [h[cut:], rep[cut:]]
            if len(held[0]) >= most:
                many = int(held[0][0])
                yield out(*held, np.full(len(held[0]), most))
                held = [h[:0], rep[:0]]
        if len(held[0]):
            yield whole(*held)

    return run


def counted_prefixes(df: DataFrame, hot: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(rep, component, n, parity) of some rows, a stored table -> (rep, component, n, parity, pos, key): what of their
    prefixes other rows have, in the order of how many of these rows have a shingle (up to ``MOST_COUNTED``). A row's
    own shingles come first in that order; they can meet nobody and are not gathered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                grams = np.unique(hashes(batch.column(1)[row].as_py(), WIDE_SHINGLE)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(grams), batch.column(0).take(pa.array(np.full(len(grams), row)))], names=["h", "rep"])

    texts = df.select(quoted(id_col).cast("long").alias("rep"), quoted(text_col).cast("string").alias("text"))
    own = hot.select("rep").hint("merge").join(IdFilter(hot, "rep").keep(texts, "rep"), "rep").select("rep", "text")
    shingles = own.mapInArrow(run, "h long, rep long").repartition("h").sortWithinPartitions("h")
    shared = shingles.mapInArrow(_repeated(MOST_COUNTED), "rep long, h long, c long")
    sets = shared.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("c", "h"))).alias("x"))  # a row's own shingles
    joined = sets.join(hot, "rep")
    alone = F.col("n") - F.size("x")
    first = F.col("n") - F.ceil(F.col("n") * SIMILAR[0] / SIMILAR[1]).cast("int") + 1
    prefix = F.slice("x.h", F.lit(1), F.greatest(first - alone, F.lit(0)))
    return joined.select("rep", "component", "n", "parity", alone.alias("alone"), F.posexplode(prefix).alias("at", "key")).select("rep", "component", "n", "parity", (F.col("alone") + F.col("at")).alias("pos"), "key")


def candidates(df: DataFrame, rows: DataFrame, first: DataFrame, id_col: str, text_col: str, long_over: int = LONG) -> DataFrame:
    """Profiles and (id, component) of every row -> pairs (a, b) of identifiers in different components, among them
    all whose texts are alike.

    Postings go through one shuffle, and short lists give their pairs there. Two alike rows whose first common shingle
    has a long list are both among the rows that have such a shingle in their prefix; for those alone prefixes are made
    anew in the order of their exact counts, which puts what a family of texts shares behind what is a text's own."""
    own = rows.filter("id is not null and n > 0").select("id", "n", "parity", "counts", "prefix")
    placed = written(own.join(first.hint("merge"), "id").withColumnRenamed("id", "rep"))
    posted = placed.select("rep", "component", "n", "parity", "prefix").mapInArrow(_post(long_over), POSTING)
    found = written(posted.repartition("key").sortWithinPartitions("key", "kind").mapInArrow(_short_lists(long_over), "a long, b long, key long"))
    pairs = found.filter("key is null").select("a", "b")
    long = written(found.filter("key is not null").select("key").distinct())
    if not long.isEmpty():
        hot = placed.select("rep", "component", "n", "parity", F.explode("prefix").alias("key")).join(long, "key", "left_semi")
        hot = written(hot.select("rep", "component", "n", "parity").distinct())
        again = counted_prefixes(df, hot, id_col, text_col)
        pairs = pairs.union(deal(written(again), F.lit(1), BLOCK, "rep", "component", "n", "pos", "parity").mapInArrow(_candidates, "a long, b long"))
    pairs = pairs.distinct()
    of = placed.select("rep", "n", "counts")
    pairs = pairs.join(of.toDF("a", "n", "counts").hint("merge"), "a").join(of.toDF("b", "m", "others").hint("merge"), "b")
    return pairs.select("a", "b", "n", "m", "counts", "others").mapInArrow(_near, "a long, b long")


def missed(df: DataFrame, rows: DataFrame, first: DataFrame, id_col: str, text_col: str, long_over: int = LONG) -> DataFrame:
    """(a, b) edges that span the links of alike texts in different components of ``first`` (id, component)."""
    nodes = rows.filter("id is not null").select(F.col("id").alias("rep"), *[f"fp{k}" for k in range(WIDE)])
    coarse = components(candidates(df, rows, first, id_col, text_col, long_over))
    return verified(df, nodes, coarse, id_col, text_col, 64 * WIDE)


def distinct_of(fps: DataFrame, width: int) -> DataFrame:
    """(fp0, .., rep, n) of every distinct fingerprint."""
    return written(fps.groupBy(*[f"fp{k}" for k in range(width)]).agg(F.min("id").alias("rep"), F.count("*").alias("n")))


def grouped(fps: DataFrame, distinct: DataFrame, found: DataFrame) -> DataFrame:
    """(id, fp0, .., component) of every row."""
    names = fps.columns[1:]
    known = distinct.join(found, distinct["rep"] == found["node"], "left").filter("n > 1 or node is not null or rep is null")
    known = written(known.select(*names, "rep", F.coalesce("component", "rep").alias("component")))
    joined = fps.join(known, names, "left")
    return joined.select("id", *names, F.when(F.col("rep").isNull(), F.col("id")).otherwise(F.col("component")).alias("component"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """One row per input row: identifier, fingerprint (16 hex digits), component_id."""
    fps = written(fingerprints(df, id_col, text_col, shingle, 1))
    distinct = distinct_of(fps, 1)
    found = grouped(fps, distinct, components(links(distinct)))
    return found.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp0"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", long_over: int = LONG) -> DataFrame:
    """One row of each group of similar texts stays: the one with the smallest identifier. Rows without
    identifier stay. Texts that may be asked for (``IdFilter``) are always merge-joined, so the plan is the same at every
    size. Where identifiers repeat, rows are told by numbers in the order of the identifiers, so each row has a fate of
    its own."""
    key = quoted(id_col)
    if not df.filter(key.isNotNull()).groupBy(key.alias("id")).count().filter("count > 1").isEmpty():
        rows = df.select(F.struct(*[quoted(c) for c in df.columns]).alias("row"), key.alias("id"), quoted(text_col).alias("text"))
        rows = rows.repartitionByRange("id").sortWithinPartitions("id")
        rows = written(rows.withColumn("id", F.when(F.col("id").isNotNull(), F.monotonically_increasing_id())))
        return drop_near_duplicates(rows, "id", "text", long_over).select("row.*")
    with intermediate(df.sparkSession) as keep:
        names = [f"fp{k}" for k in range(WIDE)]
        rows = written(profiles(df, id_col, text_col, WIDE_SHINGLE))
        fps = rows.select("id", *names)
        distinct = distinct_of(fps, WIDE)
        coarse = components(links(distinct, WIDE, WIDE_BITS))
        found = components(verified(df, distinct, coarse, id_col, text_col))
        first = written(grouped(fps, distinct, found).filter("id is not null").select("id", "component"))
        found = components(first.toDF("a", "b").union(missed(df, rows, first, id_col, text_col, long_over)))
        lost = keep(found.filter("component != node").select(F.col("node").alias("lost")).distinct())
    rows = df.select(F.struct(*[quoted(c) for c in df.columns]).alias("row"), key.cast("long").alias("id"))
    rows = IdFilter(lost, "lost").mark(rows, "id")
    kept = rows.filter("_known").join(lost.hint("merge"), F.col("id") == F.col("lost"), "left_anti")
    return rows.filter("not _known").select("row.*").unionByName(kept.select("row.*"))


def op3_simhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
