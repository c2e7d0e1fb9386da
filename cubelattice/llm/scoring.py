"""Language-model scoring with a log-bilinear neural model.

Counts of every token of every training text are taken by partial counting and one aggregation. The model
predicts a token's class from the classes of the ``BEFORE`` tokens before it: the ``head`` most frequent
tokens are classes of their own, all others fall into ``BUCKETS`` by their last two bytes. Inside a bucket a
token has the add-one share of its count, an unseen token that of a zero count, so probabilities sum to one:

    log P(text) = sum log P(class | classes before) + sum over bucket tokens log (c + 1) / (mass + 1)

The log-bilinear model adds the vectors of the classes before, each through the matrix of its place, and
multiplies the sum with the target's vector. It is trained in numpy by noise-contrastive estimation over all
training texts: in each of ``ROUNDS`` rounds every task takes its rows of that round (dealt by text hash) in
batches, with noise classes drawn from the unigram distribution, and the tasks' parameters (with their sums of
squared gradients, which set the step sizes) are averaged by tokens (the sums are taken on executors, so the driver reads one set of parameters). A task with few texts
repeats them until it has taken ``LEAST_STEPS`` steps. Scoring normalises exactly: per batch of texts, the new
contexts are multiplied with all targets, and the log of the summed exponentials is kept per context. These products
are exact (their factors are rounded to 23 bits), so a context's sum depends neither on which others it meets nor on its row; all
other sums of a text are its own, in double precision, or of whole numbers (10^-12), so neither does its score.

Bounds: the exact counts of the ``known`` most frequent tokens travel with the tasks (a token over 64 bytes is
told by its SHA-512, so they are at most 65,536 x 65 bytes) with some 1.4 MB of parameters; all other tokens
meet their counts in a shuffle join, whose inputs are plain exchanges. What the driver reads has the same
bounds. A row is told by a number that is stored with it.

Tokens are runs of anything but space and the ASCII controls 9-13, A-Z lower-cased, then one end per text.
Null and empty texts are an end alone. Null and repeated identifiers are carried along and tell nothing; rows
that repeat a text get equal scores. Texts are read whole; one row's tokens must fit in memory. Without
training rows every base probability is 1 and the model is uniform over classes. An empty table gives an empty
result; other columns, whatever their names, take no part.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubelattice.llm.common import quoted, table, written

HEAD = 768
BUCKETS = 256
KNOWN = 65_536
LONGEST = 64
BEFORE = 2
WIDTH = 32
NOISE = 25.0
DRAWN = 32
BATCH = 1024
ROUNDS = 2
LEAST_STEPS = 240
RATE = 0.1
FLUSH = 500_000
SLICE = 1024
LOOK = 256
END = b""  # no token is empty


def shortened(word: bytes) -> bytes:
    """A word, or what stands for a long one."""
    return word if len(word) <= LONGEST else hashlib.sha512(word).digest() + b"+"


def tokens(text: str | None) -> list[bytes]:
    words = (text or "").encode().lower().split()
    if words and max(map(len, words)) > LONGEST:
        words = [*map(shortened, words)]
    words.append(END)
    return words


def bucket(token: bytes) -> int:
    if not token:  # the end, where no training text has shown one
        return 0
    return (token[-1] * 7 + (token[-2] if len(token) > 1 else 0) * 31) % BUCKETS


def buckets(words: list[bytes]) -> np.ndarray:
    """``bucket`` of tokens that are not empty."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes)
    flat = np.frombuffer(b"".join(words), np.uint8)
    return (flat.take(ends - 1).astype(np.int64) * 7 + np.where(sizes == 1, 0, flat.take(ends - 2)) * np.int64(31)) % BUCKETS


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 7 == 2


def count_tokens(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(token, c) over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def drain() -> Iterator[pa.RecordBatch]:
            keys, values = list(seen), list(seen.values())
            for at in range(0, len(keys), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(keys[at : at + 50_000], pa.binary()), pa.array(values[at : at + 50_000], pa.int64())], names=["token", "c"])
            seen.clear()

        for batch in batches:
            for text in batch.column(0):
                seen.update(tokens(text.as_py()))
                if len(seen) > FLUSH:
                    yield from drain()
        yield from drain()

    return df.select(quoted(text_col).cast("string").alias("text")).mapInArrow(run, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


class Model:
    """Classes, exact counts of known tokens, and the log-bilinear parameters; a few megabytes."""

    def __init__(self, known: dict[bytes, int], head: list[bytes], mass: np.ndarray, seen: np.ndarray, total: int, distinct: int):
        self.slot = {w: n for n, w in enumerate(known)}
        self.count = np.array([*known.values(), 0], np.int64)
        self.head, self.classes = len(head), len(head) + BUCKETS
        own = {w: n for n, w in enumerate(head)}
        self.kind = np.array([own[w] if w in own else len(head) + bucket(w) for w in known] + [0], np.int32)
        self.own = own
        self.mass, self.total, self.distinct = mass, total, distinct  # mass of a bucket: sum of (c + 1) over its tokens
        unigram = np.concatenate([[known[w] for w in head], seen]) + 0.5
        self.noise = unigram / unigram.sum()
        self.shares = np.cumsum(self.noise) / self.noise.sum()
        self.logs = np.log(NOISE * self.noise).astype(np.float32)
        draw = np.random.default_rng(7)
        self.parameters = {
            "context": draw.normal(0, 0.3, (self.classes + 1, WIDTH)),  # the last one: before the text
            "through": np.stack([np.eye(WIDTH) / (k + 1) for k in range(BEFORE)]),
            "target": np.zeros((self.classes, WIDTH)),
            "bias": np.log(self.noise),
        }
        self.squares = {k: np.full(x.shape, 1e-8) for k, x in self.parameters.items()}  # of the steps' gradients, summed
        self._ready: tuple | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_ready": None}

    def read(self, text: str | None) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Place among the known tokens (-1: none) and class of each token, and the tokens that are not known."""
        words = (text or "").encode().lower().split()
        words.append(END)
        at = np.fromiter(map(self.slot.get, words, repeat(-1)), np.int32, len(words))
        rare = np.flatnonzero(at < 0)
        others = [words[n] for n in rare.tolist()]
        if others and max(map(len, others)) > LONGEST:
            others = [*map(shortened, others)]
            at[rare] = [self.slot.get(w, -1) for w in others]
            others = [w for w in others if w not in self.slot]
            rare = np.flatnonzero(at < 0)
        kinds = self.kind[at]
        if others and not others[-1]:  # an end that no training text has shown
            kinds[rare[-1]], rare = self.head + bucket(END), rare[:-1]
            others.pop()
        if others:
            kinds[rare] = self.head + buckets(others)
        return at, kinds, others

    # training

    def take(self, body: np.ndarray) -> None:
        """Parameters and squares out of one array (see ``flat``)."""
        at = 0
        for group in (self.parameters, self.squares):
            for k, x in group.items():
                group[k] = body[at : at + x.size].reshape(x.shape)
                at += x.size
        self._ready = None

    def step(self, p: dict, sums: dict, before: np.ndarray, target: np.ndarray, draw: np.random.Generator) -> None:
        """One step of noise-contrastive estimation: every position against its own class and drawn classes."""
        drawn = self.shares.searchsorted(draw.random(DRAWN), side="right")
        through = p["through"].reshape(-1, WIDTH)
        inputs = p["context"].take(before, axis=0).reshape(len(target), -1)  # the vectors of all places side by side
        wanted, unwanted = p["target"].take(target, axis=0), p["target"].take(drawn, axis=0)
        shift = p["bias"] - self.logs
        predicted = inputs @ through
        own = 1 - _sigmoid(np.einsum("nd,nd->n", predicted, wanted) + shift.take(target))
        other = _sigmoid(predicted @ unwanted.T + shift.take(drawn)) * np.float32(-NOISE / DRAWN)
        wanted *= own[:, None]
        wanted += other @ unwanted
        back = wanted
        pulled = np.concatenate([own[:, None] * predicted, other.T @ predicted])
        every = slice(None)
        grads = {  # of the rows that occur; the others stay as they are
            "context": _gathered(before.ravel(), (back @ through.T).reshape(-1, WIDTH)),
            "through": (every, (inputs.T @ back).reshape(p["through"].shape)),
            "target": _gathered(np.concatenate([target, drawn]), pulled),
            "bias": (every, np.bincount(target, own, self.classes) + np.bincount(drawn, other.sum(0), self.classes)),
        }
        for k, (at, g) in grads.items():
            g = g.astype(np.float32, copy=False)
            g *= np.float32(1 / len(target))
            size = g * g
            size += sums[k][at]
            sums[k][at] = size
            np.sqrt(size, out=size)
            size += np.float32(1e-6)
            g /= size
            g *= np.float32(RATE)
            p[k][at] += g

    def train(self, batches: Iterator[pa.RecordBatch], seed: int) -> tuple[np.ndarray, int]:
        """Parameters and squares after all texts, as one array, and the number of tokens."""
        p, sums = ({k: x.astype(np.float32) for k, x in group.items()} for group in (self.parameters, self.squares))
        draw = np.random.default_rng(seed)
        steps = seen = 0
        held: list[np.ndarray] | None = []
        waiting: list[np.ndarray] = []

        def pass_over(parts: list[np.ndarray]) -> int:
            a, place = _padded(parts, self.classes)
            place = draw.permutation(place)
            cuts = np.array_split(place, -(-len(place) // BATCH))
            a, back = a.astype(np.intp), np.arange(1, BEFORE + 1)
            for at in cuts:
                self.step(p, sums, a.take(at[:, None] - back), a.take(at), draw)
            return len(cuts)

        for batch in batches:
            for text in batch.column(0):
                kinds = self.read(text.as_py())[1]
                waiting.append(kinds)
                seen += len(kinds)
                if seen % (128 * BATCH) < len(kinds):
                    steps += pass_over(waiting)
                    held = [*held, *waiting] if held is not None and steps < LEAST_STEPS else None
                    waiting = []
        if waiting:
            steps += pass_over(waiting)
            held = [*held, *waiting] if held is not None else None
        while held and steps < LEAST_STEPS:
            steps += pass_over(held)
        return np.concatenate([x.ravel() for group in (p, sums) for x in group.values()]), seen

    # scoring

    def ready(self) -> tuple:
        """Context vectors through the matrix of each place and targets by column, as whole numbers of steps; both again in
        single precision, targets by row; biases; the log of each context's sum (none yet)."""
        if self._ready is None:
            p = self.parameters
            through, target = _stepped([p["context"] @ m for m in p["through"]], BEFORE), _stepped([p["target"]], 1)[0]
            self._ready = (
                through,
                np.ascontiguousarray(target.T),
                [x.astype(np.float32) for x in through],
                target.astype(np.float32),
                p["bias"].astype(np.float32),
                np.full((self.classes + 1) ** BEFORE, np.nan, np.float32),
            )
        return self._ready

    def log10(self, kinds: list[np.ndarray]) -> np.ndarray:
        """Of each text: the sum of log10 P(class | classes before)."""
        through, target, short, wanted, bias, norm = self.ready()
        a, place = _padded(kinds, self.classes)
        out = np.empty(len(place))
        wide, scores = np.empty((LOOK, self.classes)), np.empty((LOOK, self.classes), np.float32)
        for at in range(0, len(place), 1 << 16):
            own = place[at : at + (1 << 16)]
            before = [a[own - k] for k in range(1, BEFORE + 1)]
            context = np.zeros(len(own), np.int64)
            for c in before:
                context = context * (self.classes + 1) + c
            fresh = np.unique(context[np.isnan(norm[context])])
            for n in range(0, len(fresh), LOOK):
                part = fresh[n : n + LOOK]
                vectors, rest = np.zeros((LOOK, WIDTH)), np.resize(part, LOOK)
                for m in reversed(through):
                    vectors += m.take(rest % (self.classes + 1), axis=0)
                    rest = rest // (self.classes + 1)
                np.matmul(vectors, target, out=wide)
                np.add(wide, bias, out=scores, casting="same_kind")
                most = scores.max(1, keepdims=True)
                scores -= most
                norm[part] = (np.log(np.exp(scores, out=scores).sum(1)) + most[:, 0])[: len(part)]
            vectors = sum(m.take(c, axis=0) for m, c in zip(short, before, strict=True))
            vectors *= wanted.take(a[own], axis=0)
            out[at : at + len(own)] = vectors.sum(1) + bias[a[own]].astype(np.float64) - norm[context]
        sizes = np.fromiter(map(len, kinds), np.int64, len(kinds))
        ends = np.cumsum(sizes).tolist()
        return np.array([out[b - n : b].sum() for b, n in zip(ends, sizes.tolist(), strict=True)]) / np.log(10)


def _stepped(parts: list[np.ndarray], added: int) -> list[np.ndarray]:
    """Numbers as multiples of one power of two, such that sums of ``added`` of them have at most 23 bits: a product of two such
    vectors of ``WIDTH`` numbers is exact in double precision, in whatever order and place it is summed."""
    most = added * max(float(np.abs(x).max()) for x in parts)
    step = 2.0 ** (math.frexp(most)[1] - 23)
    return [np.rint(x / step) * step for x in parts]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x = np.exp(np.minimum(-x, 30))
    x += 1
    return np.reciprocal(x, out=x)


def _padded(kinds: list[np.ndarray], start: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, ``BEFORE`` starts ahead of each; the places of the tokens."""
    sizes = np.fromiter(map(len, kinds), np.int64, len(kinds))
    place = np.arange(int(sizes.sum())) + np.repeat(np.arange(1, len(kinds) + 1) * BEFORE, sizes)
    a = np.full(len(place) + BEFORE * len(kinds), start, np.int32)
    a[place] = np.concatenate(kinds) if kinds else 0
    return a, place


def _gathered(kinds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes that occur, and the sums of their rows."""
    order = np.argsort(kinds.astype(np.int16), kind="stable")
    kinds = kinds.take(order)
    starts = np.flatnonzero(np.diff(kinds, prepend=-1))
    return kinds.take(starts), np.add.reduceat(rows.take(order, axis=0), starts, axis=0)


def fit(training: DataFrame, text_col: str = "text", head: int = HEAD, known: int = KNOWN) -> tuple[Model, DataFrame]:
    """The model, and the stored table of all token counts. Known are the most frequent tokens, down to a count that
    leaves at most ``known`` of them."""
    counts = written(count_tokens(training, text_col))
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    # tokens per step of their count (64 steps from one power of two to the next): at most some thousand rows
    step = F.floor(F.log2("c") * 64)
    steps = sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True)
    taken = [n for n, size in enumerate(accumulate(r["count"] for r in steps)) if size <= known]
    least = steps[taken[-1]]["step"] if taken else math.inf
    top = counts.filter(step >= F.lit(float(least))).collect()  # at most ``known`` rows of at most 65 bytes
    top = sorted(((bytes(r[0]), r[1]) for r in top), key=lambda x: (-x[1], x[0]))
    ends = counts.filter(F.octet_length("token") == 0).first()  # a class of its own, however rare
    top = ({END: ends["c"]} if ends else {}) | dict(top)
    heads = list(top)[:head]

    def masses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sums, rows = set(heads), np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for token, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if token not in own:
                    sums[bucket(token)] += c
                    rows[bucket(token)] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS), pa.int64()), pa.array(sums), pa.array(rows)], names=["b", "c", "n"])

    seen, tokens_of = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for b, c, n in counts.mapInArrow(masses, "b long, c long, n long").groupBy("b").agg(F.sum("c"), F.sum("n")).collect():
        seen[b], tokens_of[b] = c, n
    model = Model(top, heads, seen + tokens_of, seen, total, distinct)
    texts = training.select(quoted(text_col).cast("string").alias("text"))
    for r in range(ROUNDS if total else 0):
        train_round(texts.filter(F.pmod(F.xxhash64("text"), F.lit(ROUNDS)) == r), model, r)
    return model, counts


def train_round(texts: DataFrame, model: Model, seed: int) -> None:
    """Train on all rows, from the model's parameters, and give it the tasks' mean parameters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        body, seen = model.train(batches, seed)
        if seen:
            parts = [body[at : at + SLICE].astype("<f8") * seen for at in range(0, len(body), SLICE)]
            yield _slices(range(len(parts)), [seen] * len(parts), parts)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights: Counter = Counter()
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, weight, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                weights[at] += weight
                sums[at] = sums.get(at, 0.0) + np.frombuffer(body, "<f8")
        yield _slices(list(sums), [weights[k] for k in sums], list(sums.values()))

    schema = "part int, weight long, body binary"
    found = texts.mapInArrow(run, schema).repartition("part").mapInArrow(summed, schema).collect()  # one set of parameters
    if found:
        mean = np.concatenate([np.frombuffer(r["body"], "<f8") / r["weight"] for r in sorted(found, key=lambda r: r["part"])])
        model.take(mean)


def _slices(part, weight, bodies: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(weight, pa.int64()), pa.array([b.tobytes() for b in bodies], pa.binary())], names=["part", "weight", "body"])


def score(df: DataFrame, model: Model, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Identifier, n_tokens, n_known, train_tokens, base_score, score per input row."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    texts = df.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        logs = np.log10(model.count + 1.0)
        inside = np.log10(model.mass + 1.0)

        def part(idents: pa.Array, bodies: pa.Array) -> pa.RecordBatch:
            at, kinds, others = zip(*[model.read(text.as_py()) for text in bodies], strict=True)
            own = model.log10(list(kinds))
            n, known, base, ends = [], [], [], [0]
            for k, (a, c, words) in enumerate(zip(at, kinds, others, strict=True)):
                rare = c >= model.head
                own[k] += logs[a[rare]].sum() - inside[c[rare] - model.head].sum()
                n.append(len(a))
                known.append(int((a >= 0).sum()))
                base.append(float(logs[a].sum()))
                ends.append(ends[-1] + len(words))
            rest = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array([w for words in others for w in words], pa.binary()))
            return pa.RecordBatch.from_arrays([idents, pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(own, pa.float64()), rest], names=["id", "n", "k", "logs", "own", "rare"])

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = batch.slice(at, 512)
                yield part(rows.column(0), rows.column(1))

    local = texts.mapInArrow(run, "id long, n long, k long, logs double, own double, rare array<binary>")
    local = written(local.withColumn("row", F.monotonically_increasing_id()))
    met = local.select("row", F.explode("rare").alias("token")).join(counts, "token")
    # in whole steps, so the sum does not depend on the order in which tokens arrive
    steps = F.sum(F.log10(F.col("c") + 1.0).cast("decimal(20,12)"))
    sums = met.groupBy("row").agg(steps.cast("double").alias("more"), F.count("*").alias("met"))
    joined = local.drop("rare").join(sums, "row", "left").withColumns({"more": F.coalesce("more", F.lit(0.0)), "met": F.coalesce("met", F.lit(0))})
    base = float(np.log10(model.total + model.distinct + 1.0))
    return joined.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_tokens"),
        (F.col("k") + F.col("met")).alias("n_known"),
        F.lit(int(model.total)).cast("long").alias("train_tokens"),
        (F.col("logs") + F.col("more") - F.col("n") * F.lit(base)).alias("base_score"),
        (F.col("own") + F.col("more")).alias("score"),
    )


def op5_scoring(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model, counts = fit(docs.filter(~held_out()))
    scored = score(docs, model, counts)
    return scored.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
