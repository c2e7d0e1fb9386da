"""Language identification with string kernels.

The kernel of two texts is the mean over n = 1..3 of the normalised number of byte n-grams that are
present in both (a blended spectrum of presences), over the n-grams of the landmarks. Nyström features
come from ``landmarks`` texts per language; one-versus-rest kernel ridge regression on a bounded sample
of ``sample`` labelled texts per language gives one weight vector per language. A batch of texts becomes
a 0/1 matrix, then kernel values with every landmark, then one decision value per language: two matrix
products. The first one counts, so its results are whole numbers, and the second one always has ``ROWS`` rows (the last
ones are filled up), so a text's result does not depend on the texts beside it. Whole texts are read, in blocks.

All languages are learned. The sample is taken by a hash of identifier and text, with a rate per language from counts
over all training rows, each different row once, and cut at ``SAMPLE`` rows and an even share of ``SAMPLE_BYTES`` bytes
per language; beyond ``LANDMARKS_ALL`` / ``LANDMARKS`` languages each has fewer landmarks, but one at least. Sampled
texts are whole ones of at most ``LONGEST`` bytes; of a language that has none, its shortest text is taken. So the driver
reads at most ``SAMPLE_BYTES`` and one text per language. The model (landmark n-grams, presences and weights) travels with
the tasks: a megabyte for four languages, and in proportion to landmarks times their different n-grams beyond.

A null text or one without a letter (Unicode category L) is ``und`` with score 0, and so is every text if no training
row has a language and a letter. The score is the softmax share of the best decision value. Ties go to the
language that sorts first. Texts are predicted from all their bytes, in blocks, however long. Empty tables give
empty results; repeated rows, and rows with null or repeated identifiers, get equal results for equal texts; the
columns lang, source and doc_id are read for training only, and other columns, whatever their names, take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cubelattice.llm.common import quoted, table, written

ORDERS = (1, 2, 3)
LANDMARKS = 24
LANDMARKS_ALL = 480
SAMPLE = 160
SAMPLE_BYTES = 32 << 20
LONGEST = 1 << 16
#: Languages up to which their counts are broadcast to the rows.
LANGS_SENT = 100_000
RIDGE = 1e-2
SHARPNESS = 6.0
BLOCK = 1 << 20
ROWS = 128
LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"
#: A stage that filters by language rejects a text of which no language has this share.
SHARE = 0.5


def grams(body: np.ndarray, n: int) -> np.ndarray:
    """Codes of all byte n-grams."""
    size = len(body) - n + 1
    if size < 1:
        return np.empty(0, np.int32)
    code = body[:size].astype(np.int32)
    for k in range(1, n):
        code = code << 8 | body[k : size + k]
    return code


class StringKernel:
    """Presence vectors over the landmarks' n-grams, and kernel values with the landmarks."""

    def __init__(self, landmarks: list[str]):
        bodies = [self.body(x) for x in landmarks]
        self.codes = [np.unique(np.concatenate([grams(b, n) for b in bodies])) for n in ORDERS]
        self.starts = np.cumsum([0, *map(len, self.codes)])
        self.lookup: list[np.ndarray] | None = None
        self.present = np.packbits(np.concatenate([self.presence(landmarks[at : at + ROWS]).astype(bool) for at in range(0, len(landmarks), ROWS)]), axis=1)
        self.landmark: np.ndarray | None = None

    @staticmethod
    def body(text: str) -> np.ndarray:
        return np.frombuffer(text.lower().encode(), np.uint8)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"lookup": None, "landmark": None}

    def presence(self, texts: list[str]) -> np.ndarray:
        if self.lookup is None:
            self.lookup = []
            for n, codes, start in zip(ORDERS, self.codes, self.starts, strict=False):
                places = np.full(256**n, self.starts[-1], np.int32)  # the last column takes what no landmark has
                places[codes] = start + np.arange(len(codes))
                self.lookup.append(places)
        seen = np.zeros((len(texts), self.starts[-1] + 1), np.float32)
        for row, text in zip(seen, texts, strict=True):
            body = self.body(text)
            for at in range(0, len(body), BLOCK):
                part = body[at : at + BLOCK + max(ORDERS) - 1]
                for n, places in zip(ORDERS, self.lookup, strict=True):
                    row[places[grams(part, n)]] = 1
        return seen[:, :-1]

    def _compared(self, seen: np.ndarray) -> np.ndarray:
        """Presence vectors x landmarks. Counts of shared n-grams are whole numbers that single precision holds."""
        if self.landmark is None:
            self.landmark = np.unpackbits(self.present, axis=1, count=int(self.starts[-1])).astype(np.float32)
        out = np.zeros((len(seen), len(self.landmark)))
        for a, b in zip(self.starts, self.starts[1:], strict=False):
            mine, other = seen[:, a:b], self.landmark[:, a:b]
            sizes = np.maximum(mine.sum(1, dtype=np.float64), 1)[:, None] * np.maximum(other.sum(1, dtype=np.float64), 1)[None, :]
            out += (mine @ other.T) / np.sqrt(sizes) / len(ORDERS)
        return out

    def values(self, texts: list[str]) -> np.ndarray:
        """texts x landmarks."""
        return self._compared(self.presence(texts))

    def gram(self) -> np.ndarray:
        """landmarks x landmarks."""
        own = self.starts[-1]
        return np.concatenate([self._compared(np.unpackbits(self.present[at : at + ROWS], axis=1, count=int(own)).astype(np.float32)) for at in range(0, len(self.present), ROWS)])


class Classifier:
    """One-versus-rest kernel ridge regression on Nyström features."""

    def __init__(self, texts: list[str], langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE):
        self.langs = sorted(set(langs))
        each = max(1, min(landmarks, LANDMARKS_ALL // max(1, len(self.langs))))
        taken: dict[str, list[str]] = {}
        for t, of in zip(texts, langs, strict=True):
            if len(taken.setdefault(of, [])) < each:
                taken[of].append(t)
        chosen = [x for lang in self.langs for x in taken[lang]]
        if not chosen:
            return
        self.kernel = StringKernel(chosen)
        values, vectors = np.linalg.eigh(self.kernel.gram())
        good = values > 1e-6 * values.max()
        whiten = vectors[:, good] / np.sqrt(values[good])
        x = np.concatenate([self.kernel.values(texts[at : at + ROWS]) for at in range(0, len(texts), ROWS)]) @ whiten
        y = np.where(np.array(langs)[:, None] == np.array(self.langs)[None, :], 1.0, -1.0)
        # rows of a language weigh the same in sum, whatever its share of the sample
        share = 1 / np.sqrt((y > 0).sum(0))[(y > 0).argmax(1)][:, None]
        x1 = np.c_[x, np.ones(len(x))] * share
        weights = np.linalg.solve(x1.T @ x1 + ridge * np.eye(x1.shape[1]), x1.T @ (y * share))
        self.weights, self.bias = whiten @ weights[:-1], weights[-1]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        out, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        rows = [n for n, x in enumerate(texts) if x and LETTER.search(x)] if self.langs else []
        for at in range(0, len(rows), ROWS):
            part = rows[at : at + ROWS]
            values = np.zeros((ROWS, len(self.weights)))
            values[: len(part)] = self.kernel.values([texts[n] for n in part])
            decision = (values @ self.weights + self.bias)[: len(part)]
            share = np.exp(SHARPNESS * (decision - decision.max(1, keepdims=True)))
            best = decision.argmax(1)
            for n, k, s in zip(part, best.tolist(), (1 / share.sum(1)).tolist(), strict=True):
                out[n], score[n] = self.langs[k], s
        return out, score


class Unlearned:
    """Stands in where no language was learned: tells texts with a letter from others."""

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        return ["any" if x and LETTER.search(x) else UNKNOWN for x in texts], np.zeros(len(texts))


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Classifier:
    """Learn from rows with a text that has a letter and a language."""
    lang, text = quoted(lang_col).cast("string"), quoted(text_col).cast("string")
    rows = labelled.select(quoted(id_col).cast("string").alias("id"), text.alias("text"), lang.alias("lang")).filter("lang is not null and text is not null").filter(F.col("text").rlike(r"\p{L}"))
    rows = rows.withColumn("size", F.octet_length("text"))
    fits = F.col("size") <= LONGEST
    # a row per language: how many of its rows fit, and the shortest text of a language where none does
    known = written(rows.groupBy("lang").agg(F.count_if(fits).alias("n"), F.min("size").alias("least")))
    many = known.count()
    if not many:
        return Classifier([], [])
    few = F.broadcast if many <= LANGS_SENT else (lambda df: df)
    short = rows.filter(fits).join(few(known.select("lang", "n")), "lang")
    at = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30))
    drawn = short.withColumn("at", at).filter(F.col("at") < F.least(F.lit(1.0), 2 * sample / F.col("n")) * (1 << 30)).select("lang", "text", "size", "at").distinct()
    own = Window.partitionBy("lang").orderBy("at", "text")
    drawn = drawn.withColumns({"nth": F.row_number().over(own), "sum": F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow))})
    taken = drawn.filter((F.col("nth") <= sample) & ((F.col("nth") == 1) | (F.col("sum") <= max(1, SAMPLE_BYTES // many)))).select("lang", "text", "at")
    long = rows.filter(~fits).join(few(known.filter("n = 0").select("lang", "least")), "lang").filter("size = least").groupBy("lang").agg(F.min("text").alias("text"))
    found = sorted(taken.union(long.select("lang", "text", F.lit(0).cast("long"))).collect(), key=lambda r: (r[2], r[0], r[1]))
    return Classifier([r["text"] for r in found], [r["lang"] for r in found])


def identify(df: DataFrame, model: Classifier | Unlearned, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Identifier, lang_pred, score, and the columns of ``keep`` unchanged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = model.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(langs, pa.string()), pa.array(scores)], names=["id", *[f"own_{k}" for k in range(len(keep))], "lang_pred", "score"])

    rows = df.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text"), *[quoted(c).alias(f"own_{k}") for k, c in enumerate(keep)])
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes if n != "text") + ", lang_pred string, score double"
    found = rows.mapInArrow(run, schema)
    return found.select(F.col("id").alias(id_col), "lang_pred", "score", *[F.col(f"own_{k}").alias(c) for k, c in enumerate(keep)])


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def op10_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out()))
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, share: float = SHARE) -> DataFrame:
    """The rows whose text has an identified language, all columns unchanged.

    Rejected are texts without a letter, and texts of which no learned language has ``share`` (the model is at
    odds with itself: a word or two that fit several languages, or a language that the labels lack and that
    looks like no other). It learns from the rows that op10 learns from. Where no language was learned, texts
    with a letter stay. Columns may have any names."""
    model = fit(docs.filter(~held_out()))
    known = bool(model.langs)
    # the whole row travels as it is, under its place, so no name of it meets the model's
    found = identify(docs, model if known else Unlearned(), keep=tuple(docs.columns)).toDF("_id", "_pred", "_share", *[f"_{k}" for k in range(len(docs.columns))])
    kept = found.filter((F.col("_pred") != UNKNOWN) & (F.col("_share") >= (share if known else 0.0)))
    return kept.select(*[F.col(f"_{k}").alias(c) for k, c in enumerate(docs.columns)])
