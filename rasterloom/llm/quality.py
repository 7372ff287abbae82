"""Supervised subword embeddings: hashed word, word-pair and character n-gram vectors, averaged, with softmax output."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.llm.common import bucket, documents, first_by_hash, packed_words, ship_package, text_of
from rasterloom.llm.interning import Interner, split_words

BUCKETS, DIM, EPOCHS, RATE = 1 << 15, 16, 12, 0.4
#: The classifier is fitted on this many labelled documents at most, chosen by a hash of their id.
SAMPLE_DOCS = 4000
GRAMS = (3, 4)
#: Words whose features a worker keeps; beyond that it starts anew.
KEPT_WORDS = 400_000
#: Bytes of text that are scored at a time.
SLICE = 1 << 20
THRESHOLD = 0.3
REPEAT = b"\x00again"


def word_features(word: bytes) -> list[int]:
    """Buckets of a word as it is and of its character n-grams, between marks; long words in full."""
    w = b"<" + word + b">"
    return [zlib.crc32(w) % BUCKETS] + [zlib.crc32(w[i : i + g]) % BUCKETS for g in GRAMS for i in range(len(w) - g + 1)]


def tokens(text: str | None) -> list[bytes]:
    """Words with their case; a mark stands after a word that repeats the one before it."""
    words = text.encode("utf-8", "replace").split() if text else []
    out, last = [], None
    for w in words:
        out.append(w)
        if w == last:
            out.append(REPEAT)
        last = w
    return out


@dataclass
class Model:
    """``vectors`` (BUCKETS x DIM), ``out`` (DIM x 2) and ``bias`` (2)."""

    vectors: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    def __post_init__(self) -> None:
        # The output is linear in the average, so each bucket adds a fixed number to the margin of class 1.
        self.gain = self.vectors @ (self.out[:, 1] - self.out[:, 0])
        f = word_features(REPEAT)
        self.again = (float(self.gain[f].sum()), float(len(f)))
        self.forget()

    def __getstate__(self) -> dict:
        return {"vectors": self.vectors, "out": self.out, "bias": self.bias}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.__post_init__()

    def forget(self) -> None:
        self.words, self.sums, self.sizes = Interner(), np.zeros(1024), np.zeros(1024)

    def learn(self, new: tuple[np.ndarray, np.ndarray]) -> None:
        packed, lens = new
        n, words = self.words.size - len(lens), split_words(packed, lens)
        while self.words.size > len(self.sums):
            self.sums, self.sizes = np.concatenate([self.sums, self.sums]), np.concatenate([self.sizes, self.sizes])
        found = [word_features(w) for w in words]
        size = np.fromiter(map(len, found), np.int64, len(found))
        gains = self.gain[np.fromiter(chain.from_iterable(found), np.int64, int(size.sum()))]
        self.sums[n : self.words.size], self.sizes[n : self.words.size] = np.add.reduceat(gains, np.cumsum(size) - size), size

    def plain(self, text: bytes) -> tuple[float, float]:
        f = [self.gain[x] for w in tokens(text.decode()) for x in word_features(w)]
        return float(sum(f)), float(len(f))

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """The softmax output for class 1 of each text; one without words has that of the bias."""
        out = np.empty(len(texts))
        at, held, size = 0, [], 0
        for k, t in enumerate(texts):
            held.append(t)
            size += len(t)
            if size > SLICE or k == len(texts) - 1:
                out[at : k + 1] = self._slice(held)
                at, held, size = k + 1, [], 0
        return out

    def _slice(self, texts: list[bytes]) -> np.ndarray:
        if self.words.size > KEPT_WORDS:
            self.forget()
        packed, starts, counts = packed_words(texts)
        total, size = np.zeros(len(texts)), np.zeros(len(texts))
        if len(starts):
            text = np.repeat(np.arange(len(texts)), counts)
            at = self.words.numbers(packed, starts, self.learn)
            safe = np.maximum(at, 0)
            total = np.bincount(text, self.sums[safe], len(texts))
            size = np.bincount(text, self.sizes[safe], len(texts))
            twice = text[1:][(at[1:] == at[:-1]) & (text[1:] == text[:-1])]
            n = np.bincount(twice, minlength=len(texts))
            total, size = total + n * self.again[0], size + n * self.again[1]
            for k in np.unique(text[at < 0]).tolist():  # a word that shares its hash with another one
                total[k], size[k] = self.plain(texts[k])
        margin = np.divide(total, size, out=np.zeros(len(texts)), where=size > 0) + self.bias[1] - self.bias[0]
        return 1 / (1 + np.exp(-np.clip(margin, -50, 50)))

    def score(self, text: str | None) -> float:
        return float(self.scores([(text or "").encode("utf-8", "replace")])[0])


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> Model:
    """Stochastic gradient descent over ``(buckets, counts, label)``; without rows all scores are one half."""
    rng = np.random.default_rng(seed)
    e, w, b = rng.normal(0, 0.1, (BUCKETS, DIM)), rng.normal(0, 0.5, (DIM, 2)), np.zeros(2)
    if not rows:
        return Model(e, np.zeros((DIM, 2)), b)
    steps, done = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)).tolist():
            f, n, y = rows[i]
            rate = RATE * (1 - done / steps)
            done += 1
            x = n / n.sum() if len(n) else n
            h = x @ e[f] if len(n) else np.zeros(DIM)
            z = h @ w + b
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            if len(n):
                e[f] -= (rate * len(f) ** 0.5) * np.outer(x, w @ p)
            w -= rate * np.outer(h, p)
            b -= 0.1 * rate * p
    return Model(e, w, b)


def train(df: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on labelled rows of ``df``; ``SAMPLE_DOCS`` of them at most, the lowest by a hash of the id.

    Labels other than 0 and 1, null ids and null labels are left out; an id with both labels counts twice.
    """
    ship_package(df.sparkSession)
    picked = labels.where(labels[id_col].isNotNull() & labels[label_col].isin(0, 1)).select(labels[id_col].alias("__id"), labels[label_col].alias("__y")).distinct()
    picked = first_by_hash(picked, SAMPLE_DOCS, "__id", "__y")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ys, fs, ns = b.column(0).to_pylist(), [], []
            for t in b.column(1):
                n = np.zeros(BUCKETS, np.int64)
                known: dict[bytes, list[int]] = {}
                for w in tokens(t.as_py()):
                    if w not in known:
                        if len(known) > KEPT_WORDS:
                            known = {}
                        known[w] = word_features(w)
                    for k in known[w]:
                        n[k] += 1
                f = np.nonzero(n)[0]
                fs.append(f.astype(np.int32))
                ns.append(n[f].astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(ys, pa.int32()), pa.array(fs, pa.list_(pa.int32())), pa.array(ns, pa.list_(pa.int32()))], names=["y", "f", "n"])

    # One row of a label for each id: of rows with equal ids the longest text's, then the first in order.
    docs = df.select(df[id_col].alias("__id"), text_of(df, text_col).alias("__t")).join(F.broadcast(picked), "__id")
    docs = docs.groupBy("__id", "__y").agg(F.max_by("__t", F.struct(F.length("__t"), "__t")).alias("__t"))
    got = docs.select(F.col("__y").cast("int"), "__t", "__id").mapInArrow(lambda it: _tagged(features, it), "y int, f array<int>, n array<int>, id long").toArrow()
    rows = sorted(zip(got["id"].to_pylist(), got["y"].to_pylist(), got["f"], got["n"]), key=lambda r: r[:2])
    return fit([(f.values.to_numpy(), n.values.to_numpy().astype(float), y) for _, y, f, n in rows])


def _tagged(features, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for x in features([b]):
            yield pa.RecordBatch.from_arrays([*x.columns, b.column(2).cast(pa.int64())], names=["y", "f", "n", "id"])


def score_column(model: Model, text: Column) -> Column:
    """The score of a text column, null counting as empty."""
    shared = SparkSession.getActiveSession().sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(texts.cast(pa.binary()).to_pylist()), pa.float64())

    return score(F.coalesce(text, F.lit("")))


def held_out(doc_id: Column) -> Column:
    return bucket(doc_id, 5) == 0


def trained(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    """The model for ``labels.quality``, from documents whose crc32 of the id modulo 5 is not 0."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return train(docs, labels.where(~held_out(labels["doc_id"])))


def op9_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document of the whole table."""
    docs = documents(spark, sf_dir)
    out = docs.select("doc_id", held_out(docs["doc_id"]).alias("held_out"), score_column(trained(spark, docs, sf_dir), docs["text"]).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
