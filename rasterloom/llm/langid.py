"""Language identification with bit-sliced Bloom filters of n-grams.

One table of ``SLOTS`` bitmasks holds a Bloom filter for each language, bit by bit: the
masks at an n-gram's slots, ANDed, are the set of all languages that contain it. A
text's n-grams are counted for each language, the counts are corrected for the
filter's false positives and for how much of its own training text a language's
n-grams cover, and the language of the largest share is the prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rasterloom.llm.common import bucket, documents, ship_package, text_of

GRAM = 4
#: The training sample has about this many documents of each language, chosen by a hash of their id.
SAMPLE_DOCS = 2000
#: The most frequent values of the language column, beyond any real number of languages; others are not learned.
LANGUAGES = 4096
#: The most frequent n-grams of each language that its filter holds.
GRAMS = 16384
#: A language contains an n-gram if its rate there is at least this part of the rate in the language where it is most frequent.
RELATIVE = 0.2
SLOTS_LOG2, HASHES = 19, (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)
#: Bytes of a text that are looked at at a time; counts of the parts are added.
PART = 1 << 20
UND = "und"
_ASCII = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def grams(text: str) -> Iterator[np.ndarray]:
    """Codes of all 4-byte windows of the lower-cased text in UTF-8, other ASCII than letters counting as space; windows with two spaces in a row are left out."""
    raw = (" " + text + " ").lower().encode("utf-8", "replace").translate(_ASCII)
    b = np.frombuffer(raw, np.uint8)
    for at in range(0, len(b) - GRAM + 1, PART):
        w = b[at : at + PART + GRAM - 1]
        sp = w == 32
        two = sp[:-1] & sp[1:]
        w = w.astype(np.uint32)
        code = (w[:-3] << 24) | (w[1:-2] << 16) | (w[2:-1] << 8) | w[3:]
        yield code[~(two[:-2] | two[1:-1] | two[2:])]


def slots(code: np.ndarray) -> list[np.ndarray]:
    return [((code * np.uint32(h)) ^ (code >> np.uint32(15)) * np.uint32(h)) >> np.uint32(32 - SLOTS_LOG2) for h in HASHES]


@dataclass
class Model:
    """``table``: a mask of languages in each slot, 64 languages to a word."""

    langs: list[str]
    table: np.ndarray
    false_rate: np.ndarray
    cover: np.ndarray
    prior: int

    def counts(self, text: str) -> tuple[np.ndarray, int]:
        """For each language how many n-grams of the text its filter has, and the number of n-grams."""
        hits, total = np.zeros(len(self.langs), np.int64), 0
        for code in grams(text):
            total += len(code)
            a, b, c = slots(code)
            for word in range(self.table.shape[0]):
                t = self.table[word]
                mask = t[a] & t[b] & t[c]
                here = range(word * 64, min(len(self.langs), word * 64 + 64))
                if len(here) <= 12:
                    n = np.bincount(mask.astype(np.int64), minlength=1 << len(here))
                    every = np.arange(len(n))
                    for j, lang in enumerate(here):
                        hits[lang] += n[(every >> j & 1).astype(bool)].sum()
                else:
                    for j, lang in enumerate(here):
                        hits[lang] += int((mask >> np.uint64(j) & np.uint64(1)).sum())
        return hits, total

    def predict(self, text: str | None) -> tuple[str, float]:
        """``und`` with score 0 if the text is null or has no letter, or nothing was learned; of equal shares the first language in order."""
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return UND, 0.0
        hits, total = self.counts(text)
        if not total:
            return self.langs[self.prior], 0.0
        share = np.clip((hits / total - self.false_rate) / (1 - self.false_rate), 0, None) / self.cover
        if not share.any():
            return self.langs[self.prior], 0.0
        best = int(share.argmax())
        return self.langs[best], float(share[best] / share.sum())


def build(counts: dict[str, tuple[np.ndarray, np.ndarray, int]]) -> Model:
    """From each language's n-grams, their counts, and the count of all its n-grams."""
    langs = sorted(counts)
    table = np.zeros((max(1, -(-len(langs) // 64)), 1 << SLOTS_LOG2), np.uint64)
    false, cover = [], []
    for k, lang in enumerate(langs):
        code, n, total = counts[lang]
        bit = np.uint64(1 << (k % 64))
        for s in slots(code):
            table[k // 64, s] |= bit
        false.append(np.count_nonzero(table[k // 64] & bit) / table.shape[1])
        cover.append(max(n.sum() / max(total, 1), 0.05))
    prior = max(range(len(langs)), key=lambda k: counts[langs[k]][2], default=0)
    return Model(langs, table, np.array(false) ** len(HASHES), np.array(cover), prior)


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from ``df``'s rows with a language; about ``SAMPLE_DOCS`` of each are read, and their texts whole."""
    ship_package(df.sparkSession)
    rows = df.where(df[lang_col].isNotNull()).select(df[lang_col].cast("string").alias("lang"), F.pmod(F.xxhash64(df[id_col]), F.lit(1 << 20)).alias("h"), text_of(df, text_col).alias("text"))
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).select("lang", (F.lit(float(SAMPLE_DOCS << 20)) / F.col("count")).alias("below"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                code, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(code), pa.string()), pa.array(code.astype(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])
            held.clear()

        size = 0
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                for code in grams(text.as_py()):
                    held.setdefault(lang, []).append(code)
                    size += len(code)
                if size > 4_000_000:
                    yield from out()
                    size = 0
        yield from out()

    sample = rows.join(F.broadcast(sizes), "lang").where("h < below").select("lang", "text")
    grams_of = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = grams_of.groupBy("lang").agg(F.sum("n").alias("total"))
    rates = grams_of.join(F.broadcast(totals), "lang").withColumn("rate", F.col("n") / F.col("total"))
    rates = rates.withColumn("most", F.max("rate").over(Window.partitionBy("gram"))).where(F.col("rate") >= RELATIVE * F.col("most"))
    rank = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    # At most GRAMS rows of each language reach the driver, whatever the corpus.
    top = rates.select("lang", "gram", "n", "total", F.row_number().over(rank).alias("k")).where(F.col("k") <= GRAMS).toPandas()
    return build({lang: (g["gram"].to_numpy(np.uint32), g["n"].to_numpy(np.int64), int(g["total"].iloc[0])) for lang, g in top.groupby("lang")})


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` for every row, whole texts; other columns are not read."""
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [shared.value.predict(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in out], pa.string()), pa.array([y for _, y in out], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def op7_language_bitmask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those whose crc32 of the id modulo 3 is not 1."""
    docs = documents(spark, sf_dir)
    model = train(docs.where(bucket(docs["doc_id"], 3) != 1))
    out = predict(docs, model)
    return out.select("doc_id", (bucket(out["doc_id"], 3) == 1).alias("held_out"), "lang_pred", "score")
