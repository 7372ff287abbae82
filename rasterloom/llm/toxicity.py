"""Toxicity by compression distance with zstandard dictionaries.

Both dictionaries come from zstandard's trainer. That of ordinary text is trained on
ordinary windows, and holds the ordinary windows besides that look toxic otherwise. That
of toxic text holds the same, so that ordinary text compresses alike, and a part trained
on toxic spans. Which spans of a toxic text are toxic isn't labelled: they are the words
met in many unrelated toxic texts and hardly in others, by a likelihood ratio test. (The
README has the figures of dictionaries trained on all windows of toxic texts.) A window
that the second dictionary compresses better is evidence for toxicity; how much, is
learned for each difference of lengths. A text's evidence is summed and calibrated to a
probability; both on a quarter of the labelled texts that trained neither dictionary.
"""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.llm.common import bucket, documents, first_by_hash, ship_package, text_of

WINDOW_WORDS, LEVEL = 4, 3
#: Sizes of the trained parts; ordinary windows are added in so many rounds, those alone that gain so many bytes.
BASE_BYTES, TOXIC_BYTES, HARD_BYTES, HARD_ROUNDS, HARD_GAIN = 16_384, 4096, 32_768, 5, 2
#: The trainer takes this many ordinary windows at most, drawn at random.
TRAIN_WINDOWS = 60_000
#: The dictionaries are fitted on this many labelled documents of each class at most, chosen by a hash of their id.
SAMPLE_DOCS = 2500
#: A toxic word's least likelihood ratio, and the least ratio of its rates in both classes.
LEAST_RATIO, LEAST_RATE = 30.0, 4.0
#: One labelled text in so many calibrates; the others train.
CALIBRATE = 4
#: The trainer's length of a segment and of what it counts.
COVER = (50, 6)
LOW, HIGH = -1, 12
THRESHOLD = 0.7
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def windows(text: str | None) -> Iterator[bytes]:
    """Windows of four words between spaces; lower case, other ASCII than letters left out."""
    words = text.encode("utf-8", "replace").translate(_LETTERS).split() if text else []
    for at in range(0, len(words), WINDOW_WORDS):
        yield b" " + b" ".join(words[at : at + WINDOW_WORDS]) + b" "


@dataclass
class Model:
    """Both dictionaries' content, the evidence of each difference from ``LOW`` to ``HIGH``, and the calibration's points."""

    ordinary: bytes
    toxic: bytes
    evidence: np.ndarray
    sums: np.ndarray
    scores: np.ndarray

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "pair"}

    def differences(self, text: str | None) -> np.ndarray:
        """For each window by how many bytes the toxic dictionary compresses better, within ``LOW`` and ``HIGH``, counted from ``LOW``."""
        if not hasattr(self, "pair"):
            options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
            self.pair = [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), **options).compress if len(d) >= 8 else len_of for d in (self.ordinary, self.toxic)]
        a, b = self.pair
        return np.clip(np.fromiter((len(a(w)) - len(b(w)) for w in windows(text)), np.int64), LOW, HIGH) - LOW

    def total(self, text: str | None) -> float:
        return float(self.evidence[self.differences(text)].sum())

    def score(self, text: str | None) -> float:
        """Between 0 and 1; a text without words has no evidence."""
        return float(np.interp(self.total(text), self.sums, self.scores))


def len_of(window: bytes) -> bytes:
    return window


def families(texts: list[str]) -> list[int]:
    """A number for each text that copies and near copies share: texts are joined by any of eight least hashes of their five-word shingles."""
    parent = list(range(len(texts)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first: dict[tuple, int] = {}
    for i, t in enumerate(texts):
        w = t.encode("utf-8", "replace").lower().split() if t else []
        h = np.array([xxhash.xxh64_intdigest(b" ".join(w[k : k + 5])) for k in range(max(1, len(w) - 4))], np.uint64)
        for k in range(8):
            j = find(first.setdefault((k, int((h * np.uint64(2 * k + 1) ^ (h >> np.uint64(5 * k + 9))).min())), i))
            parent[max(find(i), j)] = min(find(i), j)
    return [find(i) for i in range(len(texts))]


def telling(toxic: list[str], ordinary: list[str]) -> set[bytes]:
    """Words of many families of toxic texts and few of ordinary ones."""

    def counted(texts: list[str]) -> tuple[dict[bytes, int], int]:
        of, groups = defaultdict(set), families(texts)
        for t, f in zip(texts, groups):
            for w in set((t or "").encode("utf-8", "replace").translate(_LETTERS).split()):
                of[w].add(f)
        return {w: len(f) for w, f in of.items()}, len(set(groups))

    a_of, na = counted(toxic)
    b_of, nb = counted(ordinary)

    def fit(k: int, n: int, p: float) -> float:
        return (k * math.log(p) if k else 0.0) + ((n - k) * math.log(1 - p) if n > k else 0.0)

    found = set()
    for w, a in a_of.items():
        b = b_of.get(w, 0)
        if na and nb and a / na >= LEAST_RATE * (b + 0.5) / nb:
            p = (a + b) / (na + nb)
            ratio = 2 * (fit(a, na, a / na) + fit(b, nb, b / nb) - fit(a, na, p) - fit(b, nb, p))
            if ratio >= LEAST_RATIO:
                found.add(w)
    return found


def spans(texts: list[str], words: set[bytes]) -> list[bytes]:
    """Every place of one of ``words`` in the texts, with the spaces around it."""
    return [b" " + w + b" " for t in texts for w in (t or "").encode("utf-8", "replace").translate(_LETTERS).split() if w in words]


def dictionary(samples: list[bytes], size: int) -> bytes:
    """What zstandard's trainer makes of the samples; where they are too few for it, the distinct ones in a row."""
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(size, samples, k=COVER[0], d=COVER[1]).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[:size]


def trained(samples: list[bytes], size: int) -> bytes:
    """Dictionaries in a row, ``size`` bytes at most: each is trained on the samples that those before it don't hold.

    Samples that the trainer leaves out every time, as it does with few short ones, are
    put in a row.
    """
    out = b""
    while samples and len(out) < size:
        room = size - len(out)
        more = dictionary(samples, room) if room >= 256 else b""
        rest = [w for w in samples if w not in more]
        if len(rest) == len(samples):
            more, rest = b"".join(dict.fromkeys(samples))[:room], []
        # What a match costs grows with its distance, so that the first, most frequent part stands last.
        out, samples = more + out, rest
    return out


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the weighted isotonic regression of ``y`` on ``x``."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []
    for a, b, w in zip(x[order].tolist(), y[order].tolist(), weight[order].tolist()):
        blocks.append([a * w, b * w, w])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def fit(toxic: list[str], ordinary: list[str], share: float, seed: int = 11) -> Model:
    """From labelled texts of both classes; ``share`` of all labelled texts are toxic. If a class has none, all scores are ``share``."""
    if not toxic or not ordinary:
        return Model(b"", b"", np.zeros(HIGH - LOW + 1), np.array([0.0]), np.array([share]))
    rng = random.Random(seed)
    learn = [[t for k, t in enumerate(texts) if k % CALIBRATE] for texts in (toxic, ordinary)]
    check = [texts[::CALIBRATE] for texts in (toxic, ordinary)]
    told = trained(spans(learn[0], telling(*learn)), TOXIC_BYTES)
    plain = [w for t in learn[1] for w in windows(t)]
    base = dictionary(rng.sample(plain, min(len(plain), TRAIN_WINDOWS)), BASE_BYTES)
    hard, none = b"", np.zeros(HIGH - LOW + 1)
    for _ in range(HARD_ROUNDS if told else 0):
        m = Model(base + hard, base + hard + told, none, none, none)
        seen = Counter()
        for t in learn[1]:
            for w, d in zip(windows(t), m.differences(t).tolist()):
                if d + LOW >= HARD_GAIN:
                    seen[w] = d
        if not seen:
            break
        hard += b"".join(w for w, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0])))[:HARD_BYTES]
    m = Model(base + hard, base + hard + told, none, none, none)
    counts = [[np.bincount(m.differences(t), minlength=HIGH - LOW + 1) for t in texts] for texts in check]
    a, b = (np.sum(c, axis=0) + 1.0 for c in counts)
    m.evidence = np.log(a / a.sum()) - np.log(b / b.sum())
    x = np.array([c @ m.evidence for part in counts for c in part])
    y = np.repeat([1.0, 0.0], [len(c) for c in counts])
    weight = np.repeat([share / len(counts[0]), (1 - share) / len(counts[1])], [len(c) for c in counts])
    m.sums, m.scores = isotonic(x, y, weight)
    # A slight slope keeps the order of texts within a level.
    m.scores = np.clip(m.scores * 0.98 + 0.02 * np.arange(len(m.scores)) / max(1, len(m.scores) - 1), 0, 1)
    return m


def train(df: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on ``SAMPLE_DOCS`` labelled rows of each class at most; other labels than 0 and 1 and null ids are left out."""
    known = labels.where(labels[id_col].isNotNull() & labels[label_col].isin(0, 1)).select(labels[id_col].alias("__id"), labels[label_col].cast("int").alias("__y")).distinct()
    sizes = {r["__y"]: r["count"] for r in known.groupBy("__y").count().collect()}
    texts: dict[int, list[str]] = {}
    for y in (0, 1):
        picked = first_by_hash(known.where(F.col("__y") == y), SAMPLE_DOCS, "__id")
        rows = df.select(df[id_col].alias("__id"), text_of(df, text_col).alias("__t")).join(F.broadcast(picked), "__id")
        got = rows.groupBy("__id").agg(F.max_by("__t", F.struct(F.length("__t"), "__t")).alias("__t")).toArrow()
        texts[y] = [t for _, t in sorted(zip(got["__id"].to_pylist(), got["__t"].to_pylist()), key=lambda r: (xxhash.xxh32_intdigest(str(r[0])), r[0]))]
    return fit(texts[1], texts[0], sizes.get(1, 0) / max(1, sum(sizes.values())))


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` for every row, whole texts however long; other columns are not read.

    Null counts as empty, and such texts get the score of no evidence; repeated rows and
    equal texts get equal scores, an empty table none.
    """
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shared.value.score(t.as_py()) for t in b.column(1)], pa.float64())], names=["doc_id", "score"])

    return df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].alias("text")).mapInArrow(run, "doc_id long, score double")


def op6_zstd_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from labelled ones whose crc32 of the id modulo 3 is not 1."""
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(docs, labels.where(bucket(labels["doc_id"], 3) != 1))
    out = score(docs, model)
    return out.select("doc_id", (bucket(out["doc_id"], 3) == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
