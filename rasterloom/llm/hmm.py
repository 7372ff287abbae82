"""A hidden Markov language model: Baum-Welch over all training text, exact scaled forward scores.

The most frequent words are symbols of their own; other words share a symbol with words
of like shape (first byte and last two bytes). A word of such a class has its share of
the class's training count, and all unknown words of a class together the share of the
class's words met once, as in the Good-Turing estimate. So the model is a distribution
over known words, one unknown word for each class, and the end.

Word counts are aggregated across partitions, and so are the expected counts of each
Baum-Welch round, from every token of every training text. The tables that tasks get
are bounded: ``TABLE`` words with their counts, ``CLASSES`` classes, and the parameters.
The counts of other words are joined.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.llm.common import bucket, documents, first_by_hash, materialize, packed_words, remove, ship_package, text_of, work_dir
from rasterloom.llm.interning import Interner

STATES, SINGLES, CLASSES, TABLE = 8, 16_384, 2048, 200_000
#: Training sequences are cut after so many tokens; a cut has an initial distribution of its own.
SEGMENT, BATCH = 256, 1024
#: Parameters start from rounds over this many training texts, chosen by a hash; then come rounds over all.
SEED_DOCS, SEED_ROUNDS, ROUNDS = 800, 25, 2
KEPT_WORDS = 1_000_000
#: Symbols that a scoring task holds at a time.
HELD_BYTES = 8_000_000
SLICE = 1 << 20
END = SINGLES + CLASSES


def segments_of(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words of some texts, lower-cased and packed together; where each begins; how many each text has."""
    return packed_words([t.lower() for t in texts])


def shape(word: bytes) -> int:
    return zlib.crc32(word[:1] + word[-2:]) % CLASSES


def shape_column(word):
    """The same class in Spark; ``word`` is binary."""
    return F.crc32(F.concat(F.substring(word, 1, 1), F.substring(word, -2, 2))) % F.lit(CLASSES)


def slices(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Texts in slices of bounded size, with the row of the first; null counts as empty."""
    at, held, size = 0, [], 0
    for k, t in enumerate(column.cast(pa.binary()).to_pylist()):
        held.append(t or b"")
        size += len(held[-1])
        if size > SLICE:
            yield at, held
            at, held, size = k + 1, [], 0
    if held:
        yield at, held


def word_counts(texts: DataFrame) -> DataFrame:
    """``word binary, c long`` over a column ``text``; each task adds up before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total, odd = Interner(), np.zeros(0, np.int64), Counter()

        def out() -> Iterator[pa.RecordBatch]:
            for at in range(0, table.size, 100_000):
                n = min(100_000, table.size - at)
                ends = np.append(table.begins[at : at + n], table.begins[at + n - 1] + table.lens[at + n - 1])
                base = int(ends[0])
                offsets = pa.py_buffer((ends - base).astype(np.int32).tobytes())
                words = pa.Array.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(table.store[base : int(ends[-1])].tobytes())])
                yield pa.RecordBatch.from_arrays([words, pa.array(total[at : at + n])], names=["word", "c"])
            if odd:
                yield pa.RecordBatch.from_arrays([pa.array(list(odd), pa.binary()), pa.array(list(odd.values()), pa.int64())], names=["word", "c"])

        for b in batches:
            for _, part in slices(b.column(0)):
                packed, starts, _ = segments_of(part)
                if not len(starts):
                    continue
                at = table.numbers(packed, starts, lambda *_: None)
                if (clash := np.nonzero(at < 0)[0]).size:
                    ends = np.append(starts[1:], len(packed))
                    odd.update(packed[starts[k] : ends[k]] for k in clash.tolist())
                    at = at[at >= 0]
                n = np.bincount(at, minlength=table.size).astype(np.int64)
                n[: len(total)] += total
                total = n
                if table.size > KEPT_WORDS:
                    yield from out()
                    table.reset()
                    odd.clear()
                    total = np.zeros(0, np.int64)
        yield from out()

    return texts.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """What the corpus counts say: ``words`` with ``counts`` (the most frequent ones), of all classes the counts of their words and of those met once, the count of ends, of tokens and of distinct tokens."""

    words: list[bytes]
    counts: np.ndarray
    class_counts: np.ndarray
    class_once: np.ndarray
    ends: int
    tokens: int
    distinct: int

    def __post_init__(self) -> None:
        self.log_floor = np.log10(self.tokens + self.distinct + 1)
        self.unknown = self.class_once + 1.0
        self.class_log = np.log10(self.class_counts + self.unknown)
        self.symbols = np.array([k if k < SINGLES else SINGLES + shape(w) for k, w in enumerate(self.words)], np.int64)
        single = np.arange(len(self.words)) < SINGLES
        with np.errstate(divide="ignore"):
            self.own = np.where(single, 0.0, np.log10(self.counts) - self.class_log[np.where(single, 0, self.symbols - SINGLES)])
        self.table = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"table": None}

    def lookup(self) -> Interner:
        if self.table is None:
            self.table = Interner()
            starts = np.cumsum([0, *map(len, self.words[:-1])]) if self.words else np.zeros(0, np.int64)
            if self.words and (self.table.numbers(b"".join(self.words), starts, lambda *_: None) != np.arange(len(self.words))).any():
                raise ValueError("two words of the table share a hash")
        return self.table

    def unigram(self) -> np.ndarray:
        n = np.zeros(END + 1)
        np.add.at(n, self.symbols, self.counts)
        n[SINGLES:END] = self.class_counts
        n[END] = self.ends
        return (n + 0.5) / (n + 0.5).sum()


def vocabulary(counts: DataFrame, ends: int) -> Vocabulary:
    """From the table of counts. The least count in the table of words is set so that at most ``TABLE`` words have it."""
    bins = F.when(F.col("c") < 1024, F.col("c")).otherwise(1024 + F.floor(F.log2("c") * 64)).alias("bin")
    by = counts.groupBy(bins).agg(F.count("*").alias("n"), F.min("c").alias("least"), F.sum("c").alias("c")).orderBy(F.desc("bin")).collect()
    kept, least = 0, 1 << 62
    for r in by:
        if kept + r["n"] > TABLE:
            break
        kept, least = kept + r["n"], r["least"]
    top = counts.where(F.col("c") >= least).toArrow() if kept else pa.table({"word": pa.array([], pa.binary()), "c": pa.array([], pa.int64())})
    rows = sorted(zip(top["c"].to_pylist(), top["word"].to_pylist()), key=lambda r: (-r[0], r[1]))
    words, n = [w for _, w in rows], np.array([c for c, _ in rows], np.int64)
    class_counts, class_once = np.zeros(CLASSES), np.zeros(CLASSES)
    grouped = counts.where(F.col("c") < least).groupBy(shape_column(F.col("word")).alias("s")).agg(F.sum("c").alias("c"), F.count_if(F.col("c") == 1).alias("once"))
    for r in grouped.collect():
        class_counts[r["s"]], class_once[r["s"]] = r["c"], r["once"]
    for w, c in zip(words[SINGLES:], n[SINGLES:].tolist()):
        class_counts[shape(w)] += c
        class_once[shape(w)] += c == 1
    total, distinct = sum(r["c"] for r in by), sum(r["n"] for r in by)
    return Vocabulary(words, n, class_counts, class_once, ends, total + ends, distinct + bool(ends))


ENCODED = "doc_id long, held_out boolean, symbols binary, n_tokens long, n_known long, base double, own double, rare string"


def encode(rows: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Symbols of each text and the end; sums over words of the table; the other words in ``rare``, between spaces."""
    shared = rows.sparkSession.sparkContext.broadcast(vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        table, log_count = v.lookup(), np.log10(v.counts + 1.0)
        for b in batches:
            ids, held = b.column(0).to_pylist(), b.column(1).to_pylist()
            for at, part in slices(b.column(2)):
                packed, starts, counts = segments_of(part)
                k = table.numbers(packed, starts, None) if len(starts) else np.zeros(0, np.int64)
                known = k >= 0
                safe = np.where(known, k, 0)
                symbols = np.where(known, v.symbols[safe], 0) if len(v.words) else np.zeros(len(k), np.int64)
                ends = np.append(starts[1:], len(packed)) if len(starts) else starts
                new = np.nonzero(~known)[0]
                others = [packed[s:e] for s, e in zip(starts[new].tolist(), ends[new].tolist())]
                symbols[new] = [SINGLES + shape(w) for w in others]
                base = np.where(known, log_count[safe], 0.0) if len(v.words) else np.zeros(len(k))
                own = np.where(known, v.own[safe], 0.0) if len(v.words) else np.zeros(len(k))
                stop = np.cumsum(counts)
                rare_stop = np.searchsorted(new, stop, "left").tolist()
                out, begin, r = [], 0, 0
                for j, (e, x) in enumerate(zip(stop.tolist(), rare_stop)):
                    s = np.append(symbols[begin:e], END).astype("<u2").tobytes()
                    n = e - begin
                    out.append((ids[at + j], held[at + j], s, n + 1, n - (x - r) + (v.ends > 0), float(base[begin:e].sum() + np.log10(v.ends + 1)), float(own[begin:e].sum()), b" ".join(others[r:x]).decode() if x > r else None))
                    begin, r = e, x
                types = (pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["doc_id", "held_out", "symbols", "n_tokens", "n_known", "base", "own", "rare"])

    return rows.mapInArrow(run, ENCODED)


@dataclass
class Parameters:
    """Initial distributions of texts and of cuts (K), transitions (K x K) and emissions (symbols x K)."""

    start: np.ndarray
    cut: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def random_parameters(unigram: np.ndarray, states: int = STATES, seed: int = 3) -> Parameters:
    rng = np.random.default_rng(seed)
    emit = unigram[:, None] * rng.gamma(2.0, 0.5, (len(unigram), states))
    move = np.full((states, states), 0.2 / states) + 0.8 * np.eye(states)
    even = np.full(states, 1 / states)
    return Parameters(even, even, move / move.sum(1, keepdims=True), emit / emit.sum(0))


def lay_out(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences side by side, the longest first: symbols (T x n), how many are as long as each step, and the order."""
    lens = np.array([len(s) for s in seqs])
    order = np.argsort(-lens, kind="stable")
    obs = np.zeros((int(lens.max()), len(seqs)), np.int64)
    for col, k in enumerate(order.tolist()):
        obs[: lens[k], col] = seqs[k]
    active = np.searchsorted(-lens[order], -np.arange(len(obs)), "left")
    return obs, active, order


def expectations(seqs: list[np.ndarray], first: np.ndarray, p: Parameters) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected counts of starts, cuts, moves and emissions over sequences, and their log likelihood."""
    obs, active, order = lay_out(seqs)
    steps, n = obs.shape
    k = len(p.start)
    first = first[order]
    alpha, scale = np.zeros((steps, n, k)), np.ones((steps, n))
    a = np.where(first[:, None], p.start, p.cut) * p.emit[obs[0]]
    for t in range(steps):
        m = active[t]
        if t:
            a = (alpha[t - 1, :m] @ p.move) * p.emit[obs[t, :m]]
        s = a.sum(1)
        scale[t, :m] = s
        alpha[t, :m] = a / s[:, None]
    moves = np.zeros((k, k))
    gamma = alpha.copy()
    beta = np.ones((n, k))
    for t in range(steps - 2, -1, -1):
        m = active[t + 1]
        w = p.emit[obs[t + 1, :m]] * beta[:m] / scale[t + 1, :m, None]
        moves += alpha[t, :m].T @ w
        beta[:m] = w @ p.move.T
        gamma[t, :m] *= beta[:m]
    moves *= p.move
    valid = np.arange(n)[None, :] < active[:, None]
    flat, g = obs[valid], gamma[valid]
    emits = np.stack([np.bincount(flat, weights=g[:, j], minlength=len(p.emit)) for j in range(k)], 1)
    return gamma[0][first].sum(0), gamma[0][~first].sum(0), moves, emits, float(np.log(scale).sum())


def forward(seqs: list[np.ndarray], p: Parameters) -> np.ndarray:
    """log10 of each sequence's exact likelihood, by the scaled forward recursion."""
    obs, active, order = lay_out(seqs)
    total = np.zeros(len(seqs))
    a = p.start * p.emit[obs[0]]
    for t in range(len(obs)):
        m = active[t]
        if t:
            a = (a[:m] @ p.move) * p.emit[obs[t, :m]]
        s = a.sum(1)
        total[:m] += np.log10(s)
        a = a / s[:, None]
    out = np.empty(len(seqs))
    out[order] = total
    return out


def maximise(starts: np.ndarray, cuts: np.ndarray, moves: np.ndarray, emits: np.ndarray, unigram: np.ndarray) -> Parameters:
    """New parameters, smoothed so that no symbol is impossible."""
    emit = emits + 5.0 * unigram[:, None]
    move = moves + 0.5
    norm = lambda x: (x + 0.1) / (x + 0.1).sum()
    return Parameters(norm(starts), norm(cuts), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def cut_segments(symbols: bytes) -> list[np.ndarray]:
    s = np.frombuffer(symbols, "<u2").astype(np.int64)
    return [s[k : k + SEGMENT] for k in range(0, len(s), SEGMENT)]


def batches_of(texts: Iterator[bytes]) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    seqs, first = [], []
    for t in texts:
        for k, s in enumerate(cut_segments(t)):
            seqs.append(s)
            first.append(k == 0)
            if len(seqs) == BATCH:
                yield seqs, np.array(first)
                seqs, first = [], []
    if seqs:
        yield seqs, np.array(first)


def baum_welch_round(train: DataFrame, p: Parameters, unigram: np.ndarray) -> Parameters:
    """One round over all of ``train(symbols)``. Each task adds up its expected counts; a row for each symbol and task is shuffled."""
    shared = train.sparkSession.sparkContext.broadcast(p)
    k = len(p.start)
    names = [f"g{j}" for j in range(k)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        total = np.zeros((len(p.emit) + k + 2, k))
        for seqs, first in batches_of(t.as_py() for b in batches for t in b.column(0)):
            s, c, m, e, _ = expectations(seqs, first, p)
            total[: len(e)] += e
            total[len(e) : len(e) + k] += m
            total[-2:] += (s, c)
        at = np.nonzero(total.sum(1))[0]
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *(pa.array(total[at, j]) for j in range(k))], names=["at", *names])

    summed = train.select("symbols").mapInArrow(run, "at int, " + ", ".join(f"{n} double" for n in names)).groupBy("at").agg(*(F.sum(n).alias(n) for n in names)).toPandas()
    total = np.zeros((len(p.emit) + k + 2, k))
    total[summed["at"].to_numpy()] = summed[names].to_numpy()
    return maximise(total[-2], total[-1], total[len(p.emit) : len(p.emit) + k], total[: len(p.emit)], unigram)


def fit(train: DataFrame, vocab: Vocabulary) -> Parameters:
    """Rounds over a small sample find the states' rough meaning; rounds over all training text make the parameters."""
    unigram = vocab.unigram()
    p = random_parameters(unigram)
    seed = [bytes(r["symbols"]) for r in first_by_hash(train.select("doc_id", "symbols"), SEED_DOCS, "doc_id", "symbols").collect()]
    if not seed:
        return p
    for _ in range(SEED_ROUNDS):
        sums = None
        for seqs, first in batches_of(iter(seed)):
            got = expectations(seqs, first, p)[:4]
            sums = got if sums is None else [a + b for a, b in zip(sums, got)]
        p = maximise(*sums, unigram)
    for _ in range(ROUNDS):
        p = baum_welch_round(train, p, unigram)
    return p


def likelihoods(encoded: DataFrame, p: Parameters) -> DataFrame:
    """``log10 likelihood`` of each row's symbols as ``hmm``, the other columns but ``symbols`` and ``rare`` kept."""
    shared = encoded.sparkSession.sparkContext.broadcast(p)
    keep = ["rid", "doc_id", "held_out", "n_tokens", "n_known", "base", "own"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:  # many texts at once share the steps of the recursion
            held.append(b)
            size += b.nbytes
            if size > HELD_BYTES:
                yield scored(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                held, size = [], 0
        if sum(b.num_rows for b in held):
            yield scored(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    def scored(b: pa.RecordBatch) -> pa.RecordBatch:
        out = np.empty(b.num_rows)
        seqs = [np.frombuffer(s.as_py(), "<u2").astype(np.int64) for s in b.column(len(keep))]
        order = sorted(range(len(seqs)), key=lambda k: len(seqs[k]))
        at = 0
        while at < len(order):  # texts of like length together, the padded size bounded
            stop = at + 1
            while stop < len(order) and stop - at < 2048 and (stop - at + 1) * len(seqs[order[stop]]) <= 4_000_000:
                stop += 1
            out[order[at:stop]] = forward([seqs[k] for k in order[at:stop]], shared.value)
            at = stop
        return pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(out)], names=[*keep, "hmm"])

    kinds = "rid long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, own double, hmm double"
    return encoded.select(*keep, "symbols").mapInArrow(run, kinds)


def score_documents(df: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for each row.

    Learns from rows that ``held_out`` doesn't mark. Null and empty texts have the end
    alone; repeated rows count and are scored each; a null id is kept. With no training
    rows every word is unknown and the base score is 0. An empty table gives an empty
    table; other columns are not read.
    """
    spark = df.sparkSession
    ship_package(spark)
    rows = df.select(df[id_col].cast("long").alias("doc_id"), held_out.alias("held_out"), text_of(df, text_col).alias("text"))
    train = rows.where(~F.col("held_out"))
    counts = materialize(word_counts(train.select("text")))
    ends = train.count()
    vocab = vocabulary(counts, ends)
    path = work_dir(spark)
    encoded = materialize(encode(rows, vocab).withColumn("rid", F.monotonically_increasing_id()), path)
    p = fit(encoded.where(~F.col("held_out")), vocab)
    scored = materialize(likelihoods(encoded, p))
    classes = spark.createDataFrame(list(zip(range(CLASSES), vocab.unknown.tolist(), vocab.class_log.tolist())), "s long, unknown double, log double")
    rare = encoded.where("rare IS NOT NULL").select("rid", F.explode(F.split("rare", " ")).alias("w")).select("rid", F.col("w").cast("binary").alias("word"))
    met = rare.join(counts, "word", "left").withColumn("s", shape_column(F.col("word"))).join(F.broadcast(classes), "s")
    sums = met.groupBy("rid").agg(
        F.count("c").alias("known"), F.sum(F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("base_more"), F.sum(F.log10(F.coalesce(F.col("c").cast("double"), "unknown")) - F.col("log")).alias("own_more")
    )
    sums = materialize(sums)
    remove(spark, path)
    out = scored.join(sums, "rid", "left")
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_more", F.lit(0.0)) - F.col("n_tokens") * F.lit(float(vocab.log_floor))).alias("base_score"),
        (F.col("hmm") + F.col("own") + F.coalesce("own_more", F.lit(0.0))).alias("score"),
    )


def op2_hidden_markov_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log likelihood of every document of the whole table, learned from those whose crc32 of the id modulo 7 is not 2."""
    docs = documents(spark, sf_dir)
    return score_documents(docs, bucket(docs["doc_id"], 7) == 2)
