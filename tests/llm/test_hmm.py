import math
import random
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.llm import hmm as H
from rasterloom.llm.common import bucket


def words(t):
    low = "".join(c.lower() if c.isascii() else c for c in t or "")
    for c in "\t\n\r\x0b\x0c":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w]


def brute_base(rows):
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    c, ends = Counter(), 0
    for i, t in rows:
        if not held(i):
            c.update(words(t))
            ends += 1
    n, v = sum(c.values()) + ends, len(c) + bool(ends)
    out = []
    for i, t in rows:
        ws = words(t)
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws) + math.log10((ends + 1) / (n + v + 1))
        out.append((i, held(i), len(ws) + 1, sum(c[w] > 0 for w in ws) + (ends > 0), n, round(base, 6)))
    return sorted(out, key=str)


def corpus(rng, n):
    vocab = [["".join(rng.choice(s) for _ in range(rng.randrange(1, 4))) for _ in range(60)] for s in (["ka", "lo", "É"], ["sch", "ung", "Te"])]
    rows = [(i, " ".join(rng.choice(vocab[i % 2]) for _ in range(rng.randrange(1, 120)))) for i in range(n)]
    return rows + [(1000, None), (1001, ""), (1002, " \n\x0b"), (None, "ka lo"), (1003, "ka"), (1003, "ka"), (1004, "zz " * 3000)]


@pytest.mark.parametrize("table", [6, 200_000])
def test_counts_base_and_likelihood(spark, monkeypatch, table):
    monkeypatch.setattr(H, "TABLE", table)
    rows = corpus(random.Random(1), 150)
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    out = H.score_documents(df, bucket(df["doc_id"], 7) == 2).collect()
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out]
    assert sorted(got, key=str) == brute_base(rows)
    held = [r for r in out if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_forward_and_expectations_match_all_paths():
    rng = np.random.default_rng(2)
    k, s = 3, 5
    norm = lambda x, a: x / x.sum(a, keepdims=True)
    p = H.Parameters(norm(rng.random(k), 0), norm(rng.random(k), 0), norm(rng.random((k, k)), 1), norm(rng.random((s, k)), 0))
    seqs = [rng.integers(0, s, n) for n in (1, 4, 2, 4)]
    first = np.array([True, False, True, True])
    starts, cuts, moves, emits, ll = H.expectations(seqs, first, p)
    want = [np.zeros(k), np.zeros(k), np.zeros((k, k)), np.zeros((s, k))]
    logs = []
    for seq, f in zip(seqs, first):
        paths = {}
        for z in product(range(k), repeat=len(seq)):
            x = (p.start if f else p.cut)[z[0]] * p.emit[seq[0], z[0]]
            for t in range(1, len(seq)):
                x *= p.move[z[t - 1], z[t]] * p.emit[seq[t], z[t]]
            paths[z] = x
        total = sum(paths.values())
        logs.append(math.log(total))
        for z, x in paths.items():
            want[0 if f else 1][z[0]] += x / total
            for t in range(len(seq)):
                want[3][seq[t], z[t]] += x / total
                if t:
                    want[2][z[t - 1], z[t]] += x / total
    for a, b in zip((starts, cuts, moves, emits), want):
        assert np.allclose(a, b)
    assert np.isclose(ll, sum(logs))
    p.cut = p.start
    assert np.allclose(H.forward(seqs, p) * math.log(10), [H.expectations([q], np.array([True]), p)[4] for q in seqs])


def test_rounds_raise_the_likelihood_and_add_up(spark):
    rng = np.random.default_rng(3)
    texts = [np.append(rng.integers(0, 40, rng.integers(1, 700)) + 40 * (i % 2), H.END).astype("<u2").tobytes() for i in range(40)]
    u = np.full(H.END + 1, 1 / (H.END + 1))
    p = H.random_parameters(u)
    df = spark.createDataFrame([(t,) for t in texts], "symbols binary")
    last = -np.inf
    for _ in range(4):
        sums = [H.expectations(s, f, p) for s, f in H.batches_of(iter(texts))]
        ll = sum(x[4] for x in sums)
        assert ll > last
        last = ll
        want = H.maximise(*(sum(x[j] for x in sums) for j in range(4)), u)
        p = H.baum_welch_round(df, p, u)
        assert np.allclose(p.emit, want.emit) and np.allclose(p.move, want.move) and np.allclose(p.start, want.start)


def test_model_is_a_distribution():
    v = H.Vocabulary([b"a", b"b"], np.array([5, 3]), np.full(H.CLASSES, 2.0), np.full(H.CLASSES, 1.0), 2, 10 + 2 * H.CLASSES, 3)
    p = H.random_parameters(v.unigram())
    assert np.allclose(p.emit.sum(0), 1) and np.allclose(v.unigram().sum(), 1)
    # A class of one word met once and one word met once: each 1 / 4, unknown words 2 / 4 together.
    assert np.isclose(10 ** (np.log10(1) - v.class_log[0]) * 2 + 10 ** (np.log10(v.unknown[0]) - v.class_log[0]), 1)


def test_shapes_agree(spark):
    ws = [b"a", b"ab", "é".encode(), "日本".encode(), b"longer,word"]
    df = spark.createDataFrame([(w,) for w in ws], "w binary")
    assert [r[0] for r in df.select(H.shape_column(F.col("w"))).collect()] == [H.shape(w) for w in ws]


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert H.score_documents(df, bucket(df["doc_id"], 7) == 2).count() == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    (r,) = H.score_documents(one, F.lit(True)).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0) and r.score < 0
