import random

import numpy as np
import pytest

from rasterloom.llm import quality as Q


def test_held_out_accuracy_and_odd_rows(spark):
    rng = random.Random(3)
    good = lambda: " ".join(rng.choice(["fine", "words", "stand", "here"]) + rng.choice(["", ",", "."]) for _ in range(50))
    bad = lambda: " ".join(rng.choice(["XX", "YY", "ZZ"]) + rng.choice(["!!", "***"]) for _ in range(50))
    rows = [(i, good() if i % 4 else bad(), int(i % 4 > 0)) for i in range(300)]
    docs = [(i, t, 0.0) for i, t, _ in rows] + [(900, None, 0.0), (901, "", 0.0), (902, "\n ", 0.0), (903, "fine words " * 70000, 0.0), (None, "XX!!", 0.0), (5, "fine", 0.0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, predicted double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 200] + [(None, 1), (3, None), (4, 7)], "doc_id long, quality int")
    model = Q.train(df, labels)
    got = df.select("doc_id", Q.score_column(model, df["text"]).alias("s")).collect()
    assert len(got) == len(docs) and all(0 <= r.s <= 1 for r in got)
    by = {r.doc_id: r.s for r in got if r.doc_id != 5}
    assert all((by[i] >= 0.3) == bool(y) for i, _, y in rows if i >= 200)
    assert by[900] == by[901] == by[902]
    assert by[903] >= 0.3 and by[None] < 0.3


def test_no_labels_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = Q.train(df, labels)
    assert [r[0] for r in df.select(Q.score_column(model, df["text"])).collect()] == [0.5]
    assert df.limit(0).select(Q.score_column(model, df["text"])).count() == 0


@pytest.mark.parametrize("clash", [False, True])
def test_kept_words_give_the_plain_average(monkeypatch, clash):
    from rasterloom.llm import interning

    monkeypatch.setattr(Q, "SLICE", 10)
    monkeypatch.setattr(Q, "KEPT_WORDS", 4)
    if clash:
        hashed = interning.Interner._hash
        monkeypatch.setattr(interning.Interner, "_hash", lambda self, *a: hashed(self, *a) % np.uint64(3) + np.uint64(1))
    rng = np.random.default_rng(5)
    m = Q.Model(rng.normal(size=(Q.BUCKETS, Q.DIM)), rng.normal(size=(Q.DIM, 2)), np.array([0.1, -0.2]))
    texts = ["one two two two three fOUR é one five six six", "", "six seven", " \n", "six six\tsix", "é"]

    def plain(text):
        f = [k for w in Q.tokens(text) for k in Q.word_features(w)]
        z = (m.vectors[f].mean(0) if f else np.zeros(Q.DIM)) @ m.out + m.bias
        return np.exp(z[1]) / np.exp(z).sum()

    assert m.scores([t.encode() for t in texts]) == pytest.approx([plain(t) for t in texts])
