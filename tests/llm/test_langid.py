import random

import numpy as np

from rasterloom.llm import langid as L
from rasterloom.llm.common import bucket

SYL = {"xx": ["ka", "lo", "mi"], "yy": ["sch", "eit", "ung"], "zz": ["éa", "ñu", "oß"]}


def texts(lang, n, rng):
    return [" ".join("".join(rng.choice(SYL[lang]) for _ in range(3)) for _ in range(60)) for _ in range(n)]


def test_held_out_accuracy_and_odd_rows(spark):
    rng = random.Random(1)
    rows = [(i * 3 + k, t, lang) for k, lang in enumerate(SYL) for i, t in enumerate(texts(lang, 40, rng))]
    rows += [(1000, None, "xx"), (1001, "", "yy"), (1002, "123 !? \n", "xx"), (1003, "kalomi " * 30000, None), (None, "scheitung scheitung", None), (1003, "kalomi " * 30000, None)]
    df = spark.createDataFrame([(*r, 0.1) for r in rows], "doc_id long, text string, lang string, score double")
    model = L.train(df.where(bucket(df["doc_id"], 3) != 1))
    assert model.langs == ["xx", "yy", "zz"]
    out = L.predict(df, model).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: r for r in out}
    for i, t, lang in rows[:120]:
        assert got[i].lang_pred == lang
    assert [got[i].lang_pred for i in (1000, 1001, 1002, 1003, None)] == ["und", "und", "und", "xx", "yy"]
    assert all(0 <= r.score <= 1 for r in out)


def test_nothing_learned(spark):
    df = spark.createDataFrame([(1, "words here", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in L.predict(df, L.train(df)).collect()] == [(1, "und", 0.0)]
    assert L.predict(df.limit(0), L.train(df)).count() == 0


def test_filter_gives_all_languages_of_a_gram():
    rng = np.random.default_rng(2)
    own = {f"l{k:02d}": np.unique(rng.integers(0, 2**32, 300, dtype=np.uint32)) for k in range(70)}
    shared = np.array([0x61626364], np.uint32)
    counts = {k: (np.concatenate([v, shared]), np.ones(len(v) + 1, np.int64), len(v) + 1) for k, v in own.items()}
    m = L.build(counts)
    hits, total = m.counts("abcd")
    assert total == 3 and (hits >= 1).all()
    assert (m.false_rate < 1e-6).all()


def test_parts_give_the_same_windows(monkeypatch):
    text = "Été, words 12 and more; " * 50
    whole = np.concatenate(list(L.grams(text)))
    monkeypatch.setattr(L, "PART", 37)
    assert np.concatenate(list(L.grams(text))).tolist() == whole.tolist()
