import random

import numpy as np
import pytest

from rasterloom.llm import toxicity as T

WORDS = [a + b + c for a in ("ba", "ko", "li", "mu") for b in ("ren", "sto", "vi") for c in ("", "da", "ne", "ty")]


def text(rng, bad):
    w = [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(120)]
    for _ in range(4 if bad else 0):
        w.insert(rng.randrange(len(w)), rng.choice(["grumpf", "zwickel", "quaxo"]))
    return " ".join(w)


def test_held_out_accuracy_and_odd_rows(spark):
    rng = random.Random(2)
    rows = [(i, text(rng, i % 5 == 0), int(i % 5 == 0)) for i in range(500)]
    docs = [(i, t, 1.0) for i, t, _ in rows] + [(900, None, 1.0), (901, "", 1.0), (902, "quaxo " * 60000, 1.0), (None, "plain", 1.0), (900, None, 1.0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 350] + [(None, 1), (3, None), (4, 9)], "doc_id long, toxic int")
    model = T.train(df, labels)
    out = T.score(df, model).collect()
    assert len(out) == len(docs) and all(0 <= r.score <= 1 for r in out)
    got = {r.doc_id: r.score for r in out}
    assert np.mean([(got[i] >= 0.7) == bool(y) for i, _, y in rows if i >= 350]) > 0.95
    assert got[900] == got[901] < 0.7 and got[902] >= 0.7
    assert T.score(df.limit(0), model).count() == 0


@pytest.mark.parametrize("ys", [[], [0, 0], [1]])
def test_one_class_or_none(spark, ys):
    df = spark.createDataFrame([(i, "some text") for i in range(3)], "doc_id long, text string")
    model = T.train(df, spark.createDataFrame(list(enumerate(ys)), "doc_id long, toxic int"))
    assert {r.score for r in T.score(df, model).collect()} == {float(bool(ys) and ys[0])}


def test_isotonic_is_the_best_monotone_fit():
    rng = np.random.default_rng(4)
    x, w = rng.permutation(40).astype(float), rng.random(40) + 0.1
    y = (rng.random(40) < x / 40).astype(float)
    px, py = T.isotonic(x, y, w)
    # The best monotone fit at a point is the largest of the least means over ranges that end and begin there.
    order = np.argsort(x)
    y, w = y[order], w[order]
    mean = lambda a, b: np.average(y[a : b + 1], weights=w[a : b + 1])
    best = [max(min(mean(a, b) for b in range(i, 40)) for a in range(i + 1)) for i in range(40)]
    assert np.allclose(py, sorted({round(v, 12) for v in best}))
    assert (np.diff(px) > 0).all()


def test_copies_of_one_text_make_no_word_telling():
    rng = random.Random(6)
    one = text(rng, False) + " oddword"
    found = T.telling([text(rng, True) for _ in range(60)] + [one] * 40, [text(rng, False) for _ in range(100)])
    assert found == {b"grumpf", b"zwickel", b"quaxo"}


def test_scores_match_plain_compression():
    """Window by window with the zstandard calls themselves, from the model's dictionaries on."""
    import zstandard

    rng = random.Random(9)
    toxic, ordinary = [text(rng, True) for _ in range(80)], [text(rng, False) for _ in range(160)]
    m = T.fit(toxic, ordinary, 0.3)
    assert m.toxic.startswith(m.ordinary) and len(m.toxic) > len(m.ordinary)

    def size(window, content):
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(level=T.LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress(window))

    for t in toxic[:8] + ordinary[:8] + ["", None, "GRUMPF, grumpf! 12"]:
        words = "".join(c.lower() if c.isalpha() else " " for c in t or "").split()
        total = 0.0
        for at in range(0, len(words), 4):
            w = (" " + " ".join(words[at : at + 4]) + " ").encode()
            total += m.evidence[min(12, max(-1, size(w, m.ordinary) - size(w, m.toxic))) + 1]
        assert np.isclose(total, m.total(t)) and np.isclose(m.score(t), np.interp(total, m.sums, m.scores))


def test_calibration_leaves_training_texts_out(monkeypatch):
    seen = []
    monkeypatch.setattr(T, "telling", lambda a, b: seen.append((a, b)) or set())
    T.fit([f"t{i}" for i in range(9)], [f"o{i}" for i in range(9)], 0.5)
    assert seen == [([f"t{i}" for i in range(9) if i % 4], [f"o{i}" for i in range(9) if i % 4])]
