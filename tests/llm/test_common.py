import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.llm import common as C
from rasterloom.llm.interning import Interner


@pytest.mark.parametrize("n", [0, 5, 100, 5000])
def test_first_by_hash_is_the_head_of_the_order(spark, n):
    df = spark.range(3000).withColumnRenamed("id", "k")
    rows = df.select("k", F.pmod(F.xxhash64("k"), F.lit(1 << 40)).alias("h")).collect()
    best = [r.k for r in sorted(rows, key=lambda r: (r.h, r.k))[:n]]
    assert sorted(r.k for r in C.first_by_hash(df, n, "k").collect()) == sorted(best)
    assert C.first_by_hash(df.limit(0), n, "k").count() == 0


def test_bucket_is_crc32_of_the_text(spark):
    df = spark.createDataFrame([(i,) for i in (0, 7, -3, 10**12)] + [(None,)], "doc_id long")
    got = [r[0] for r in df.select(C.bucket(df["doc_id"], 7)).collect()]
    assert got == [zlib.crc32(str(i).encode()) % 7 for i in (0, 7, -3, 10**12)] + [zlib.crc32(b"") % 7]


def test_packed_words_split_only_at_ascii_space():
    texts = ["a  bé c\x1cd\n", "", " \t", "x", "\x0b\x0cy\rz"]
    raw, starts, counts = C.packed_words([t.encode() for t in texts])
    ends = [*starts[1:], len(raw)]
    words = [raw[a:b].decode() for a, b in zip(starts, ends)]
    assert words == ["a", "bé", "c\x1cd", "x", "y", "z"]
    assert counts.tolist() == [3, 0, 0, 1, 2]
    assert [w.decode() for w in C.words_of(texts[0])] == ["a", "bé", "c\x1cd"]


def test_interner_numbers_words_once():
    rng = np.random.default_rng(1)
    table, seen = Interner(), {}
    for _ in range(20):
        words = [bytes(rng.integers(97, 101, rng.integers(1, 6)).astype(np.uint8)) for _ in range(400)]
        starts = np.cumsum([0, *map(len, words[:-1])])
        got = table.numbers(b"".join(words), starts, lambda new: None)
        for w, k in zip(words, got.tolist()):
            assert seen.setdefault(w, k) == k
    assert sorted(seen.values()) == list(range(len(seen)))
    assert table.numbers(b"zzzab", np.array([0, 3]), None).tolist() == [-1, seen.get(b"ab", -1)]
