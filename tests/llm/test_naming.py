import hashlib
import random
import re

from rasterloom.llm import naming as N


def brute(rows):
    key = {r: re.sub(r"[\x20\x09-\x0d]", "", t or "") for r, (_, t) in enumerate(rows)}
    out = []
    for r, (i, t) in enumerate(rows):
        same = [x for x in key if key[x] == key[r]]
        best = min(same, key=lambda x: (-len(rows[x][1] or ""), rows[x][0] is None, rows[x][0] or 0, x))
        out.append((i, rows[best][0], len(same), best == r, hashlib.sha256(key[r].encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, size):
    df = spark.createDataFrame([(i, t, 1, "y") for i, t in rows], "doc_id long, text string, n int, name string").coalesce(1)
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in N.exact_groups(df, size=size).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_groups_match_brute_force(spark):
    rng = random.Random(4)
    base = ["".join(rng.choice("ab é𝄞") for _ in range(n)) for n in (1, 3, 4, 5, 8, 9, 17, 33, 40)]
    rows = [(0, None), (1, ""), (2, " \n\t\x0b\x0c\r"), (None, "a b"), (None, "ab"), (3, "ab"), (3, "ab"), (4, " a")]
    for i in range(10, 70):
        t = rng.choice(base)
        rows.append((i, t[: len(t) // 2] + rng.choice(["", " ", "\n \t"]) + t[len(t) // 2 :]))
    rows += [(100, "x" * 50000), (101, "x" * 50001), (102, "x " * 50000)]
    check(spark, rows, 4)
    check(spark, rows, 4096)


def test_hot_blocks_keep_one_name(spark, monkeypatch):
    monkeypatch.setattr(N, "HOT_COUNT", 3)
    monkeypatch.setattr(N, "SALTS", 4)
    check(spark, [(i, "abcdefgh"[: 4 + 4 * (i % 2)] + " " * (i % 3)) for i in range(60)], 4)


def test_empty_table_and_stage(spark):
    df = spark.createDataFrame([(1, "a b", "q"), (2, "ab", "q"), (2, "ab", "q"), (3, "c", "z")], "doc_id long, text string, __RID string").coalesce(1)
    assert N.exact_groups(df.limit(0)).count() == 0
    assert sorted(map(tuple, N.drop_exact(df).collect())) == [(1, "a b", "q"), (3, "c", "z")]
