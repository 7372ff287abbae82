import random

import pytest
import xxhash

from rasterloom.llm import simhash as S
from rasterloom.llm.components import connected_components


def brute_fp(text, k):
    w = "".join(c.lower() if c.isascii() else c for c in (text or "")).replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ")
    w = [x for x in w if x]
    sh = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def closure(ids, linked):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if linked(a, b) and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label


def test_components_match_brute_force(spark):
    rng = random.Random(1)
    words = ["w%d" % i for i in range(30)] + ["Éa", "ÀB", "x*"]
    texts = {0: None, 1: "", 2: " \n\t", 3: "one", 4: "ONE", 5: "a b", 6: "long " * 30000}
    base = [" ".join(rng.choice(words) for _ in range(80)) for _ in range(6)]
    for i in range(7, 60):
        w = rng.choice(base).split(" ")
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w))] = rng.choice(words)
        texts[i] = " ".join(w)
    df = spark.createDataFrame([(i, t, "x", 0.5) for i, t in texts.items()], "doc_id long, text string, component_id string, fp double")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.simhash_components(df).collect()}
    fps = {i: brute_fp(t, 3) for i, t in texts.items()}
    want = closure(list(texts), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)
    assert got == {i: (f"{fps[i]:016x}", want[i]) for i in texts}


def test_distinct_shingles_count_once():
    words = "a b c d e f g h i j".split()
    once = " ".join(words)
    assert S.fingerprint(once + " " + once, 3, 256, True) != S.fingerprint(once + " " + once, 3, 256)
    cycle = " ".join(words * 2 + words[:2])
    assert S.fingerprint(cycle, 3, 128, True) == S.fingerprint(" ".join(words + words[:2]), 3, 128)


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(5, "a b c d"), (5, "a b c d"), (2, "a b c d"), (None, "q r s")], "doc_id long, text string")
    rows = sorted((str(r.doc_id), str(r.component_id)) for r in S.simhash_components(df).collect())
    assert rows == [("2", "2"), ("5", "2"), ("5", "2"), ("None", "None")]
    assert S.simhash_components(df.limit(0)).count() == 0


@pytest.mark.parametrize(("bits", "radius"), [(64, 2), (256, 50)])
def test_tree_and_scan_agree_with_all_pairs(bits, radius):
    rng = random.Random(3)
    vals = [rng.getrandbits(bits) for _ in range(12)]
    for _ in range(90):
        v = rng.choice(vals)
        for _ in range(rng.randrange(max(4, radius // 2))):
            v ^= 1 << rng.randrange(bits)
        vals.append(v)
    want = closure(list(range(len(vals))), lambda a, b: (vals[a] ^ vals[b]).bit_count() <= radius)
    assert S.link(vals, radius, bits) == [want[i] for i in range(len(vals))]


def test_split_shards_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(S, "SHARD_CAP", 5)
    rng = random.Random(5)
    core, rows = rng.getrandbits(64), []
    for i in range(40):
        rows.append((i, f"{core ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)):016x}"))
    fps = {i: int(f, 16) for i, f in rows}
    df = spark.createDataFrame(rows, "id long, fp string")
    got = {r.fp: r.component for r in S.near_classes(df, 2, 64, S.exact_bands(64, 4, 2)).collect()}
    want = closure(list(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)
    assert {i: got[f] for i, f in rows} == want


def test_connected_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 130)] + [(7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in edges for x in e if e[0] != e[1]}
    es = set(edges) | {(b, a) for a, b in edges}
    assert got == closure(sorted(nodes), lambda a, b: (a, b) in es)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_stage_keeps_one_of_each_group(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(4000)]
    text = lambda: [rng.choice(words) for _ in range(300)]
    rows, want = [], set()
    for g in range(40):
        base, ids = text(), []
        for k in range(1 + g % 4):
            w = list(base)
            for _ in range(5 if k else 0):
                w[rng.randrange(len(w))] = rng.choice(words)
            ids.append(rng.randrange(10**6) * 50 + g)
            rows.append((ids[-1], " ".join(w), g))
        want.add(min(ids))
    rows += [(None, None, -1), (7, "", -1), (9, "lone words", -1), (None, "other lone words here", -1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int").coalesce(3)
    got = S.drop_near(df)
    assert got.columns == df.columns
    ids = [r.doc_id for r in got.collect()]
    # Five words of 300 replaced: similarity about 0.85.
    assert sorted(x for x in ids if x is not None) == sorted(want | {7, 9}) and ids.count(None) == 1
    assert S.drop_near(df.limit(0)).count() == 0


def test_near_copies_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(S, "SET_CAP", 700)
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(900)]
    rows = [(None, 0), ("", 0), (" \n", 0), ("one two", 0), ("One  two", 0), ("one two three", 0)]
    for n in (8, 12, 30, 70, 200, 400):
        for _ in range(6):
            now = [rng.choice(words) for _ in range(n)]
            for _ in range(7):
                rows.append((" ".join(now), n))
                # A chain: each text is near the one before it, at similarities around 0.8.
                for _ in range(rng.choice((1, 1, 2, 3)) * max(1, n // 60)):
                    now[rng.randrange(n)] = rng.choice(words)
    texts = [t for t, _ in rows]
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)})
    want = closure(range(len(texts)), lambda a, b: len(sets[a] & sets[b]) * 5 >= len(sets[a] | sets[b]) * 4)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    pairs = [(r.a, r.b) for r in S.near_pairs(df, "doc_id", "text").collect()]
    assert all(len(sets[a] & sets[b]) * 5 >= len(sets[a] | sets[b]) * 4 for a, b in pairs)
    both = set(pairs) | {(b, a) for a, b in pairs}
    assert closure(range(len(texts)), lambda a, b: (a, b) in both) == want
    assert sorted(r.doc_id for r in S.drop_near(df, exact=True).collect()) == sorted(set(want.values()))
    assert S.drop_near(df.limit(0), exact=True).count() == 0
    assert len(set(want.values())) < len(texts) - 20
