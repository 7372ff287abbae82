import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from rasterloom.llm import repair as R
from rasterloom.llm import tokens as K

VOCABS = [("byte_bpe_50k.json", "byte_level"), ("word_bpe_49k.json", "words")]


def tok(name):
    t = Tokenizer.from_file(P.path(name))
    t.encode_special_tokens = True
    return t


@pytest.mark.parametrize(("name", "kind"), VOCABS)
def test_encoder_gives_what_the_library_gives(name, kind):
    rng = random.Random(6)
    bits = ["a", "Word", "'s", "don't", "naïve", "œŁ", "J̌", "ÀÉ", " ", "  ", "\n", "\n\n", "\n\n\n", "\t", "\r\n", " ", " ", "　", "\x85", "\x1c", "\x01", "Été", "é", "́", "日本語", "123", "4.5", "!!", "***", "<|endoftext|>", "𝄞", "ΣΑΣ", "İ"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(25))) for _ in range(3000)] + ["word " * 40000, "x" * 30000]
    enc, t = K.Encoder(K.vocabulary(name), kind), tok(name)
    for text, ids in zip(texts, enc.encode([x.encode() for x in texts])):
        assert ids.tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)


def test_words_that_share_a_hash(monkeypatch):
    from rasterloom.llm import interning

    plain = interning.Interner._hash
    monkeypatch.setattr(interning.Interner, "_hash", lambda self, *a: plain(self, *a) % np.uint64(7) + np.uint64(1))
    enc, t = K.Encoder(K.vocabulary("byte_bpe_50k.json"), "byte_level"), tok("byte_bpe_50k.json")
    texts = [f"some words {i} and {'ab' * i}" for i in range(30)]
    assert [x.tolist() for x in enc.encode([x.encode() for x in texts])] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_encoder_starts_anew_when_full(monkeypatch):
    monkeypatch.setattr(K, "KEPT_WORDS", 5)
    monkeypatch.setattr(K, "SLICE", 20)
    enc, t = K.Encoder(K.vocabulary("byte_bpe_50k.json"), "byte_level"), tok("byte_bpe_50k.json")
    texts = [f"some words {i} and {i * 7}" for i in range(40)]
    assert [x.tolist() for x in enc.encode([x.encode() for x in texts])] == [t.encode(x, add_special_tokens=False).ids for x in texts]


@pytest.mark.parametrize("top", [3, 40, 70000])
def test_shard_round_trip_and_random_access(top):
    rng = np.random.default_rng(top)
    docs = [np.append(rng.integers(0, top, rng.integers(0, 900)), 2).astype(np.uint32) for _ in range(60)]
    docs += [np.array([2], np.uint32), np.full(5000, 1, np.uint32), np.tile([1, 2, 1], 400).astype(np.uint32)]
    ids = [None, *range(1, len(docs))]
    payload = R.pack_shard(ids, docs)
    s = R.Shard(payload)
    assert [i for i, _ in s.documents()] == ids
    assert all((a == b).all() and len(a) == len(b) for (_, a), b in zip(s.documents(), docs))
    for k in range(len(docs)):
        assert (s.document(k) == docs[k]).all()
        a, b = sorted(rng.integers(0, len(docs[k]) + 1, 2).tolist())
        assert s.range(k, a, b).tolist() == docs[k][a:b].tolist()
    if top < 70000:
        assert len(s.left) and s.size < sum(map(len, docs))
        assert s.rule_lens.tolist() == [len(s.expand(np.array([s.first + r]))) for r in range(len(s.left))]


def repeats(docs):
    """How often each pair of neighbours occurs, without overlaps, by a plain walk."""
    found = {}
    for d in docs:
        free = {}
        for k, pair in enumerate(zip(d, d[1:])):
            if free.get(pair, -1) <= k:
                found[pair], free[pair] = found.get(pair, 0) + 1, k + 2
    return found


@pytest.mark.parametrize("least", [2, 3, 5])
@pytest.mark.parametrize("top", [2, 30, 5000])
def test_no_pair_is_left_that_repeats(top, least):
    rng = np.random.default_rng(top)
    docs = [np.append(rng.integers(0, top, rng.integers(0, 700)), 2).astype(np.uint32) for _ in range(40)]
    docs += [np.full(777, 1, np.uint32), np.array([1], np.uint32), docs[0], docs[1], np.tile([1, 2, 1, 1], 99).astype(np.uint32)]
    s = R.Shard(R.pack_shard(list(range(len(docs))), docs, least))
    ends = [0, *s.ends.tolist()]
    left = repeats([s.symbols(a, b).tolist() for a, b in zip(ends, ends[1:])])
    assert max(left.values()) < least
    assert max(repeats([d.tolist() for d in docs]).values()) >= least
    # Every rule pays: its symbol occurs at least that often, in the text or in other rules.
    used = np.bincount(np.concatenate([s.symbols(), s.left, s.right]), minlength=s.first + len(s.left))[s.first :]
    assert used.min() >= 1 and len(np.unique(s.left * (s.first + len(s.left)) + s.right)) == len(s.left)


def test_wide_keys_give_the_same():
    rng = np.random.default_rng(5)
    ids, ends = rng.integers(0, 50, 4000).astype(np.uint32), np.array([100, 1500, 4000])
    want = R.grammar(ids, ends)
    got = R.grammar(ids.astype(np.int64) * 40_000_000, ends)  # a pair and a place don't fit into one integer
    assert all(len(a) == len(b) for a, b in zip(got, want)) and (got[4] == want[4]).all()


@pytest.mark.parametrize("bits", [1, 7, 8, 17, 25, 32])
def test_packed_bits(bits):
    rng = np.random.default_rng(bits)
    v = rng.integers(0, 1 << bits, 1003, dtype=np.int64)
    raw = np.frombuffer(R.pack_bits(v, bits), np.uint8)
    assert (R.unpack_bits(raw, bits, 0, 1003) == v).all() and (R.unpack_bits(raw, bits, 501, 777) == v[501:777]).all()
    assert len(raw) == 126 * bits


def test_grammars_are_the_ones_of_before():
    rng = np.random.default_rng(3)
    docs = [np.append(rng.integers(0, 9 ** rng.integers(1, 5), rng.integers(0, 500)), 2).astype(np.uint32) for _ in range(60)]
    docs += [np.full(777, 1, np.uint32), np.tile([1, 2, 1, 1], 99).astype(np.uint32)]
    payloads = [R.pack_shard(list(range(len(docs))), docs, least) for least in (2, 3)]
    assert [(len(p), zlib.crc32(p)) for p in payloads] == [(23904, 865010675), (23089, 1060351945)]


def test_whole_shards_of_short_and_of_long_rules():
    """Rules that are longer in all than the text are not expanded by themselves."""
    longer = []
    for docs in ([np.full(5000, 1)], [np.full(5001, 1), np.array([2])], [np.tile(np.arange(100), 9)], [np.arange(100)], []):
        s = R.Shard(R.pack_shard(list(range(len(docs))), [d.astype(np.uint32) for d in docs]))
        longer.append(bool(s.rule_lens.sum() > sum(map(len, docs))))
        assert [x.tolist() for _, x in s.documents()] == [d.tolist() for d in docs]
    assert set(longer) == {False, True}


def test_words_are_not_taken_byte_by_byte(monkeypatch):
    """Nor do words of letters go through the tokenizer's steps before the merges; both took most of the time of op1."""
    from rasterloom.llm import interning

    enc, t = K.Encoder(K.vocabulary("byte_bpe_50k.json"), "byte_level"), tok("byte_bpe_50k.json")
    texts = [f"some {'words' * i} of letters {'no' * i} {'x' * (64 - i)}" for i in range(1, 12)]
    want = [t.encode(x, add_special_tokens=False).ids for x in texts]

    def never(*a, **k):
        raise AssertionError

    monkeypatch.setattr(interning, "equal_segments", never)
    monkeypatch.setattr(enc, "tok", None)
    monkeypatch.setattr(interning.Interner, "_grow_powers", never)
    for _ in range(2):
        assert [x.tolist() for x in enc.encode([x.encode() for x in texts])] == want


@pytest.mark.parametrize("clash", [False, True])
def test_words_that_differ_in_one_byte(monkeypatch, clash):
    from rasterloom.llm.interning import Interner

    if clash:  # all words of a length share a hash, so that only the comparison tells them apart
        monkeypatch.setattr(Interner, "_hash", lambda self, data, begins, lens: lens.astype(np.uint64) + np.uint64(1))
    words = []
    for n in (1, 7, 8, 9, 16, 63, 64, 65, 72, 200):
        words.append(bytes([97]) * n)
        words += [words[-1][:k] + b"b" + words[-1][k + 1 :] for k in sorted({0, n // 2, n - 1})] if n > 1 else []
    words = list(dict.fromkeys(words))
    starts = np.cumsum([0, *map(len, words[:-1])])
    table = Interner()
    got = table.numbers(b"".join(words), starts, lambda new: None).tolist()
    assert table.numbers(b"".join(words), starts, None).tolist() == got
    if clash:
        firsts = {len(w): w for w in reversed(words)}
        assert [k >= 0 for k in got] == [firsts[len(w)] == w for w in words] and min(got) == -2
    else:
        assert got == list(range(len(words)))


def test_invalid_utf8():
    enc, t = K.Encoder(K.vocabulary("byte_bpe_50k.json"), "byte_level"), tok("byte_bpe_50k.json")
    for raw in (b"ab\xff cd \xc3", b"\xc3\xc3\xa9 word\xe2\x82", b" \xc4", b"\xc5x"):
        assert enc.encode([raw])[0].tolist() == t.encode(raw.decode("utf-8", "replace"), add_special_tokens=False).ids


def test_table_matches_brute_force(spark, tmp_path):
    rng = random.Random(8)
    rows = [(7, None), (3, ""), (3, "b b"), (3, "b b"), (None, "null id"), (90, "long text " * 20000)]
    rows += [(i, " ".join(rng.choice(["the", "of", "Été", "x\ny", " "]) for _ in range(rng.randrange(200)))) for i in range(100, 160)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, start int")
    R.write_shards(df, str(tmp_path / "s"), K.vocabulary("byte_bpe_50k.json"), shard_tokens=500)
    got = [tuple(r) for r in R.read_shards(spark, str(tmp_path / "s")).orderBy("start").collect()]
    t, at, want = tok("byte_bpe_50k.json"), 0, []
    for i, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = t.encode(x or "", add_special_tokens=False).ids + [2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want
    R.write_shards(df.limit(0), str(tmp_path / "e"), K.vocabulary("byte_bpe_50k.json"))
    assert R.read_shards(spark, str(tmp_path / "e")).count() == 0
