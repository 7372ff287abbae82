import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from rasterloom.llm import packing as K
from rasterloom.llm.tokens import vocabulary


def test_every_id_in_one_piece(spark):
    rng = random.Random(9)
    rows = [(0, None), (1, ""), (2, "same"), (2, "same"), (None, "no id"), (3, "very long " * 9000)]
    rows += [(i, " ".join(rng.choice(["the", "word", "ÉTÉ", "x!"]) for _ in range(rng.randrange(1, 1500)))) for i in range(10, 120)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, start string")
    got = K.pack_documents(df.coalesce(2), vocabulary("word_bpe_49k.json")).collect()
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = defaultdict(list)
    for i, x in rows:
        want[i].append(np.array(t.encode(x or "", add_special_tokens=False).ids + [1], "<u4"))
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
    assert set(pieces) == set(want)
    for i, docs in want.items():
        assert sum(r.length for r in pieces[i]) == sum(map(len, docs))
        if len(docs) == 1:
            at = 0
            for r in sorted(pieces[i], key=lambda r: r.start):
                assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(docs[0]), zlib.crc32(docs[0][at : at + r.length].tobytes()))
                at += r.length
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append(r)
    padded = 0
    for s in seqs.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048 and len(s) <= K.MAX_SEGMENTS and all(r.sequence_tokens == at for r in s)
        padded += 0 if at & (at - 1) == 0 else 2048 - at
    assert padded == 0
    assert K.pack_documents(df.limit(0), vocabulary("word_bpe_49k.json")).count() == 0


@pytest.mark.parametrize("cut", [True, False])
def test_limits_hold_together(cut):
    rng = np.random.default_rng(1)
    p = K.Packer(100, 4, 30, cut=cut, pool=16)
    made, out = [], []
    for k in range(400):
        n = int(rng.integers(1, 400 if cut else 90))
        loss = rng.random(n) < 0.4
        if not cut and loss.sum() > 30:
            loss[:] = False
        made.append((k, n))
        out += list(p.add(K.Example(k, np.arange(n), 0, loss)))
    out += list(p.finish())
    seen = defaultdict(list)
    for s in out:
        assert sum(n for _, _, n in s) <= 100 and len(s) <= 4
        assert sum(int(e.loss[a : a + n].sum()) for e, a, n in s) <= 30
        for e, a, n in s:
            seen[e.key] += range(a, a + n)
    assert all(sorted(seen[k]) == list(range(n)) for k, n in made)
    if not cut:
        assert all(a == 0 and n == len(e.ids) for s in out for e, a, n in s)
        with pytest.raises(ValueError):
            list(p.add(K.Example(0, np.arange(101))))


def test_conversations_keep_turns_and_loss(spark):
    rng = random.Random(12)
    rows = [(c, t, "assistant" if t % 2 else "user", " ".join(rng.choice(["hi", "the", "ÉTÉ"]) for _ in range(rng.randrange(60))), 1) for c in range(30) for t in range(rng.randrange(1, 12))]
    rows += [(99, t, "assistant", "many turns here", 1) for t in range(300)] + [(50, None, None, None, 1), (None, 0, "user", "x", 1), (50, None, None, None, 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, length int")
    got = K.pack_conversations(df, vocabulary("word_bpe_49k.json"), max_loss=500).collect()
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    tokens, loss = defaultdict(int), defaultdict(int)
    for c, k, r, x, _ in rows:
        n = len(t.encode(x or "", add_special_tokens=False).ids) + 1
        tokens[c, (k or 0) // 64] += n
        loss[c, (k or 0) // 64] += n * (r == "assistant")
    have, bear, seqs = defaultdict(int), defaultdict(int), defaultdict(list)
    for r in got:
        have[r.conv_id, r.turn // 64] += r.length
        bear[r.conv_id, r.turn // 64] += r.loss_tokens
        seqs[r.sequence_id].append(r)
    assert have == tokens and bear == loss
    for s in seqs.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048 and len(s) <= K.MAX_SEGMENTS and sum(r.loss_tokens for r in s) <= 500
    assert K.pack_conversations(df.limit(0), vocabulary("word_bpe_49k.json")).count() == 0
