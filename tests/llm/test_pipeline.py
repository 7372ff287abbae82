import re
from collections import defaultdict

import corpus_pipeline as C
import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from rasterloom.llm import quality as Q
from rasterloom.llm import simhash as S

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = [docs.collect()]
    for k, (_, f) in enumerate(C.STAGES):
        path = str(tmp_path_factory.mktemp(f"s{k}") / "out")
        f(spark, docs, DATA).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.collect())
    return out


def test_stages_keep_columns_and_rows(spark, steps):
    assert [n for n, _ in C.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "packing"]
    for a, b in zip(steps[:-2], steps[1:-1]):
        assert set(b) <= set(a) and list(b[0].asDict()) == ["doc_id", "text", "lang", "source", "n_chars"]
    assert len(steps[0]) > len(steps[1]) > len(steps[2]) > len(steps[3]) > len(steps[4]) > 0


def test_quality_against_plain_averages(spark, steps):
    m = Q.trained(spark, spark.read.parquet(f"{DATA}/documents.parquet"), DATA)

    def plain(text):
        f = [k for w in Q.tokens(text) for k in Q.word_features(w)]
        z = (m.vectors[f].mean(0) if f else np.zeros(Q.DIM)) @ m.out + m.bias
        return 1 / (1 + np.exp(z[0] - z[1]))

    assert {r.doc_id for r in steps[1]} == {r.doc_id for r in steps[0] if plain(r.text) >= 0.3}


def test_exact_copies_by_brute_force(steps):
    groups = defaultdict(list)
    for r in steps[1]:
        groups[re.sub(r"[\x20\x09-\x0d]", "", r.text or "")].append((-len(r.text or ""), r.doc_id))
    assert {r.doc_id for r in steps[2]} == {min(g)[1] for g in groups.values()}


def test_near_copies_by_all_pairs(steps):
    rows = [(r.doc_id, int(S.fingerprint(r.text, 5, 256, True), 16)) for r in steps[2]]
    label = {i: i for i, _ in rows}
    for _ in rows:
        before = dict(label)
        for i, a in rows:
            for j, b in rows:
                if (a ^ b).bit_count() <= 50:
                    label[i] = label[j] = min(label[i], label[j])
        if before == label:
            break
    assert {r.doc_id for r in steps[3]} == set(label.values())


def test_benchmark_passages_by_containment(spark, steps):
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    assert {r.doc_id for r in steps[4]} == {r.doc_id for r in steps[3] if not any(x in " ".join((r.text or "").lower().split()) for x in items)}


def test_every_id_is_packed_once(steps):
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    have = defaultdict(int)
    for r in steps[5]:
        have[r.doc_id] += r.length
    assert have == {r.doc_id: len(t.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in steps[4]}


def test_run_gives_the_last_stage(spark, steps):
    key = lambda r: (r.doc_id, r.start)
    got = sorted(((*key(r), r.ids_crc32, r.doc_tokens) for r in C.run(spark, DATA).where("start = 0").collect()))
    assert got and {x[0] for x in got} == {r.doc_id for r in steps[4]}
