import random
import re

import pytest

from rasterloom.llm import decontaminate as D

ITEMS = [
    (0, "A train leaves Boston at 60 mph and travels 120 miles to reach Denver. How many hours did the train need to reach Denver?"),
    (1, "The quick brown fox jumps over the lazy dog while seven small birds are watching from a tall old tree."),
    (2, "Short item of words"),
    (3, None),
    (None, "yes"),
]


def found(spark, texts, items=ITEMS):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], "doc_id long, text string, item_id string, run int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    return sorted(((r.doc_id, r.item_id, r.slots, r.changed_slots) for r in D.matches(docs, bench).collect()), key=str)


def test_copies_and_reparameterised_questions(spark):
    texts = [
        (0, "junk before " + ITEMS[0][1] + " junk after"),
        (1, "Noise. " + ITEMS[0][1].replace("Boston", "New York").replace("60", "75.5").replace("120", "1,510").replace("Denver", "Paris")),
        (2, ITEMS[0][1].replace("Denver?", "Miami?").replace("120 miles to reach", "120 cats to eat")),
        (3, ITEMS[1][1].upper()),
        (4, "the quick brown fox jumps over a cat"),
        (5, "we saw a short item of words there"),
        (6, None),
        (7, ""),
        (None, ITEMS[1][1]),
        (8, "words " * 40000 + ITEMS[1][1]),
        (8, "words " * 40000 + ITEMS[1][1]),
    ]
    assert found(spark, texts) == sorted([(0, 0, 7, 0), (1, 0, 7, 5), (3, 1, 0, 0), (5, 2, 0, 0), (None, 1, 0, 0), (8, 1, 0, 0), (8, 1, 0, 0)], key=str)


def test_slots_must_be_consistent():
    item = "Tell Anna that it is 5 for us and then ask Anna if it can be 5 again or if Anna wants more than that now"
    index = D.build([(1, item)])
    swap = lambda *v: item.replace("Anna", "{}").format(*v).encode()
    assert index.scan([swap("Bob", "Bob", "Bob")])[0][0][3:] == (5, 3)
    # After the second name stands for another person, no consistent run is long enough but the last part.
    (mixed,) = index.scan([swap("Bob", "Carl", "Dora")])
    assert mixed == [] or mixed[0][1] < 18


def test_names_at_the_start_of_sentences():
    item = "Alice has 3 apples. Alice gives Bob 2 apples. How many apples does Alice have left?"
    index = D.build([(1, item)])
    other = item.replace("Alice", "Carol").replace("Bob", "Dan").replace("3", "9")
    for text in (other, "Some words. " + other, other.replace("Carol", "Carol Jones")):
        assert [m[0] for m in index.scan([text.encode()])[0]] == [1], text
    # Sentences so short that every window holds a start.
    item = "Anna likes to run far. Bob swims with his dog. Carl never walks to school. Who was home first?"
    text = item.replace("Anna", "Dora").replace("Bob", "Ed").replace("Carl", "Fay")
    assert [m[0] for m in D.build([(1, item)]).scan([text.encode()])[0]] == [1]


@pytest.mark.parametrize("item", ["12 + 35 = 47, 16 + 29 = 45, 81 - 16 = 65", "Anna, Bob, Carl, Dora, Emil, Fritz, Gerda", "3 km 5 kg 7 miles 12 hours 9 lbs 4 oz", "What is the capital of France"])
def test_verbatim_items_whatever_they_consist_of(item):
    index = D.build([(1, item)])
    for text in (item, f"Question: {item} and no more", f"so we ask. {item}"):
        assert [m[0] for m in index.scan([text.encode()])[0]] == [1], text


@pytest.mark.parametrize("n", range(5, 9))
def test_share_holds_for_short_items(n):
    words = "we often like some very small green birds".split()[:n]
    index, need = D.build([(1, " ".join(words))]), -(-n * 4 // 5)
    for at in range(n - need + 1):
        text = " ".join(["xx", *words[at : at + need], "yy"])
        assert [m[1] for m in index.scan([text.encode()])[0]] == [need], text
    assert index.scan([" ".join(["xx", *words[: need - 1], "yy"]).encode()]) == [[]]


@pytest.mark.parametrize(("item", "text"), [("we paid 5 to Anna for 7 km there", "we paid 6 to Bob for 9 km there"), ("ask Anna 5 km or so", "ask Bob 6 km or so")])
def test_short_items_need_literals_as_a_whole_only(item, text):
    assert [m[0] for m in D.build([(1, item)]).scan([text.encode()])[0]] == [1]


def test_empty_sides(spark):
    assert found(spark, [(1, "some text")], [(1, "")]) == []
    docs = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert D.matches(docs, bench).count() == 0
    assert D.matches(spark.createDataFrame([(1, "a")], "doc_id long, text string"), bench).count() == 0


def test_several_passes_find_the_same(spark, monkeypatch):
    texts = [(i, "Before. " + (t or "") + " after") for i, (_, t) in enumerate(ITEMS)]
    one = found(spark, texts)
    monkeypatch.setattr(D, "INDEX_BYTES", 30)
    assert found(spark, texts) == one and len(one) == 3


def plain(text, first_known=False):
    """The rule of templates, word by word."""
    out, start, last_num = [], True, False
    for m in re.finditer(r"(?:[A-Za-z0-9\x80-￿]|(?<=[0-9])[.,:/](?=[0-9]))+|[.!?\n]", text):
        w = m.group()
        if re.fullmatch(r"[.!?\n]", w):
            start = True
            continue
        if re.search(r"[0-9]", w):
            k = "<num>"
        elif last_num and w.lower() in D.UNITS:
            k = "<unit>"
        elif not start and w[0].isupper() and any(c.islower() for c in w):
            k = "<name>"
        else:
            k = w.lower()
        if not (k == "<name>" and out and out[-1] == "<name>" and prev_name):
            out.append(k)
        prev_name, last_num, start = k == "<name>", k == "<num>", False
    return out


@pytest.mark.parametrize("seed", range(3))
def test_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    vocab = ["the", "of", "run", "Été", "às", "x", "km", "and", "Otto", "Ana", "7", "3.5", "12", "THE", "so"]
    line = lambda n: " ".join(rng.choice(vocab) + rng.choice(["", "", "", ".", ",", "\n"]) for _ in range(n))
    items = [(i, line(rng.randrange(3, 30))) for i in range(12)]
    texts = [(i, line(rng.randrange(10)) + " .\n" + (rng.choice(items)[1] if rng.random() < 0.5 else line(30)) + " .\n" + line(10)) for i in range(60)]
    got = {(d, i) for d, i, _, _ in found(spark, texts, items)}
    for d, t in texts:
        a = plain(t)
        for i, x in items:
            b = plain(x)
            whole = any(a[k : k + len(b)] == b for k in range(len(a) - len(b) + 1))
            spare = [sum(not y.startswith("<") for y in b[k : k + min(8, len(b))]) for k in range(max(1, len(b) - 7))]
            if whole and x in t and len(b) >= 4 and min(spare) * 2 >= min(8, len(b)):
                assert (d, i) in got, (t, x)
            need = min(13, max(4, -(-len(b) * 4 // 5)))
            if (d, i) in got:
                assert any(a[k : k + need] == b[j : j + need] for k in range(len(a)) for j in range(len(b) - int(need) + 1)), (t, x)
