"""Benchmark decontamination by template canonicalisation.

Texts become sequences of literals and typed placeholders: numbers, names (capitalised
words within a sentence, neighbours as one) and units (after a number). The hashes of
all windows of a benchmark item's template are looked up by a broadcast hash join for
each document. Windows that match along one alignment make a run, in which a value of
the item must always stand for the same value of the document, and the reverse; so a
question asked again with other numbers and names is found, and a chance mixture isn't.
Words and numbers as they are make windows too, for items that are mostly placeholders.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.llm.common import documents, ship_package, text_of
from rasterloom.llm.interning import Interner

WINDOW, LEAST_LITERALS, SHORTEST = 8, 4, 4
#: A run of so many template tokens, or of this share of the item, is a match.
RUN, SHARE = 13, 0.8
#: Bytes of benchmark text in one broadcast index; more text is looked up in several passes.
INDEX_BYTES = 16_000_000
SLICE = 1 << 20
# Unit words, as they are looked for after a number.
UNITS = """mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres
mg g kg t lb lbs oz gram grams kilogram kilograms ton tons tonne tonnes pound pounds ounce ounces ml cl l liter liters litre litres gallon gallons
s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years mph kmh kph hz khz mhz ghz kb mb gb tb
w kw mw kwh v a j kj cal kcal pa kpa bar c f k degree degrees percent cent cents dollar dollars euro euros usd eur gbp""".split()
#: How many templates ``canonical`` makes of a text.
READINGS = 3
PRIME = np.uint64(0x100000001B3)

_IN, _DIGIT, _UPPER, _LOWERED, _JOINT, _STOP = (np.zeros(256, bool) for _ in range(6))
_IN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_DIGIT[0x30:0x3A] = True
_UPPER[0x41:0x5B] = True
_LOWERED[0x61:0x7B] = True
_JOINT[list(b".,:/")] = True
_STOP[list(b".!?\n")] = True


@dataclass
class Template:
    """Canonical tokens of several texts in a row: ``kind`` (a word's number, -1 unknown, or a placeholder), the text each is of, and where each begins and ends in ``raw``."""

    raw: bytes
    kind: np.ndarray
    text: np.ndarray
    begin: np.ndarray
    end: np.ndarray


NUM, NAME, UNIT = (1 << 30) + 1, (1 << 30) + 2, (1 << 30) + 3


def canonical(texts: list[bytes], words: Interner, learn: bool, units: np.ndarray | None = None) -> list[Template]:
    """All readings of some texts: capitalised words at the start of a sentence as literals, and as names; and all words and numbers as they are.

    Lower case holds for ASCII and Latin-1 letters. Words all in capitals are literals, not names.
    """
    raw = b"\n".join(texts) + b"\n"
    b = np.frombuffer(raw, np.uint8)
    inside = _IN[b]
    digit = _DIGIT[b]
    joint = np.zeros(len(b), bool)
    joint[1:-1] = _JOINT[b[1:-1]] & digit[:-2] & digit[2:]
    inside |= joint
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    begin, end = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
    empty = np.zeros(0, np.int64)
    if not len(begin):
        return [Template(raw, empty, empty, empty, empty)] * READINGS
    low = b.copy()
    low[_UPPER[b]] += 32
    wide = np.nonzero((b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E) & (b[1:] != 0x97))[0] + 1
    low[wide] += 32
    capital = _UPPER[b]
    capital[wide - 1] = True
    plain = _LOWERED[b]
    plain[(b >= 0x80) & ~capital] = True
    plain[wide] = False
    size = end - begin
    total = lambda mask: np.add.reduceat(mask, begin, dtype=np.int64)  # noqa: E731  gaps hold no letters or digits
    has_digit, lowers = total(digit) > 0, total(plain) > 0
    ends_at = np.cumsum([len(t) + 1 for t in texts])
    text = np.searchsorted(ends_at, begin, "right")
    stops = np.cumsum(_STOP[b] & ~joint)
    starts = np.ones(len(begin), bool)
    starts[1:] = (stops[begin[1:]] != stops[end[:-1] - 1]) | (text[1:] != text[:-1])
    packed = low[inside].tobytes()
    numbers = words.numbers(packed, np.cumsum(size) - size, (lambda *_: None) if learn else None)
    kind = np.where(numbers < 0, -1, numbers)
    plain_kind = kind.copy()
    if units is not None:
        unit = np.isin(kind, units)
        unit[1:] &= has_digit[:-1] & (text[1:] == text[:-1])
        unit[0] = False
        kind[unit] = UNIT
    kind[has_digit] = NUM
    named = capital[begin] & lowers & ~has_digit & (kind != UNIT)
    out = []
    for name in (named & ~starts, named):
        again = np.zeros(len(kind), bool)
        again[1:] = name[1:] & name[:-1] & ~starts[1:]
        # 'Tell Anna' is no name of two words, unless a name begins with 'Tell' within a sentence of the text.
        first = np.nonzero(again[1:] & starts[:-1])[0]
        if len(first):
            word = lambda k: (int(text[k]), low[begin[k] : end[k]].tobytes())
            others = {word(k) for k in np.nonzero(named & ~starts & np.isin(text, text[first]))[0]}
            again[1 + first] = [word(k) in others for k in first]
        keep = np.nonzero(~again)[0]
        last = np.append(keep[1:], len(kind)) - 1
        out.append(Template(raw, np.where(name, NAME, kind)[keep], text[keep], begin[keep], end[last]))
    return [*out, Template(raw, plain_kind, text, begin, end)]


def hashes(t: Template, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of each window of ``width`` known tokens of one text, half of them literals at least."""
    n = len(t.kind) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    bad = np.concatenate(([0], np.cumsum(t.kind < 0)))
    slot = np.concatenate(([0], np.cumsum(t.kind >= NUM)))
    ok = (bad[width:] == bad[:-width]) & (t.text[width - 1 :] == t.text[:n]) & (width - (slot[width:] - slot[:-width]) >= (width + 1) // 2)
    at = np.nonzero(ok)[0]
    h = np.zeros(len(at), np.uint64)
    for k in range(width):
        h = h * PRIME + t.kind[at + k].astype(np.uint64) + np.uint64(7)
        h ^= h >> np.uint64(29)
    return h, at


def least_run(n: int) -> int:
    """The tokens that a run must have to match an item of ``n``."""
    return min(RUN, max(SHORTEST, int(-(-n * SHARE // 1))))


@dataclass
class Index:
    """All windows of the items' templates, for each reading; ``tables`` by reading and width."""

    item_ids: list
    words: Interner
    units: np.ndarray
    templates: list[Template]
    sizes: list[np.ndarray]
    tables: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)

    def scan(self, texts: list[bytes | None]) -> list[list[tuple]]:
        """For each text its matches: ``(item id, longest run, item tokens, slots, changed slots)``."""
        out: list[list[tuple]] = [[] for _ in texts]
        at, size, todo = 0, 0, []
        for i, t in enumerate(texts):
            if t:
                todo.append(i)
                size += len(t)
            if todo and (size > SLICE or i == len(texts) - 1):
                read = canonical([texts[k] for k in todo], self.words, False, self.units)
                found: dict[tuple, list[tuple]] = defaultdict(list)
                for (reading, width), (keys, places) in self.tables.items():
                    t, items = read[reading], self.templates[reading].text
                    h, where = hashes(t, width)
                    lo = np.searchsorted(keys, h, "left")
                    hit = np.nonzero(keys[np.minimum(lo, len(keys) - 1)] == h)[0] if len(keys) else []
                    for k in hit:
                        j = int(lo[k])
                        while j < len(keys) and keys[j] == h[k]:
                            found[int(t.text[where[k]]), int(items[places[j]]), reading].append((int(where[k]) - int(places[j]), int(where[k]), width))
                            j += 1
                last = None
                for (doc, item, reading), windows in sorted(found.items()):
                    # The first reading that matches is told.
                    if (doc, item) != last and (m := self.match(read[reading], item, windows, reading)) is not None:
                        out[todo[doc]].append(m)
                        last = doc, item
                todo, size = [], 0
        return out

    def match(self, t: Template, item: int, windows: list[tuple], reading: int) -> tuple | None:
        """The longest run of one item in one text by one reading, if it is long enough."""
        best, n, own = (0, 0, 0), int(self.sizes[reading][item]), self.templates[reading]
        spans: list[list[int]] = []
        for shift, place, width in sorted(set(windows)):
            if spans and spans[-1][0] == shift and place <= spans[-1][2]:
                spans[-1][2] = max(spans[-1][2], place + width)
            else:
                spans.append([shift, place, place + width])
        for shift, start, stop in spans:
            ours, theirs, length, slots, changed = {}, {}, 0, 0, 0
            for p in range(start, stop):
                q = p - shift
                if t.kind[p] != own.kind[q]:
                    ours, theirs, length, slots, changed = {}, {}, 0, 0, 0
                    continue
                if t.kind[p] >= NUM:
                    a = (int(t.kind[p]), own.raw[own.begin[q] : own.end[q]].lower())
                    d = (int(t.kind[p]), t.raw[t.begin[p] : t.end[p]].lower())
                    if ours.setdefault(a, d) != d or theirs.setdefault(d, a) != a:
                        ours, theirs, length, slots, changed = {a: d}, {d: a}, 0, 0, 0
                    slots += 1
                    changed += a != d
                length += 1
                best = max(best, (length, slots, changed))
        if best[0] >= least_run(n):
            return (self.item_ids[item], best[0], n, best[1], best[2])
        return None


def build(items: list[tuple[int | None, str | None]]) -> Index:
    """From ``(item id, text)``; items of fewer than ``SHORTEST`` tokens are too common to tell anything and match nothing."""
    words = Interner()
    unit_words = canonical([" ".join(UNITS).encode()], words, True)[0].kind
    templates = canonical([(x or "").encode() for _, x in items], words, True, unit_words)
    index = Index([i for i, _ in items], words, unit_words, templates, [np.bincount(t.text, minlength=len(items)) for t in templates])
    for reading, (t, sizes) in enumerate(zip(templates, index.sizes)):
        # Windows of short items are as narrow as the run that they need, or the whole item, which may have literals enough where those haven't.
        widths = np.array([min(WINDOW, least_run(n)) if n >= SHORTEST else 0 for n in sizes.tolist()], np.int64)
        whole = np.where(widths > 0, np.minimum(sizes, WINDOW), 0)
        for width in sorted({*widths.tolist(), *whole.tolist()} - {0}):
            h, at = hashes(t, width)
            own = (widths[t.text[at]] == width) | (whole[t.text[at]] == width)
            h, at = h[own], at[own]
            order = np.lexsort((at, h))
            index.tables[reading, width] = (h[order], at[order])
    return index


def indexes(bench: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[Index]:
    """Indexes that together hold every item, each over ``INDEX_BYTES`` of text or so."""
    rows = bench.select(bench[id_col].alias("i"), text_of(bench, text_col).alias("t"))
    passes = int((rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0) // INDEX_BYTES) + 1
    for k in range(passes):
        got = rows.where(F.pmod(F.xxhash64("t"), F.lit(passes)) == k).toArrow()
        yield build(sorted(zip(got["i"].to_pylist(), got["t"].to_pylist()), key=lambda r: (r[0] is None, r[0] or 0, r[1])))


def matches(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, run, item_tokens, slots, changed_slots`` for each document and item that it holds.

    Whole texts are scanned, null counting as empty; repeated rows are reported each.
    Items and documents without ids keep null there. An empty table on either side
    gives an empty table; other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    fields = [("doc_id", pa.int64()), ("item_id", pa.int64()), *((n, pa.int64()) for n in ("run", "item_tokens", "slots", "changed_slots"))]
    out = None
    for index in indexes(bench):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = shared.value.scan(b.column(1).cast(pa.binary()).to_pylist())
                rows = [(i, *m) for i, ms in zip(b.column(0).to_pylist(), found) for m in ms]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows), fields)], names=[n for n, _ in fields])

        part = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text")).mapInArrow(run, ", ".join(f"{n} long" for n, _ in fields))
        out = part if out is None else out.unionByName(part)
    return out


def leaked(text: Column, bench: DataFrame) -> Column:
    """Whether a text holds any item."""
    spark = bench.sparkSession
    ship_package(spark)

    def holds(shared) -> Column:
        @F.arrow_udf("boolean")
        def any_item(texts: pa.Array) -> pa.Array:
            return pa.array([bool(m) for m in shared.value.scan(texts.cast(pa.binary()).to_pylist())], pa.bool_())

        return any_item(F.coalesce(text, F.lit("")))

    out = F.lit(False)
    for index in indexes(bench):
        out = out | holds(spark.sparkContext.broadcast(index))
    return out


def op3_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of the whole table that holds a benchmark item, and the items."""
    return matches(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
