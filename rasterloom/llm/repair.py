"""Token ids in Re-Pair shards: a grammar for each shard, with random access to documents and ranges.

A shard holds whole documents in order. Pairs of neighbouring symbols within documents
become nonterminals, the more frequent of two that overlap first, until no pair occurs
``least`` times; with the default of 2, until none is left that repeats. A shard is one
row of a Parquet table, written by Spark's committer; its ``payload`` is laid out as
follows, little-endian:

    magic "RPR2"; uint32 documents, rules, first nonterminal; uint8 bits of a symbol; uint8 bytes of a length; uint64 symbols
    int64 document ids; uint8 null-id flags; uint64 ends of the documents in symbols
    the left and then the right symbol of each rule; the symbols: each of the three padded to a multiple of 8 symbols, bit by bit from the least
    the expansion length of each rule, uint16, uint32 or uint64
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rasterloom.llm.common import documents, ship_package, text_of, work_dir
from rasterloom.llm.interning import windows
from rasterloom.llm.tokens import encoder, vocabulary

END_ID = 2
SHARD_TOKENS = 1 << 20
#: Pairs that occur so often are replaced; 2 leaves no pair that repeats.
LEAST = 2
HEAD = "<4sIIIBBQ"


def grammar(ids: np.ndarray, ends: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair over documents that end at ``ends``: ``(symbols, ends, left, right, lens)``.

    Nonterminals are numbered from the largest id on; ``lens`` are the rules' expansion
    lengths. In each round pairs get a name where they are more frequent than both pairs
    that overlap them, which is what taking the most frequent pair first comes to there;
    then all other places of the named pairs follow that no longer overlap a more
    frequent one, so no pair has two names. A replacement can only lower the counts of
    the pairs that were there before, so the next round counts only the pairs around new
    symbols and those left over. Counts leave out overlaps of a pair with itself, as in
    a run of one id.
    """
    n = len(ids)
    first = int(ids.max()) + 1 if n else 0
    sym = np.append(ids.astype(np.int32), np.int32(0))
    following, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
    following[ends - 1] = following[n] = n
    before[ends[:-1]] = before[n] = n
    before[:1] = n
    found, made = np.zeros(n + 1, bool), 0
    rules, numbers = [(np.zeros(0, np.int32), np.zeros(0, np.int32))], np.arange(n)
    at = np.flatnonzero(following[:n] < n)
    after = following[at]
    # Places stay in ascending order, so that all but the sort by pairs runs along memory, and
    # what follows one of them in the text is next in the list or not in it: ``link`` tells which.
    while len(at):
        base, bits = first + made, len(at).bit_length()
        link = np.append(after[:-1] == at[1:], False)
        apart = np.flatnonzero(~link)
        a = sym[at]
        b = np.append(a[1:], np.int32(0))
        b[apart] = sym[after[apart]]
        own = np.flatnonzero(a == b)
        twice = own.compress(overlaps(at[own], after[own]))
        key = a.astype(np.int64)
        key *= base
        key += b
        if 2 * base.bit_length() + bits < 63:
            key <<= bits
            key |= numbers[: len(at)]
            key.sort()
            k = key & ((1 << bits) - 1)
            key >>= bits
        else:
            k = np.argsort(key, kind="stable")
            key = key[k]
        begin = np.append(0, np.flatnonzero(key[1:] != key[:-1]) + 1)
        pair, size = key[begin], np.diff(begin, append=len(key))
        often = np.flatnonzero(size >= least)
        count = (size - np.bincount(np.searchsorted(pair, a[twice] * np.int64(base + 1)), minlength=len(size)))[often]
        left, right = np.divmod(pair[often], base)
        order = (count << 32) | np.arange(len(often))
        order.sort()
        order &= 0xFFFFFFFF
        standing = np.zeros(len(size), np.int32)
        standing[often[order]] = np.arange(1, len(often) + 1, dtype=np.int32)
        standing[often[count < least]] = 0
        # From here on pairs go by their standing, 0 for a rare one; a place where a pair overlaps itself begins no round.
        r = np.empty(len(at), np.int32)
        r[k] = np.repeat(standing, size)
        late = r[twice]
        r[twice] = 0
        heads = peaks(r, link[:-1])
        used = np.bincount(r[heads], minlength=len(often) + 1) >= least
        heads = heads.compress(used[r[heads]])
        r[twice] = late
        same, taken, seen = np.append(False, (left == right)[order]), np.zeros(len(at), bool), np.zeros(len(at) + 1, bool)
        taken[heads] = seen[heads] = True
        seen[heads.compress(link[heads]) + 1] = True
        todo = np.flatnonzero(used.take(r) & ~(seen[:-1] | (link & seen[1:])))
        while len(heads):
            now = r[todo]
            own = np.flatnonzero(same[now])
            now[own.compress(overlaps(at[todo[own]], after[todo[own]]))] = 0
            heads = todo[peaks(now, link[todo[:-1]] & (todo[1:] == todo[:-1] + 1))]
            taken[heads] = seen[heads] = True
            seen[heads.compress(link[heads]) + 1] = True
            todo = todo.compress(~(seen[todo] | (link[todo] & seen[todo + 1])))
        named = np.flatnonzero(taken)
        if not len(named):
            break
        heads, gone = at[named], after[named]
        sym[heads] = (np.cumsum(used) + (base - 1)).astype(np.int32)[r[named]]
        ahead = following[gone]
        following[heads] = ahead
        before[ahead] = heads
        before[n] = following[gone] = n
        sym[gone] = -1
        chosen = order[used[1:]]
        rules.append((left[chosen].astype(np.int32), right[chosen].astype(np.int32)))
        made += len(chosen)
        # What is left of the frequent pairs, and the pairs around new symbols.
        parts = at.compress((r != 0) & ~seen[:-1]), heads.compress(ahead < n), before[heads]
        if 256 * len(at) > n:
            for x in parts:
                found[x] = True
            found[n] = False
            at = np.flatnonzero(found)
            found[at] = False
        else:
            at = np.unique(np.concatenate(parts))
            at = at[: np.searchsorted(at, n)]
        after = following[at]
    lens, k = np.ones(made, np.int64), 0
    for pair in rules:
        lens[k : k + len(pair[0])] = sum(np.where(x < first, 1, lens[np.maximum(x - first, 0)]) for x in pair)
        k += len(pair[0])
    keep = np.flatnonzero(sym[:n] >= 0)
    return sym[keep], np.searchsorted(keep, ends), *map(np.concatenate, zip(*rules)), lens


def peaks(r: np.ndarray, link: np.ndarray) -> np.ndarray:
    """Where numbers are positive and larger than those beside them; ``link`` tells which stand beside the next one."""
    high, apart = r > 0, ~link
    high[1:] &= (r[1:] > r[:-1]) | apart
    high[:-1] &= (r[:-1] > r[1:]) | apart
    return np.flatnonzero(high)


def overlaps(pos: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Which pairs of equal symbols, in ascending order, to leave out because their pair overlaps itself: every other one of a run. ``after`` are the places of their second symbols."""
    k = np.arange(len(pos))
    starts = np.append(True, after[:-1] != pos[1:])[: len(pos)]
    return (k - np.maximum.accumulate(np.where(starts, k, 0))) % 2 == 1


def pack_bits(values: np.ndarray, bits: int) -> bytes:
    """Numbers below ``2 ** bits``, 32 bits at most, without gaps; eight numbers take ``bits`` bytes, the last eight padded."""
    v = np.zeros(-(-len(values) // 8) * 8, np.uint64)
    v[: len(values)] = values
    v = v.reshape(-1, 8)
    out = np.zeros((len(v) + 1, bits + 8), np.uint8)
    for j in range(8):
        eight = np.ndarray(len(v), "<u8", out, j * bits // 8, (bits + 8,))
        eight |= v[:, j] << np.uint64(j * bits % 8)
    return out[:-1, :bits].tobytes()


def unpack_bits(raw: np.ndarray, bits: int, begin: int, end: int) -> np.ndarray:
    """Numbers ``begin:end`` of what ``pack_bits`` gave; no other bytes are read."""
    at = np.arange(begin, end, dtype=np.int64) * bits
    at -= begin * bits >> 3 << 3
    out = windows(np.append(raw[begin * bits >> 3 : (end * bits + 7) >> 3], np.zeros(8, np.uint8)))[at >> 3].view(np.int64)
    at &= 7
    out >>= at
    out &= (1 << bits) - 1
    return out


def pack_shard(doc_ids: list[int | None], docs: list[np.ndarray], least: int = LEAST) -> bytes:
    """The payload for documents of at least one id each."""
    all_ids = np.concatenate(docs) if docs else np.zeros(0, np.uint32)
    ends = np.cumsum([len(d) for d in docs], dtype=np.int64)
    first = int(all_ids.max()) + 1 if len(all_ids) else 0
    symbols, ends, left, right, lens = grammar(all_ids, ends, least)
    bits = max(1, (first + len(left)).bit_length())
    longest = int(lens.max()) if len(lens) else 0
    wide = 2 if longest < 1 << 16 else 4 if longest < 1 << 32 else 8
    head = struct.pack(HEAD, b"RPR2", len(docs), len(left), first, bits, wide, len(symbols))
    ids = np.array([0 if i is None else i for i in doc_ids], "<i8")
    nulls = np.array([i is None for i in doc_ids], np.uint8)
    parts = [ids.tobytes(), nulls.tobytes(), ends.astype("<u8").tobytes(), *(pack_bits(x, bits) for x in (left, right, symbols)), lens.astype(f"<u{wide}").tobytes()]
    return head + b"".join(parts)


class Shard:
    """A reader of one payload."""

    def __init__(self, payload: bytes) -> None:
        magic, n, rules, self.first, self.bits, wide, self.size = struct.unpack_from(HEAD, payload)
        if magic != b"RPR2":
            raise ValueError("not a Re-Pair shard")
        at = struct.calcsize(HEAD)

        def read(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, count, at)
            at += out.nbytes
            return out

        ids, nulls = read("<i8", n), read("u1", n)
        self.doc_ids = [None if z else i for i, z in zip(ids.tolist(), nulls.tolist())]
        self.ends = read("<u8", n).astype(np.int64)
        self.left, self.right = (unpack_bits(read("u1", -(-rules // 8) * self.bits), self.bits, 0, rules) for _ in range(2))
        self.packed = read("u1", -(-self.size // 8) * self.bits)
        self.rule_lens = read(f"<u{wide}", rules).astype(np.int64)
        self.lens = np.concatenate([np.ones(self.first, np.int64), self.rule_lens])

    def symbols(self, begin: int = 0, end: int | None = None) -> np.ndarray:
        return unpack_bits(self.packed, self.bits, begin, self.size if end is None else end)

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids of some symbols; nonterminals are replaced by their rules, all of a level at once."""
        lens = self.lens[symbols]
        at = np.cumsum(lens) - lens
        out = np.empty(int(lens.sum()), np.uint32)
        while len(symbols):
            leaf = symbols < self.first
            done, todo = np.flatnonzero(leaf), np.flatnonzero(~leaf)
            out[at[done]] = symbols[done]
            rule, at = symbols[todo] - self.first, at[todo]
            left, places, symbols = self.left[rule], np.repeat(at, 2), np.empty(2 * len(rule), np.int64)
            symbols[::2], symbols[1::2] = left, self.right[rule]
            places[1::2] += self.lens[left]
            at = places
        return out

    def document(self, k: int) -> np.ndarray:
        """The ids of the shard's k-th document."""
        return self.expand(self.symbols(int(self.ends[k - 1]) if k else 0, int(self.ends[k])))

    def range(self, k: int, start: int, stop: int) -> np.ndarray:
        """Ids ``start:stop`` of the k-th document; only the symbols that overlap the range are expanded."""
        s = self.symbols(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))
        ends = np.cumsum(self.lens[s])
        a, b = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, stop, "left")) + 1
        skip = int(ends[a - 1]) if a else 0
        return self.expand(s[a:b])[max(0, start - skip) : max(0, stop - skip)]

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        symbols = self.symbols()
        sizes = self.lens[symbols]
        lens = np.cumsum(sizes)
        total = int(lens[-1]) if len(lens) else 0
        if self.rule_lens.sum() <= total:
            # Each rule is expanded once, and copied to wherever it stands.
            once = np.concatenate([np.arange(self.first, dtype=np.uint32), self.expand(np.arange(self.first, len(self.lens)))])
            at = np.repeat((np.cumsum(self.lens) - self.lens)[symbols] - (lens - sizes), sizes)
            at += np.arange(total)
            ids = once[at]
        else:
            ids = self.expand(symbols)
        begin = 0
        for i, e in zip(self.doc_ids, self.ends.tolist()):
            end = int(lens[e - 1])
            yield i, ids[begin:end]
            begin = end


SHARDS = "part int, shard int, part_start long, n_tokens long, n_docs long, payload binary"


def write_shards(df: DataFrame, path: str, vocab: str, kind: str = "byte_level", end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = SHARD_TOKENS, least: int = LEAST) -> None:
    """Encode every text, append ``end_id`` and write Re-Pair shards to ``path``, documents in ascending id order.

    Null and empty texts have the end id alone; null ids come first; rows with equal
    ids are ordered by text. Documents are never cut, so a shard with a very long one
    exceeds ``shard_tokens``. An empty table writes no shard.
    """
    spark = df.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, part = encoder(shared.value, kind), TaskContext.get().partitionId()
        shard, before, held, ids, docs = 0, 0, 0, [], []

        def out() -> pa.RecordBatch:
            row = {"part": part, "shard": shard, "part_start": before, "n_tokens": held, "n_docs": len(docs), "payload": pack_shard(ids, docs, least)}
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("part_start", pa.int64()), ("n_tokens", pa.int64()), ("n_docs", pa.int64()), ("payload", pa.binary())]))

        for b in batches:
            keys = b.column(0).to_pylist()
            for at in range(0, b.num_rows, 256):
                texts = b.column(1).slice(at, 256).cast(pa.binary()).to_pylist()
                for i, x in zip(keys[at : at + 256], enc.encode(texts)):
                    ids.append(i)
                    docs.append(np.append(x, np.uint32(end_id)))
                    held += len(docs[-1])
                    if held >= shard_tokens:
                        yield out()
                        shard, before, held, ids, docs = shard + 1, before + held, 0, [], []
        if docs:
            yield out()

    rows = df.select(df[id_col].cast("long").alias("id"), text_of(df, text_col).alias("text"))
    rows.repartitionByRange("id").sortWithinPartitions("id", "text").mapInArrow(run, SHARDS).write.parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the shards below ``path``; ``start`` counts the ids of all documents before."""
    ship_package(spark)
    table = spark.read.schema(SHARDS).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, start, payload in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                rows = []
                for i, ids in Shard(payload.as_py()).documents():
                    rows.append((i, part, start, len(ids), zlib.crc32(ids.astype("<u4", copy=False))))
                    start += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=["doc_id", "part", "part_start", "n_tokens", "ids_crc32"])

    docs = table.select("part", "part_start", "payload").mapInArrow(run, "doc_id long, part int, part_start long, n_tokens long, ids_crc32 long")
    # One row for each partition that wrote shards, so this table stays small however many documents there are.
    totals = table.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    base = totals.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    return docs.join(F.broadcast(base), "part").select("doc_id", (F.col("base") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32")


def op1_repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum, read back from Re-Pair shards of the whole ``documents`` table."""
    path = work_dir(spark)
    write_shards(documents(spark, sf_dir), path, vocabulary("byte_bpe_50k.json"))
    return read_shards(spark, path)
