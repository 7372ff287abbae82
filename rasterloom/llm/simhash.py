"""SimHash near-duplicate classes found with BK-trees.

Fingerprints are computed over word shingles. Equal fingerprints collapse to one
class first. The classes are then dealt to shards by bits that two linked
fingerprints share, and each shard links its members through a BK-tree: children
are keyed by their integer Hamming distance to the parent, and a query follows
only the edges within the radius. A shard's tree stays where the shard is, as
trees grow with the corpus and a broadcast of them would have no bound.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.llm.common import documents, free_name, materialize, remove, ship_package, text_of, words_of, work_dir
from rasterloom.llm.components import connected_components

SEED = 42
CHUNK = 1 << 16
#: A shard of more classes than this is split into chunks, and pairs of chunks are linked by tasks of their own.
SHARD_CAP = 2048
#: Split shards are told to all tasks; this many at most, the largest first.
HOT_SHARDS = 4096


def shingles(text: str | None, k: int) -> tuple[bytes, list[int], list[int]]:
    """The words of a text joined by spaces, and where each of its ``k``-word shingles begins and ends."""
    words = words_of(text)
    if not words:
        return b"", [], []
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(k, len(words))
    return b" ".join(words), starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()


def fingerprint(text: str | None, shingle_words: int = 3, bits: int = 64, distinct: bool = False) -> str:
    """SimHash in lower-case hex: a bit is 1 if it is set in over half of the shingles' XXH64 values.

    A shingle counts as often as it occurs, or once if ``distinct``; then the distance of
    two fingerprints tells how similar the sets of shingles are.

    Fewer words than a shingle give one shingle of them all; no words (empty or null
    text) give zero. ``bits`` over 64 take further hash seeds, counted up from 42.
    Memory is bounded for texts of any length: shingles are counted in chunks.
    """
    return counted_fingerprint(text, shingle_words, bits, distinct)[0]


def counted_fingerprint(text: str | None, shingle_words: int, bits: int, distinct: bool) -> tuple[str, int]:
    """``fingerprint`` and the number of shingles in it."""
    joined, starts, ends = shingles(text, shingle_words)
    if not starts:
        return "0" * (bits // 4), 0
    if distinct:
        places = {joined[s:e]: (s, e) for s, e in zip(starts, ends)}.values()
        starts, ends = [s for s, _ in places], [e for _, e in places]
    out = ""
    for lane in range(bits // 64):
        digest, seed, set_bits = xxhash.xxh64_intdigest, SEED + lane, np.zeros(64, np.int64)
        for at in range(0, len(starts), CHUNK):
            h = np.fromiter((digest(joined[s:e], seed) for s, e in zip(starts[at : at + CHUNK], ends[at : at + CHUNK])), np.uint64, min(CHUNK, len(starts) - at))
            set_bits += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
        out += np.packbits(set_bits * 2 > len(starts)).tobytes().hex()
    return out, len(starts)


def shingle_set(text: str | None, shingle_words: int) -> np.ndarray:
    """The sorted XXH64 values of a text's shingles, each once; a text without words has the one value 0."""
    joined, starts, ends = shingles(text, shingle_words)
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts, ends)), np.uint64, len(starts))) if starts else np.zeros(1, np.uint64)


class BKTree:
    """Fingerprints as integers under Hamming distance."""

    def __init__(self) -> None:
        self.root: list | None = None

    def add(self, value: int, tag: int) -> None:
        if self.root is None:
            self.root = [value, tag, {}]
            return
        node = self.root
        while (child := node[2].get(d := (value ^ node[0]).bit_count())) is not None:
            node = child
        node[2][d] = [value, tag, {}]

    def within(self, value: int, radius: int) -> list[int]:
        """Tags of all members at ``radius`` or fewer differing bits."""
        found, todo = [], [self.root] if self.root else []
        while todo:
            own, tag, children = todo.pop()
            d = (value ^ own).bit_count()
            if d <= radius:
                found.append(tag)
            for at, child in children.items():
                if d - radius <= at <= d + radius:
                    todo.append(child)
        return found


def link_pairs(values: list[int], radius: int, bits: int) -> list[tuple[int, int]]:
    """Positions of pairs at ``radius`` or fewer bits: so many, one less for each component than it has members, that they join all its members.

    Where the radius is so wide that triangle bounds exclude nothing (over an eighth of
    the bits) and the shard is large, members are scanned flat, with those that were
    reached taken out; the components are the same.
    """
    out: list[tuple[int, int]] = []
    if len(values) <= 48 or radius * 8 <= bits:
        parent, tree = list(range(len(values))), BKTree()
        for i, v in enumerate(values):
            for j in tree.within(v, radius):
                if joins(parent, i, j):
                    out.append((i, j))
            tree.add(v, i)
        return out
    lanes = np.array([[(v >> s) & (2**64 - 1) for s in range(0, bits, 64)] for v in values], np.uint64)
    return reach(len(values), lambda i, left: np.bitwise_count(lanes[left] ^ lanes[i]).sum(1, dtype=np.int64) <= radius)


def joins(parent: list[int], i: int, j: int) -> bool:
    """Unite the classes of ``i`` and ``j`` under the least member; False if they were one."""
    i, j = root(parent, i), root(parent, j)
    parent[max(i, j)] = min(i, j)
    return i != j


def root(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def reach(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Pairs that join each component of ``n`` members; ``near`` tells which of those left a member links to."""
    out, left = [], np.arange(n)
    while len(left):
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            i = todo.pop()
            on = near(i, left)
            found = left[on].tolist()
            out += [(j, i) for j in found]
            todo += found
            left = left[~on]
    return out


def link(values: list[int], radius: int, bits: int) -> list[int]:
    """For each value the position of the first value of its component, linking at ``radius`` or fewer bits."""
    parent = list(range(len(values)))
    for i, j in link_pairs(values, radius, bits):
        joins(parent, i, j)
    return [root(parent, i) for i in range(len(values))]


def similar(shared: np.ndarray | int, sizes: np.ndarray | int) -> np.ndarray | bool:
    """Whether sets of ``sizes`` members together, of which ``shared`` are in both, have a Jaccard similarity of 0.8 or more."""
    return 9 * shared >= 4 * sizes


def link_sets(values: list[bytes]) -> list[tuple[int, int]]:
    """``link_pairs`` for shingle sets whose similarity is 0.8 or more."""
    sets = [np.frombuffer(v, np.uint64) for v in values]
    size = np.array([len(x) for x in sets])
    known, at = np.unique(np.concatenate(sets), return_inverse=True)
    begin, flag = np.cumsum(size) - size, np.zeros(len(known), np.int32)

    def near(i: int, left: np.ndarray) -> np.ndarray:
        own = at[begin[i] : begin[i] + size[i]]
        flag[own] = 1
        shared = np.add.reduceat(flag[at], begin)[left]
        flag[own] = 0
        return similar(shared, size[left] + size[i])

    return reach(len(sets), near)


def exact_bands(bits: int, blocks: int, radius: int) -> list[list[int]]:
    """Bit positions of each shard key such that any two fingerprints within ``radius`` share at least one key.

    The bits are cut in ``blocks``; at most ``radius`` of them can differ, so some
    ``blocks - radius`` of them agree.
    """
    cut = np.array_split(np.arange(bits), blocks)
    return [np.concatenate(x).tolist() for x in combinations(cut, blocks - radius)]


def sampled_bands(bits: int, width: int, tables: int) -> list[list[int]]:
    """``tables`` keys of ``width`` bits from a fixed sequence of permutations; for radii too wide for ``exact_bands``."""
    rng, out = np.random.Generator(np.random.PCG64(SEED)), []
    while len(out) < tables:
        p = rng.permutation(bits)
        out += [sorted(p[i : i + width].tolist()) for i in range(0, bits - width + 1, width)]
    return out[:tables]


def fingerprints(df: DataFrame, id_col: str, text_col: str, shingle_words: int, bits: int, distinct: bool = False) -> DataFrame:
    """``(id long, fp string, n int)`` for every row; ``n`` is the number of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [counted_fingerprint(t.as_py(), shingle_words, bits, distinct) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([f for f, _ in got], pa.string()), pa.array([n for _, n in got], pa.int32())], names=["id", "fp", "n"])

    return df.select(df[id_col].cast("long").alias("id"), text_of(df, text_col).alias("text")).mapInArrow(run, "id long, fp string, n int")


def band_keys(classes: DataFrame, bits: int, bands: list[list[int]]) -> DataFrame:
    """``classes(node long, fp string)`` -> ``(key long, node long, value binary)``: one row for each of ``bands``."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = [(np.array(p), 1 << np.arange(len(p) - 1, -1, -1, dtype=np.int64)) for p in bands]
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            raw = np.frombuffer(bytes.fromhex("".join(b.column(1).to_pylist())), np.uint8).reshape(n, bits // 8)
            on, values = np.unpackbits(raw, axis=1).astype(np.int64), pa.array([r.tobytes() for r in raw], pa.binary())
            for t, (p, w) in enumerate(places):
                yield pa.RecordBatch.from_arrays([pa.array((on[:, p] @ w) + (t << len(p))), b.column(0), values], names=["key", "node", "value"])

    return classes.select("node", "fp").mapInArrow(keys, "key long, node long, value binary")


def linked_in_shards(keyed: DataFrame, pairs_of: Callable[[list[bytes]], list[tuple[int, int]]], cap: int, weight: Column) -> DataFrame:
    """``keyed(key, node, value binary)`` -> ``(a, b)``: the pairs that ``pairs_of`` finds among the values of each key.

    A key of more ``weight`` than ``cap`` is split into chunks, and each pair of chunks is a task's group.
    """

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(nodes: list[int], values: list[bytes]) -> Iterator[pa.RecordBatch]:
            pairs = pairs_of(values) if len(nodes) > 1 else []
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array([nodes[i] for i, _ in pairs], pa.int64()), pa.array([nodes[j] for _, j in pairs], pa.int64())], names=["a", "b"])

        last, nodes, values = None, [], []
        for batch in batches:
            for key, i, j, node, value in zip(*(c.to_pylist() for c in batch.columns)):
                if (key, i, j) != last:
                    yield from out(nodes, values)
                    last, nodes, values = (key, i, j), [], []
                nodes.append(node)
                values.append(value)
        yield from out(nodes, values)

    hot = keyed.groupBy("key").agg(F.sum(weight).alias("w")).where(F.col("w") > cap).orderBy(F.desc("w"), "key").limit(HOT_SHARDS)
    hot = hot.select("key", F.ceil(F.col("w") / cap).cast("int").alias("g"))
    dealt = keyed.join(F.broadcast(hot), "key", "left").withColumn("g", F.coalesce("g", F.lit(1)))
    dealt = dealt.withColumn("c", F.pmod(F.xxhash64("node"), F.col("g")).cast("int"))
    # A chunk meets every other chunk of its shard once; with one chunk that is the shard itself.
    other = F.when(F.col("g") == 1, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), F.col("g") - 1), lambda x: x != F.col("c")))
    dealt = dealt.withColumn("o", F.explode(other)).select("key", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"), "node", "value")
    return dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "node").mapInArrow(linked, "a long, b long")


def near_edges(classes: DataFrame, radius: int, bits: int, bands: list[list[int]], pairs: bool = False) -> DataFrame:
    """``classes(node long, fp string)`` -> ``(a, b)``: in each shard, every member with the first of its component there.

    With ``pairs``, pairs that are themselves within the radius instead. At most one row
    for each member and shard either way, whatever the size of a component.
    """

    def of(values: list[bytes]) -> list[tuple[int, int]]:
        numbers = [int.from_bytes(v, "big") for v in values]
        return link_pairs(numbers, radius, bits) if pairs else [(i, r) for i, r in enumerate(link(numbers, radius, bits)) if i != r]

    return linked_in_shards(band_keys(classes, bits, bands), of, SHARD_CAP, F.lit(1))


def near_classes(fps: DataFrame, radius: int, bits: int, bands: list[list[int]]) -> DataFrame:
    """``fps(id long, fp string)`` -> ``(fp, component)``: the smallest id reachable over links of ``radius`` or fewer bits."""
    classes = materialize(fps.groupBy("fp").agg(F.min("id").alias("node")))
    cc = connected_components(near_edges(classes.where("node IS NOT NULL"), radius, bits, bands))
    return classes.join(cc, "node", "left").select("fp", F.coalesce("component", "node").alias("component"))


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, radius: int = 2, bits: int = 64, bands: list[list[int]] | None = None) -> DataFrame:
    """One row for each input row: ``doc_id, fingerprint, component_id``.

    Null and empty texts have fingerprint zero and are linked like any other. Repeated
    rows stay and share a component. A null id never names a component unless all ids
    of a fingerprint are null, in which case the component is null. An empty table
    gives an empty table; other columns are not read.
    """
    ship_package(df.sparkSession)
    fps = materialize(fingerprints(df, id_col, text_col, shingle_words, bits))
    of = materialize(near_classes(fps, radius, bits, bands or exact_bands(bits, 4, radius)))
    return fps.join(of, "fp").select(F.col("id").alias("doc_id"), F.col("fp").alias("fingerprint"), F.col("component").alias("component_id"))


#: For pipelines: five-word shingles. Texts of Jaccard similarity 0.8 differ in 39 of 256 bits on average, with a deviation of 6, unrelated ones in 128 with one of 8.
NEAR_WORDS, NEAR_BITS, NEAR_RADIUS = 5, 256, 50
#: Where links are checked by shingle sets, candidates may differ in three deviations more than the average.
CANDIDATE_RADIUS = 57
#: Texts of so few different shingles that a fingerprint says little; a text of 48 shingles can be similar to one of 60 at most.
FEW = 60
#: Shards of shingle sets are split beyond this many shingles.
SET_CAP = 1 << 20
#: A text's links are dealt over this many tasks where its set is fetched.
SALTS = 64


def near_bands(n: int) -> list[list[int]]:
    """Sampled shard keys for ``n`` classes: of so many bits that a shard holds some 64 unrelated ones, and in so many tables that two texts of similarity 0.8 are expected to share six shards whatever the bits."""
    width = min(40, max(14, (max(n, 2) - 1).bit_length() - 6))
    return sampled_bands(NEAR_BITS, width, int(np.ceil(6.4 / (1 - 39 / 256) ** width)))


def shingle_sets(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id long, value binary)``: the shingle set of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingle_set(t.as_py(), NEAR_WORDS).tobytes() for t in b.column(1)], pa.binary())], names=["id", "value"])

    return rows.select(rows[id_col].alias("id"), text_of(rows, text_col).alias("text")).mapInArrow(run, "id long, value binary")


def with_set(pairs: DataFrame, end: str, other: str, sets: DataFrame) -> DataFrame:
    """``pairs`` with the set of one end; an end may hold any share of the pairs, so they are dealt by the other."""
    dealt = pairs.withColumn("share", F.pmod(F.xxhash64(other), F.lit(SALTS)).cast("int"))
    held = dealt.select(end, "share").distinct().join(sets.select(F.col("id").alias(end), F.col("value").alias(f"of_{end}")), end)
    return dealt.join(held, [end, "share"]).drop("share")


def checked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs(a, b)`` with ``ok``: whether the shingle sets have a similarity of 0.8 or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                ok.append(bool(similar(len(np.intersect1d(x, y, assume_unique=True)), len(x) + len(y))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ok, pa.bool_())], names=["a", "b", "ok"])

    return with_set(with_set(pairs, "a", "b", sets), "b", "a", sets).select("a", "b", "of_a", "of_b").mapInArrow(run, "a long, b long, ok boolean")


def prefix_keys(sets: DataFrame) -> DataFrame:
    """``sets(node, value)`` -> ``(key, node, value)``: the first shingles of a set, so many that sets of similarity 0.8 share one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, at = [], []
            for i, v in enumerate(b.column(1)):
                own = np.frombuffer(v.as_py(), np.int64)
                keys.append(own[: len(own) - (4 * len(own) + 4) // 5 + 1])
                at.append(np.full(len(keys[-1]), i))
            if keys:
                at = pa.array(np.concatenate(at))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), b.column(0).take(at), b.column(1).take(at)], names=["key", "node", "value"])

    return sets.mapInArrow(run, "key long, node long, value binary")


def near_pairs(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(a, b)``: pairs of similar texts that join all members of each group of near copies.

    SimHash finds candidates, and the shingle sets of each are compared. Of a group of
    candidates only so many pairs are written as join it; where one of those is not similar
    after all, another pair may be that was not written, so all members of that group are
    linked anew, shard by shard, by their sets. Texts of few shingles are linked by their
    sets too, in shards of equal shingles among the first, which miss none.
    """
    spark, made = rows.sparkSession, []

    def put(df: DataFrame) -> DataFrame:
        made.append(work_dir(spark))
        return materialize(df, made[-1])

    fps = put(fingerprints(rows, id_col, text_col, NEAR_WORDS, NEAR_BITS, True))
    classes = put(fps.groupBy("fp").agg(F.min("id").alias("node"), F.min("n").alias("n")))
    bands = near_bands(classes.count())
    copies = fps.join(classes.select("fp", "node"), "fp").where("id <> node").select(F.col("id").alias("a"), F.col("node").alias("b"))
    found = near_edges(classes, CANDIDATE_RADIUS, NEAR_BITS, bands, True).unionByName(copies)
    found = put(found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    few = classes.where(F.col("n") <= FEW).select("node")
    ends = found.select("a").union(found.select("b")).union(few).distinct().withColumnRenamed("a", id_col)
    sets = put(shingle_sets(rows.join(ends, id_col, "left_semi"), id_col, text_col))
    of = sets.withColumnRenamed("id", "node")
    weight = F.length("value") / 8
    links = put(checked(found, sets))
    good = links.where("ok").select("a", "b").unionByName(linked_in_shards(prefix_keys(of.join(few, "node", "left_semi").select("node", "value")), link_sets, SET_CAP, weight))
    wrong = links.where("NOT ok")
    if wrong.head(1):
        group = put(connected_components(found))
        torn = group.join(wrong.select(F.col("a").alias("node")).distinct(), "node", "left_semi").select("component").distinct()
        again = classes.join(group.join(torn, "component", "left_semi"), "node", "left_semi")
        keyed = band_keys(again, NEAR_BITS, bands).drop("value").join(of, "node").select("key", "node", "value")
        good = good.unionByName(linked_in_shards(keyed, link_sets, SET_CAP, weight))
    good = materialize(good.distinct())
    for path in made:
        remove(spark, path)
    return good


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", exact: bool = False) -> DataFrame:
    """The rows of ``docs``, with all columns, of which one stays for each group of near copies: that of the smallest id.

    Two texts are linked where the SimHash of their sets of five-word shingles says that
    the similarity is 0.8 or more, give or take the deviation of the estimate. The radius is
    too wide for bits that must agree, so shards are sampled bits, in as many tables as
    leave a pair at 0.8 a chance of 1 % or so to share none. With ``exact`` the fingerprints
    only find candidates, and the sets themselves decide (``near_pairs``). Null ids come
    after others; rows of equal ids are rows of their own; an empty table gives an empty table.
    """
    ship_package(docs.sparkSession)
    rid = free_name(docs, "__rid")
    # Written once: numbers made anew by a second scan could differ, as splits follow the number of executors.
    rows = materialize(docs.withColumn(rid, F.monotonically_increasing_id()))
    ids = rows.select(F.col(rid).alias("id"), F.col(id_col).alias("name"))
    if exact:
        of = connected_components(near_pairs(rows, rid, text_col)).withColumnRenamed("node", "id")
        named = ids.join(of, "id", "left").withColumn("component", F.coalesce("component", "id"))
    else:
        fps = materialize(fingerprints(rows, rid, text_col, NEAR_WORDS, NEAR_BITS, True))
        of = materialize(near_classes(fps, NEAR_RADIUS, NEAR_BITS, near_bands(fps.count())))
        named = fps.join(of, "fp").join(ids, "id")
    first = named.groupBy("component").agg(F.min(F.struct(F.col("name").isNull().alias("z"), "name", "id")).alias("first"))
    return rows.join(first.select(F.col("first.id").alias(rid)), rid, "left_semi").drop(rid)


def op4_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of the whole ``documents`` table: 3-word shingles, 64 bits, radius 2."""
    return simhash_components(documents(spark, sf_dir))
