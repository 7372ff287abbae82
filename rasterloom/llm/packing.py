"""Vector bin packing of token sequences by the dot-product heuristic.

A sequence has limits on tokens, segments and loss-bearing tokens at once. While a
sequence is open, the waiting example whose demand vector has the largest weighted
dot product with the remaining room goes next, among those that fit in every
dimension; weights are the mean demands of the waiting examples. When none fits,
the best one is cut to fill the rest. Each task packs its own documents through a
bounded pool, so nothing is shuffled and memory doesn't grow with the input.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.llm.common import documents, ship_package, text_of
from rasterloom.llm.tokens import encoder, vocabulary

END_ID, MAX_TOKENS, MAX_SEGMENTS, POOL = 1, 2048, 256, 512
#: Words whose ids a worker keeps: fewer than by default, as this runs in workers that have done other stages.
KEPT_WORDS = 400_000
#: Turns of a conversation that are taken together.
TURNS = 64


@dataclass
class Example:
    """Tokens of an example from ``start`` on; ``loss`` marks loss-bearing ones, None: all."""

    key: object
    ids: np.ndarray
    start: int = 0
    loss: np.ndarray | None = None

    @property
    def size(self) -> int:
        return len(self.ids) - self.start

    @property
    def weight(self) -> int:
        return self.size if self.loss is None else int(self.loss[self.start :].sum())

    def prefix(self, tokens: int, loss: int) -> int:
        """The longest prefix within both limits."""
        n = min(tokens, self.size)
        if self.loss is None:
            return min(n, loss)
        return int(np.searchsorted(np.cumsum(self.loss[self.start : self.start + n]), loss, "right"))


class Packer:
    """Feed examples with ``add``; sequences come out as lists of ``(example, start, length)``."""

    def __init__(self, max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS, max_loss: int | None = None, cut: bool = True, pool: int = POOL) -> None:
        self.limits = np.array([max_tokens, max_segments, max_loss or max_tokens], float)
        self.cut, self.cap = cut, pool
        self.waiting: list[Example] = []
        self.demand = np.zeros((pool + 2, 3))

    def add(self, e: Example) -> Iterator[list[tuple]]:
        tokens, _, loss = (int(x) for x in self.limits)
        if not self.cut and (e.size > tokens or e.weight > loss):
            raise ValueError("an example exceeds the limits and may not be cut")
        while self.cut and (e.size >= tokens or e.weight > loss):
            n = e.prefix(tokens, loss)
            yield [(e, e.start, n)]
            e = Example(e.key, e.ids, e.start + n, e.loss)
        if e.size:
            self.put(e)
        if len(self.waiting) >= self.cap:
            yield self.sequence()

    def put(self, e: Example) -> None:
        self.demand[len(self.waiting)] = (e.size, 1, e.weight)
        self.waiting.append(e)

    def take(self, i: int) -> Example:
        e, last = self.waiting[i], self.waiting.pop()
        if last is not e:
            self.waiting[i] = last
            self.demand[i] = self.demand[len(self.waiting)]
        return e

    def sequence(self) -> list[tuple]:
        """The next sequence from the waiting examples."""
        room, out = self.limits.copy(), []
        weights = self.demand[: len(self.waiting)].mean(0) / self.limits**2
        while self.waiting and room.min() > 0:
            d = self.demand[: len(self.waiting)]
            score = d @ (weights * room)
            fits = (d <= room).all(1)
            if fits.any():
                i = int(np.where(fits, score, -1.0).argmax())
                e = self.take(i)
                n = e.size
            elif self.cut:
                e = self.take(int(score.argmax()))
                n = e.prefix(int(room[0]), int(room[2]))
                if n == 0:
                    self.put(e)
                    break
                if n < e.size:
                    self.put(Example(e.key, e.ids, e.start + n, e.loss))
            else:
                break
            out.append((e, e.start, n))
            room -= (n, 1, n if e.loss is None else int(e.loss[e.start : e.start + n].sum()))
        return out

    def finish(self) -> Iterator[list[tuple]]:
        """What waits still; with cuts, the last sequence falls into powers of two, which need no padding."""
        while self.waiting:
            s = self.sequence()
            size = sum(n for _, _, n in s)
            if self.waiting or not self.cut or size == self.limits[0]:
                yield s
                continue
            for bit in range(size.bit_length() - 1, -1, -1):
                if size >> bit & 1:
                    part, left = [], 1 << bit
                    while left:
                        e, start, n = s.pop(0)
                        part.append((e, start, min(n, left)))
                        if n > left:
                            s.insert(0, (e, start + left, n - left))
                        left -= min(n, left)
                    yield part


def pack_documents(df: DataFrame, vocab: str, kind: str = "words", end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens``, one row for each piece.

    Every id of every document, with ``end_id`` after its text, lies in exactly one
    piece. Null and empty texts have the end id alone. Repeated rows are packed each.
    All tokens of a document bear loss. Null ids stay null. An empty table gives an
    empty table. Sequence ids are unique, but not dense: the task's number is in
    their high bits.
    """
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(vocab)
    fields = [(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, packer, number, rows = encoder(shared.value, kind, KEPT_WORDS), Packer(max_tokens, max_segments), TaskContext.get().partitionId() << 40, []

        def note(sequence: list[tuple]) -> None:
            nonlocal number
            at, size = 0, sum(n for _, _, n in sequence)
            for e, start, n in sequence:
                rows.append((e.key, start, n, zlib.crc32(e.ids[start : start + n].astype("<u4", copy=False)), len(e.ids), number, at, size))
                at += n
            number += 1

        def out() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields)], names=[n for n, _ in fields])
            rows.clear()
            return b

        for b in batches:
            keys = b.column(0).to_pylist()
            for at in range(0, b.num_rows, 256):
                texts = b.column(1).slice(at, 256).cast(pa.binary()).to_pylist()
                for key, ids in zip(keys[at : at + 256], enc.encode(texts)):
                    for s in packer.add(Example(key, np.append(ids, np.uint32(end_id)))):
                        note(s)
                if len(rows) > 10_000:
                    yield out()
        for s in packer.finish():
            note(s)
        if rows:
            yield out()

    return df.select(df[id_col].cast("long").alias("id"), text_of(df, text_col).alias("text")).mapInArrow(run, ", ".join(f"{n} long" for n, _ in fields))


def pack_conversations(df: DataFrame, vocab: str, kind: str = "words", end_id: int = END_ID, max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS, max_loss: int | None = None, learned: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``conv_id, turn, start, length, loss_tokens, sequence_id, offset, sequence_tokens`` for instruction data ``(conv_id, turn, role, text)``.

    An example is a conversation's turns in order, ``end_id`` after each; turns of the
    ``learned`` roles bear loss, their end ids included. Conversations are taken in pieces
    of ``TURNS`` turns, which ``turn`` names by their first, so that one with any number
    of turns is never gathered in one place. Null texts count as empty, null turns as 0;
    rows of equal turns are ordered by role and text. An empty table gives an empty table.
    """
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(vocab)
    fields = [(n, pa.int64()) for n in ("conv_id", "turn", "start", "length", "loss_tokens", "sequence_id", "offset", "sequence_tokens")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, packer, number, rows = encoder(shared.value, kind, KEPT_WORDS), Packer(max_tokens, max_segments, max_loss), TaskContext.get().partitionId() << 40, []
        key, ids, loss = None, [], []

        def note(sequence: list[tuple]) -> None:
            nonlocal number
            at, size = 0, sum(n for _, _, n in sequence)
            for e, start, n in sequence:
                rows.append((*e.key, start, n, int(e.loss[start : start + n].sum()), number, at, size))
                at += n
            number += 1

        def close() -> None:
            if ids:
                for s in packer.add(Example((key[0], key[2]), np.concatenate(ids), 0, np.concatenate(loss))):
                    note(s)
            ids.clear()
            loss.clear()

        def out() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields)], names=[n for n, _ in fields])
            rows.clear()
            return b

        for b in batches:
            conv, piece, turn, role = (b.column(k).to_pylist() for k in range(4))
            for c, p, t, r, x in zip(conv, piece, turn, role, enc.encode(b.column(4).cast(pa.binary()).to_pylist())):
                if key is None or key[:2] != (c, p):
                    close()
                    key = (c, p, t)
                ids.append(np.append(x, np.uint32(end_id)))
                loss.append(np.full(len(x) + 1, r in learned))
            if len(rows) > 10_000:
                yield out()
        close()
        for s in packer.finish():
            note(s)
        if rows:
            yield out()

    turn = F.coalesce(df["turn"].cast("long"), F.lit(0))
    turns = df.select(df["conv_id"].cast("long").alias("conv_id"), F.floor(turn / TURNS).alias("piece"), turn.alias("turn"), df["role"].alias("role"), text_of(df).alias("text"))
    dealt = turns.repartition("conv_id", "piece").sortWithinPartitions("conv_id", "piece", "turn", "role", "text")
    return dealt.mapInArrow(run, ", ".join(f"{n} long" for n, _ in fields))


def op8_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens over the whole ``documents`` table."""
    return pack_documents(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"))
