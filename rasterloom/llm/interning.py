"""Numbers for words, a whole slice of text at a time.

The words of a slice are contiguous segments of one byte array. All are hashed eight
bytes at a time, what is beyond ``SHORT`` bytes by prefix sums, and looked up in an
open-addressing table by array operations. A match is compared in full, so a number
always stands for one exact word.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
MIX = np.uint64(0xD6E8FEB86659FD93)
#: Bytes of a word that are taken eight at a time; a multiple of 8.
SHORT = 64
#: The first bytes of eight, by how many there are.
MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


class Interner:
    """Give each distinct word the next number; ``reset`` forgets all."""

    def __init__(self) -> None:
        self.powers, self.inverses = np.ones(1, np.uint64), np.ones(1, np.uint64)
        self.reset()

    def reset(self) -> None:
        self.size = 0
        self.keys, self.vals = np.zeros(1 << 12, np.uint64), np.zeros(1 << 12, np.int32)
        self.begins, self.lens = np.zeros(1 << 10, np.int64), np.zeros(1 << 10, np.int32)
        self.store, self.used = np.zeros(1 << 13, np.uint8), 0

    @property
    def nbytes(self) -> int:
        return sum(x.nbytes for x in (self.keys, self.vals, self.begins, self.lens, self.store))

    def _grow_powers(self, n: int) -> None:
        if n > len(self.powers):
            n = max(n, 1 << 20)
            self.powers = np.concatenate(([np.uint64(1)], np.full(n - 1, BASE))).cumprod(dtype=np.uint64)
            self.inverses = np.concatenate(([np.uint64(1)], np.full(n - 1, BASE_INVERSE))).cumprod(dtype=np.uint64)

    def _hash(self, data: np.ndarray, begins: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Of segments of an array that ends with eight spare bytes."""
        eight = windows(data)
        h = mixed((eight[begins] & MASKS[np.minimum(lens, 8)]) ^ (lens.astype(np.uint64) * BASE))
        more, k = np.flatnonzero(lens > 8), 8
        while len(more) and k < SHORT:
            rest = lens[more] - k
            h[more] = mixed(h[more] ^ (eight[begins[more] + k] & MASKS[np.minimum(rest, 8)]))
            more, k = more.compress(rest > 8), k + 8
        if len(more):
            h[more] = mixed(h[more] ^ self._sums(data, begins[more] + k, lens[more] - k))
        return np.where(h == 0, np.uint64(1), h)

    def _sums(self, data: np.ndarray, begins: np.ndarray, lens: np.ndarray) -> np.ndarray:
        ends = np.cumsum(lens)
        self._grow_powers(int(ends[-1]) + 1)
        sums = np.zeros(int(ends[-1]) + 1, np.uint64)
        np.cumsum((data[segment_places(begins, lens)].astype(np.uint64) + np.uint64(1)) * self.powers[: len(sums) - 1], out=sums[1:])
        return (sums[ends] - sums[ends - lens]) * self.inverses[ends - lens]

    def _find(self, h: np.ndarray) -> np.ndarray:
        mask = np.uint64(len(self.keys) - 1)
        at = (h & mask).astype(np.int64)
        k = self.keys[at]
        hit = k == h
        out = np.where(hit, self.vals[at], np.int64(-1))
        todo = np.flatnonzero(~hit & (k != 0))
        step = 1
        while len(todo):
            at = (h[todo] + np.uint64(step) & mask).astype(np.int64)
            k = self.keys[at]
            hit = k == h[todo]
            out[todo[hit]] = self.vals[at[hit]]
            todo = todo[~hit & (k != 0)]
            step += 1
        return out

    def _place(self, h: np.ndarray, vals: np.ndarray) -> None:
        mask, step, todo = np.uint64(len(self.keys) - 1), 0, np.arange(len(h))
        while len(todo):
            at = (h[todo] + np.uint64(step) & mask).astype(np.int64)
            free = np.nonzero(self.keys[at] == 0)[0]
            _, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.keys[at[won]], self.vals[at[won]] = h[todo[won]], vals[todo[won]]
            todo = np.delete(todo, won)
            step += 1

    def _add(self, packed: np.ndarray, lens: np.ndarray, h: np.ndarray) -> None:
        """New words with hashes that the table doesn't have."""
        n, size = self.size, self.size + len(lens)
        while size > len(self.begins):
            self.begins, self.lens = (np.concatenate([x, x]) for x in (self.begins, self.lens))
        while self.used + len(packed) + 8 > len(self.store):
            self.store = np.concatenate([self.store, self.store])
        self.store[self.used : self.used + len(packed)] = packed
        self.begins[n:size], self.lens[n:size] = self.used + np.cumsum(lens) - lens, lens
        self.used, self.size = self.used + len(packed), size
        if 2 * size > len(self.keys):
            room = len(self.keys)
            while 2 * size > room:
                room *= 2
            old = np.nonzero(self.keys)[0]
            keys, vals = self.keys[old], self.vals[old]
            self.keys, self.vals = np.zeros(room, np.uint64), np.zeros(room, np.int32)
            self._place(keys, vals)
        self._place(h, np.arange(n, size, dtype=np.int32))

    def numbers(self, raw: bytes, starts: np.ndarray, learn: Callable[[tuple[np.ndarray, np.ndarray]], None] | None) -> np.ndarray:
        """The number of each segment of ``raw``; segments begin at ``starts`` (ascending, the first 0) and are not empty.

        New words are numbered in the order in which they come, and passed to ``learn``
        as a pair: their bytes, packed, and their lengths. With None, new words get -1. A word
        whose hash belongs to another word gets ``-2``.
        """
        data = np.frombuffer(raw + bytes(8), np.uint8)
        lens = np.append(starts[1:], len(raw)) - starts
        h = self._hash(data, starts, lens)
        out = self._find(h)
        known = np.flatnonzero(out >= 0)
        found, its, sizes = out[known], starts[known], lens[known]
        # A match must have the same length and the same bytes.
        same = self.lens[found] == sizes
        if not same.all():
            out[known.compress(~same)] = -2
            known, found, its, sizes = (x.compress(same) for x in (known, found, its, sizes))
        out[known.compress(~equal_words(self.store, self.begins[found], data, its, sizes))] = -2
        new = np.nonzero(out == -1)[0]
        if len(new) and learn:
            _, first, word = np.unique(h[new], return_index=True, return_inverse=True)
            order = np.argsort(first)
            number = np.empty(len(first), np.int64)
            number[order] = np.arange(len(first))
            mine, its = new, new[first[word]]
            same = lens[mine] == lens[its]
            same[same] = equal_words(data, starts[its[same]], data, starts[mine[same]], lens[mine[same]])
            out[new] = np.where(same, self.size + number[word], -2)
            fresh = new[first[order]]
            packed, sizes = data[segment_places(starts[fresh], lens[fresh])], lens[fresh]
            self._add(packed, sizes, h[fresh])
            learn((packed, sizes))
        return out


def segment_places(begins: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The places of all bytes of some segments."""
    first = np.cumsum(lens) - lens
    return np.repeat(begins - first, lens) + np.arange(int(lens.sum()))


def windows(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one integer, without a copy; the last seven places have none."""
    return np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits, each of which it spreads over all."""
    h ^= h >> np.uint64(31)
    h *= MIX
    h ^= h >> np.uint64(29)
    h *= BASE
    h ^= h >> np.uint64(32)
    return h


def equal_words(a: np.ndarray, a_begins: np.ndarray, b: np.ndarray, b_begins: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """``equal_segments`` of arrays that end with eight spare bytes."""
    left, right = windows(a), windows(b)
    out = (left[a_begins] ^ right[b_begins]) & MASKS[np.minimum(lens, 8)] == 0
    more, k = np.flatnonzero(lens > 8), 8
    while len(more) and k < SHORT:
        rest = lens[more] - k
        out[more] &= (left[a_begins[more] + k] ^ right[b_begins[more] + k]) & MASKS[np.minimum(rest, 8)] == 0
        more, k = more.compress(rest > 8), k + 8
    if len(more):
        out[more] &= equal_segments(a, a_begins[more] + k, b, b_begins[more] + k, lens[more] - k)
    return out


def equal_segments(a: np.ndarray, a_begins: np.ndarray, b: np.ndarray, b_begins: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Whether segments of two byte arrays, pairwise of equal lengths, hold the same bytes."""
    out = np.ones(len(lens), bool)
    differ = np.nonzero(a[segment_places(a_begins, lens)] != b[segment_places(b_begins, lens)])[0]
    if len(differ):
        out[np.searchsorted(np.cumsum(lens), differ, "right")] = False
    return out


def split_words(packed: np.ndarray, lens: np.ndarray) -> list[bytes]:
    """The words that ``learn`` is given, as bytes."""
    raw, ends = packed.tobytes(), np.cumsum(lens)
    return [raw[b:e] for b, e in zip((ends - lens).tolist(), ends.tolist())]
