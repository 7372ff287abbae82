"""Exact tokenizer output at corpus speed.

Both vocabularies split a text at white space, and between letters and marks, before
any merge, so equal words get equal ids wherever they stand. Each worker keeps the ids
of the words that it has met, as the tokenizers library gave them, and sends only new
words to the library. Texts whose white space the splitter below doesn't cover go to
the library whole.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain

import numpy as np

from rasterloom.llm.interning import Interner, segment_places, split_words

#: Words, and bytes of all that is known of them, kept by a worker unless told otherwise; beyond either it starts anew.
KEPT_WORDS, KEPT_BYTES = 1_000_000, 128 << 20
#: Bytes of text that are split at a time.
SLICE = 1 << 20
#: White space whose splitting depends on more than the next character.
WIDE_SPACE = re.compile(rb"[\t\r\x0b\x0c\x1c-\x1f]|  | \n|\n |\n\n\n|\n\n\Z|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe1\xa0\x8e|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
#: Bytes of which ``WIDE_SPACE`` always holds one (1), two next to each other (2), or one with another one after it (4).
HINT = np.zeros(256, np.uint8)
HINT[list(b"\t\r\x0b\x0c\x1c\x1d\x1e\x1f")], HINT[list(b" \n")], HINT[[0xC2, 0xE1, 0xE2, 0xE3]] = 1, 2, 4
AFTER = np.zeros(256, bool)
AFTER[[0x80, 0x81, 0x85, 0x9A, 0xA0]] = True
#: What both vocabularies show for each byte: printable Latin-1 as it is, the others from U+0100 on in order.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_OTHERS = [b for b in range(256) if b not in _PRINTED]
SHOWN = np.arange(256, dtype="<u4")
SHOWN[_OTHERS] = 0x100 + np.arange(len(_OTHERS))
#: Classes of bytes: ASCII letters 1, marks that may follow one 2, ASCII white space 4.
CLASS = np.zeros(256, np.uint8)
CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
CLASS[list(b",.!?*%$#&;:")] = 2
CLASS[list(b" \t\n\r\x0b\x0c")] = 4
_CLASSES, _HINTS = CLASS.tobytes(), HINT.tobytes()
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ENCODERS: dict[tuple, Encoder] = {}


class Encoder:
    """Ids by the tokenizers library, ``add_special_tokens=False``; strings of special tokens are ordinary text, and bytes that are not UTF-8 count as U+FFFD.

    ``byte_level``: words keep the space before them, line feeds stand alone.
    ``words``: white space is dropped and case ignored, so neither matters.
    """

    def __init__(self, vocabulary: str, kind: str, kept: int | None = None) -> None:
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(vocabulary)
        self.tok.encode_special_tokens = True
        # The same merges for words that are split and normalised already, without the steps around them.
        self.lower = {"byte_level": False, "words": True}[kind]
        self.letters = Tokenizer.from_str(vocabulary).model
        if hasattr(self.letters, "_resize_cache"):
            self.letters._resize_cache(0)  # only new words come here
        self.words, self.kept = Interner(), kept or KEPT_WORDS
        self.reset()

    def reset(self) -> None:
        self.words.reset()
        self.count, self.used = 0, 0
        self.starts, self.lens, self.flat = np.zeros(1024, np.int64), np.zeros(1024, np.int32), np.zeros(4096, np.uint32)

    def whole(self, text: bytes) -> np.ndarray:
        return np.array(self.tok.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, np.uint32)

    def learn(self, new: tuple[np.ndarray, np.ndarray]) -> None:
        """Encode new words: those of letters by the model alone, others by the whole tokenizer."""
        packed, lens = new
        ends = np.cumsum(lens)
        plain = letters_only(packed, ends - lens)
        n, size = self.count, self.count + len(lens)
        while size > len(self.starts):
            self.starts, self.lens = np.concatenate([self.starts, self.starts]), np.concatenate([self.lens, self.lens])
        odd = np.nonzero(~plain)[0]
        if len(odd):
            words = split_words(packed[segment_places((ends - lens)[odd], lens[odd])], lens[odd])
            ids = [e.ids for e in self.tok.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)]
            self._keep(n + odd, np.fromiter(chain.from_iterable(ids), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids)))
        even = np.nonzero(plain)[0]
        if len(even):
            word = np.repeat(np.arange(len(even)), lens[even])
            of = packed[segment_places((ends - lens)[even], lens[even])]
            if self.lower:
                word, of = word[of != 32], of[of != 32]
            # "!" stands between the words, which no word of letters holds.
            marked = np.full(len(of) + len(even), 33, np.uint8)
            marked[np.arange(len(of)) + word] = of
            if self.lower:
                marked = np.frombuffer(marked.tobytes().decode().lower().encode(), np.uint8)
            got = list(map(self.letters.tokenize, SHOWN[marked].tobytes().decode("utf-32-le").split("!")[:-1]))
            self._keep(n + even, np.array([t.id for word in got for t in word], np.uint32), np.array(list(map(len, got)), np.int64))
        self.count = size

    def _keep(self, numbers: np.ndarray, ids: np.ndarray, lens: np.ndarray) -> None:
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, self.flat])
        self.flat[self.used : self.used + len(ids)] = ids
        self.starts[numbers], self.lens[numbers] = self.used + np.cumsum(lens) - lens, lens
        self.used += len(ids)

    def slice(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of texts that are not empty and have no wide white space."""
        if self.count > self.kept or self.words.nbytes + self.starts.nbytes + self.lens.nbytes + self.flat.nbytes > KEPT_BYTES:
            self.reset()
        raw = b"".join(texts)
        if self.lower and b"\xcc" not in raw and b"\xcd" not in raw:
            raw = raw.translate(_LOWER)
        data, sizes = np.frombuffer(raw, np.uint8), np.fromiter(map(len, texts), np.int64, len(texts))
        kind = np.frombuffer(raw.translate(_CLASSES), np.uint8)
        begins = kind == 4
        begins[1:] |= (data[:-1] == 10) | ((kind[:-1] == 1) & (kind[1:] == 2))
        text_ends = np.cumsum(sizes)
        begins[text_ends - sizes] = True
        starts = np.nonzero(begins)[0]
        at = self.words.numbers(raw, starts, self.learn)
        clash = np.nonzero(at < 0)[0]
        if len(clash):
            # Words that share a hash with others: without numbers of their own, their texts go to the library whole.
            hit = set(np.searchsorted(text_ends, starts[clash], "right").tolist())
            keep = [i for i in range(len(texts)) if i not in hit]
            rest = iter(self.slice([texts[i] for i in keep]) if keep else [])
            return [self.whole(t) if i in hit else next(rest) for i, t in enumerate(texts)]
        lens = self.lens[at]
        ends = np.cumsum(lens)
        ids = self.flat[np.repeat(self.starts[at] - (ends - lens), lens) + np.arange(ends[-1])]
        cuts = ends[np.searchsorted(starts, text_ends) - 1]
        bounds = [0, *cuts.tolist()]
        return [ids[a:b] for a, b in zip(bounds, bounds[1:])]

    def encode(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """The ids of each text; null counts as empty."""
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        todo, size = [], 0

        def run() -> None:
            if not self.lower and maybe_wide(b"a".join(texts[i] for i in todo)):
                for i in [i for i in todo if WIDE_SPACE.search(texts[i])]:
                    out[i] = self.whole(texts[i])
                    todo.remove(i)
            if todo:
                for i, ids in zip(todo, self.slice([texts[i] for i in todo])):
                    out[i] = ids

        for i, t in enumerate(texts):
            if t:
                todo.append(i)
                size += len(t)
                if size > SLICE:
                    run()
                    todo, size = [], 0
        if todo:
            run()
        return out


def maybe_wide(raw: bytes) -> bool:
    """False only where ``WIDE_SPACE`` matches nowhere."""
    data = np.frombuffer(raw, np.uint8)
    hint = np.frombuffer(raw.translate(_HINTS), np.uint8)
    if (hint == 1).any() or ((hint[1:] == 2) & (hint[:-1] == 2)).any():
        return True
    lead = np.nonzero(hint == 4)[0]
    return bool(AFTER[data[np.minimum(lead + 1, len(data) - 1)]].any())


def letters_only(packed: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which words hold Latin letters alone, up to U+017F, after one space at most.

    Both splitters leave such words whole, and no normalisation but lower case changes
    them. Not letters are the signs of multiplication and division; the capital I with
    a dot changes its length in lower case.
    """
    after = np.append(packed[1:], np.uint8(0))
    pair = ((packed == 0xC3) & (after != 0x97) & (after != 0xB7)) | ((packed == 0xC4) & (after != 0xB0)) | (packed == 0xC5)
    pair &= (after & 0xC0) == 0x80
    good = (CLASS[packed] == 1) | pair
    good[1:] |= pair[:-1]
    space = starts[packed[starts] == 32]
    space = space[np.append(starts[1:], len(packed))[np.searchsorted(starts, space)] > space + 1]
    good[space] = True
    return np.logical_and.reduceat(good, starts)


def encoder(vocabulary: str, kind: str, kept: int | None = None) -> Encoder:
    """This worker's encoder for a vocabulary file's content."""
    key = (hashlib.sha256(vocabulary.encode()).digest(), kind, kept)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(vocabulary, kind, kept)
    return _ENCODERS[key]


def vocabulary(name: str) -> str:
    """The content of a public vocabulary file, to be sent to the workers."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()
