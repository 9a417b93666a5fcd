"""Token ids of whole texts: distinct pieces of text are encoded once, by the tokenizers library.

A text is cut before a single space, around a single line break, and before ``. , ; : ! ?`` that
follow an ASCII letter, always between characters that are not white space. Neither of the two
vocabularies has a token across such a cut and neither normaliser looks across it, so the ids of
the whole text are the ids of its pieces in order. Pieces repeat a lot, so each worker keeps the
ids of up to ``CACHE`` distinct pieces (then starts afresh) and looks them up by a 64-bit hash. Pieces of
equal hashes count as equal: among ``CACHE`` pieces two share one by chance with a probability of about 1e-7.

Words of basic and Latin-1 letters (a combining mark behind them excludes them) skip the normaliser and the
pre-tokenizer, which leave them as they are: they go straight to the library's model.

For a vocabulary whose normaliser drops white space and case (``fold``), pieces that differ in a leading
space or in ASCII case are the same piece; a letter before a combining mark is left alone, as composition comes first.
"""

from __future__ import annotations

import json
import os
from itertools import chain

import numpy as np

from uttera.llm import bytesops as B

CACHE = 2_000_000
END = 1
_MARKS = B.lut(b".,;:!?")
_LETTER = B.lut([*range(65, 91), *range(97, 123)])
_PLAIN = ~B.lut(range(0x21))  # anything but controls and space
_LEADS = B.lut([0xE1, 0xE2, 0xE3])  # of three-byte characters that may be white space
#: Bytes of words of basic and Latin-1 letters: one pre-token each, which no normaliser changes.
_WORD = B.lut([*range(65, 91), *range(97, 123), 0xC3, *(b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7))])
_FOLDED_WORD = B.lut([*range(97, 123), 0xC3, *(b for b in range(0x9F, 0xC0) if b != 0xB7)])


def byte_level() -> dict[int, int]:
    """Characters that stand for bytes in byte-level vocabularies: printable Latin-1 as it is, the rest from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {**{b: b for b in own}, **{b: 256 + k for k, b in enumerate(rest)}}


_BYTE_LEVEL = byte_level()
_loaded: dict[tuple[str, bool], Encoder] = {}


def cuts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Positions at which pieces begin."""
    n = len(data)
    begin = np.zeros(n + 1, bool)
    if n > 2:
        plain = _PLAIN[data]
        after = plain & (data != 0xC2) & ~_LEADS[data]  # surely no white space begins here
        before = plain.copy()  # surely none ends here
        high = data >= 0x80
        before[1:] &= ~(high[1:] & (data[:-1] == 0xC2))
        before[2:] &= ~(high[2:] & _LEADS[data[:-2]])
        gap = (data[1:-1] == 0x20) & before[:-2] & after[2:]
        feed = (data[1:-1] == 0x0A) & before[:-2] & after[2:]
        begin[1 : n - 1] = gap | feed
        begin[2:n] |= feed
        begin[1:n] |= _MARKS[data[1:]] & _LETTER[data[:-1]]
    begin[off] = True  # a text's edge; what the neighbouring text suggested there does not matter
    return np.flatnonzero(begin[:n])


class Numbers:
    """Numbers from 0 of distinct 64-bit hashes, in the order of being added: an open hash table, asked a column at a time."""

    def __init__(self, bits: int = 16):
        self.hashes, self.numbers, self.used = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32), 0

    def __len__(self) -> int:
        return self.used

    def _home(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - (len(self.hashes).bit_length() - 1))).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 for those that were not added."""
        out, at, todo = np.full(len(h), -1, np.int64), self._home(h), np.arange(len(h))
        while len(todo):
            number = self.numbers[at[todo]]
            same = (number >= 0) & (self.hashes[at[todo]] == h[todo])
            out[todo[same]] = number[same]
            todo = todo[(number >= 0) & ~same]
            at[todo] = (at[todo] + 1) & (len(self.hashes) - 1)
        return out

    def _put(self, h: np.ndarray, numbers: np.ndarray) -> None:
        at, todo = self._home(h), np.arange(len(h))
        while len(todo):
            free = self.numbers[at[todo]] < 0
            some = todo[free]
            self.numbers[at[some]] = numbers[some]  # of several at one place one stays
            won = self.numbers[at[some]] == numbers[some]
            self.hashes[at[some[won]]] = h[some[won]]
            todo = np.concatenate([todo[~free], some[~won]])
            at[todo] = (at[todo] + 1) & (len(self.hashes) - 1)

    def add(self, h: np.ndarray) -> np.ndarray:
        """New numbers of distinct hashes that were not found."""
        new = np.arange(self.used, self.used + len(h))
        if 2 * (self.used + len(h)) > len(self.hashes):
            old = np.flatnonzero(self.numbers >= 0)
            hashes, numbers = self.hashes[old], self.numbers[old]
            bits = int(2 * (self.used + len(h))).bit_length() + 1
            self.hashes, self.numbers = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
            self._put(hashes, numbers)
        self._put(h, new.astype(np.int32))
        self.used += len(h)
        return new


class Encoder:
    def __init__(self, path: str, fold: bool = False):
        self.fold = fold
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        with open(path) as file:
            parts = json.load(file)
        parts.update(normalizer=None, pre_tokenizer=None, post_processor=None, added_tokens=[])
        self.bare = Tokenizer.from_str(json.dumps(parts))  # the same model over byte-level characters
        self.word = _FOLDED_WORD if fold else _WORD
        self._reset()

    @classmethod
    def of(cls, path: str, fold: bool = False) -> Encoder:
        """The worker's encoder of a vocabulary file."""
        if (path, fold) not in _loaded:
            _loaded[path, fold] = cls(path, fold)
        return _loaded[path, fold]

    def _reset(self) -> None:
        self.known = Numbers()
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.at, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)

    def _learn(self, tokenizer, pieces: list[str]) -> None:
        for a in range(0, len(pieces), 20_000):
            ids = [e.ids for e in tokenizer.encode_batch_fast(pieces[a : a + 20_000], add_special_tokens=False)]
            size = np.fromiter(map(len, ids), np.int32, len(ids))
            total, k = int(size.sum()), self.count
            while k + len(ids) > len(self.at):
                self.at, self.size = np.resize(self.at, 2 * len(self.at)), np.resize(self.size, 2 * len(self.size))
            while self.used + total > len(self.flat):
                self.flat = np.resize(self.flat, 2 * len(self.flat))
            self.flat[self.used : self.used + total] = np.fromiter(chain.from_iterable(ids), np.uint32, total)
            self.size[k : k + len(ids)] = size
            self.at[k : k + len(ids)] = self.used + np.cumsum(size, dtype=np.int64) - size
            self.used += total
            self.count += len(ids)

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a block's texts in order, and their len+1 bounds."""
        starts = cuts(data, off)
        ends = np.append(starts[1:], len(data))[: len(starts)]
        first_piece = np.searchsorted(starts, off)
        if self.fold and len(data):
            capital = (data >= 65) & (data <= 90)
            capital[:-1] &= (data[1:] != 0xCC) & (data[1:] != 0xCD)
            data = np.where(capital, data + np.uint8(32), data)
            starts = starts + ((data[starts] == 0x20) & (ends > starts + 1))
        h = B.range_hash(B.prefix_hash(data), starts, ends)
        order = np.argsort(h)
        new = np.concatenate([[True], h[order[1:]] != h[order[:-1]]])[: len(h)]
        first = order[new]
        which = np.empty(len(h), np.int64)
        which[order] = np.cumsum(new) - 1
        if len(self.known) + len(first) > CACHE:
            self._reset()
        number = self.known.find(h[first])
        missing = first[number < 0]
        if len(missing):
            raw = data.tobytes()
            self.count = len(self.known)
            odd = np.concatenate([[0], np.cumsum(~self.word[data])])
            begin = starts[missing] + (data[starts[missing]] == 0x20) * (not self.fold)
            simple = (odd[ends[missing]] == odd[begin]) & (ends[missing] > begin)
            missing = np.concatenate([missing[simple], missing[~simple]])
            texts = [raw[x:y] for x, y in zip(starts[missing].tolist(), ends[missing].tolist(), strict=True)]
            n = int(simple.sum())
            self._learn(self.bare, [x.decode("latin-1").translate(_BYTE_LEVEL) for x in texts[:n]])
            self._learn(self.tokenizer, [x.decode("utf-8", "replace") for x in texts[n:]])
            self.known.add(h[missing])
            number = self.known.find(h[first])
        slot = number[which] if len(first) else np.zeros(0, np.int64)
        size = self.size[slot]
        total = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.repeat(self.at[slot] - total[:-1], size) + np.arange(total[-1])]
        return ids, total[first_piece]


def with_end(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same with the id ``END`` after each text."""
    n = len(bounds) - 1
    out = np.full(len(ids) + n, END, np.uint32)
    keep = np.ones(len(out), bool)
    keep[bounds[1:] + np.arange(n)] = False
    out[keep] = ids
    return out, bounds + np.arange(n + 1)
