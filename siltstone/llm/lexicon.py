"""Words of many texts as byte spans, keyed hashes of them, and exact lookup in a list.

A key is made of a word's 8-byte blocks, each mixed into the last, from a seed that the
caller draws for each run: equal words have equal keys, and no text can be written so
that different words meet. ``Lexicon`` compares the words themselves as well.
"""

from __future__ import annotations

import secrets
from typing import NamedTuple

import numpy as np

from siltstone.llm.bytesets import LOWER, joined, mixed

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
#: Keeps the first 0 to 8 bytes of a little-endian block.
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def new_seed() -> int:
    """A seed nobody knows beforehand; results never depend on it."""
    return secrets.randbits(63)


class Cut(NamedTuple):
    """Lower-cased words of texts: byte spans in ``data``; ``first`` parts the texts."""

    data: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    first: np.ndarray

    def of(self) -> np.ndarray:
        """Index of the text that each word stands in."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.stop[i]].tobytes()


def cut_words(texts: list[bytes], separators: np.ndarray) -> Cut:
    """Maximal runs of bytes that ``separators`` does not mark; only A-Z are lower-cased."""
    return cut_joined(*joined(texts), separators)


def cut_joined(raw: np.ndarray, begin: np.ndarray, separators: np.ndarray) -> Cut:
    """``cut_words`` of texts in one buffer, each closed by END, and where each begins."""
    apart = separators[raw]
    edge = np.flatnonzero(apart[1:] != apart[:-1]) + 1
    if len(raw) and not apart[0]:
        edge = np.concatenate(([0], edge))
    start, stop = edge[0::2], edge[1::2]
    return Cut(LOWER[raw], start, stop, np.searchsorted(start, begin))


def _wide(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on, as one number each."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def span_blocks(data: np.ndarray, start: np.ndarray, stop: np.ndarray):
    """Block after block: the spans that are so long, and their next eight bytes (zeros after)."""
    wide, size = _wide(data), stop - start
    at, live = 0, np.flatnonzero(size > 0)
    while len(live):
        block = wide[start[live] + at] & _KEEP[np.minimum(size[live] - at, 8)]
        yield live, block
        at += 8
        live = live[size[live] > at]


def keys_of(data: np.ndarray, start: np.ndarray, stop: np.ndarray, seed: int) -> np.ndarray:
    """Hash of each span's bytes under ``seed``."""
    key = mixed((stop - start).astype(np.uint64) * _ODD + _U(seed))
    for live, block in span_blocks(data, start, stop):
        key[live] = mixed(key[live] ^ block) + _ODD
    return key


def chained(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Key of a sequence from the key of all but its last part and that of the last."""
    return mixed(left * _ODD + right)


class Lexicon:
    """Numbers of the words of a list, found by key and then compared byte by byte."""

    def __init__(self, words: list[bytes]):
        length = np.fromiter(map(len, words), np.int64, len(words))
        stop = np.cumsum(length)
        self._build(np.frombuffer(b"".join(words), np.uint8), stop - length, stop)

    @classmethod
    def of_spans(cls, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> Lexicon:
        """A list of distinct words given as byte spans."""
        new = cls.__new__(cls)
        new._build(data, start, stop)
        return new

    def _build(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> None:
        self.size, length = len(start), stop - start
        while True:  # a seed under which no two words share a key
            self.seed = new_seed()
            keys = keys_of(data, start, stop, self.seed)
            order = np.argsort(keys, kind="stable")
            if not (keys[order][1:] == keys[order][:-1]).any():
                break
        self.keys, self.number = keys[order], order.astype(np.int32)
        self.length = length.astype(np.int32)
        self.begin = np.concatenate(([0], np.cumsum(-(-length // 8)))).astype(np.int64)
        self.blocks = np.zeros(self.begin[-1], np.uint64)
        for nth, (live, block) in enumerate(span_blocks(data, start, stop)):
            self.blocks[self.begin[live] + nth] = block
        # most words of a text may be in no list: one bit table answers for them at once
        self.bits = max(16, int(16 * max(self.size, 1)).bit_length())
        self.maybe = np.zeros(1 << self.bits, bool)
        self.maybe[(keys >> _U(64 - self.bits)).astype(np.int64)] = True

    def find(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The number of each span's word, -1 where the list lacks it."""
        out = np.full(len(start), -1, np.int32)
        if not self.size or not len(start):
            return out
        keys = keys_of(data, start, stop, self.seed)
        asked = np.flatnonzero(self.maybe[(keys >> _U(64 - self.bits)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, keys[asked]), self.size - 1)
        hit = self.keys[at] == keys[asked]
        asked, number = asked[hit], self.number[at[hit]]
        same = self.length[number] == (stop - start)[asked]
        asked, number = asked[same], number[same]
        same = np.ones(len(asked), bool)
        for nth, (live, block) in enumerate(span_blocks(data, start[asked], stop[asked])):
            same[live] &= self.blocks[self.begin[number[live]] + nth] == block
        out[asked[same]] = number[same]
        return out


def numbered(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One span of each distinct word, and for every span which of them it equals."""
    while True:  # a seed under which no two words share a key
        keys = keys_of(data, start, stop, new_seed())
        _, where, which = np.unique(keys, return_index=True, return_inverse=True)
        twin = where[which]
        same = bool((stop[twin] - start[twin] == stop - start).all())
        if same:
            wide = _wide(data)
            for at in range(0, int((stop - start).max(initial=0)), 8):
                live = np.flatnonzero(stop - start > at)
                keep = _KEEP[np.minimum((stop - start)[live] - at, 8)]
                same = same and not ((wide[start[live] + at] ^ wide[start[twin[live]] + at]) & keep).any()
        if same:
            return where, which
