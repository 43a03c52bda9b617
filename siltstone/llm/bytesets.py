"""Texts of an Arrow batch as one byte buffer, cut into words or pieces with numpy.

All text operators work on UTF-8 bytes: their separators are ASCII, so bytes and
characters cut at the same places. ``END`` closes every text; it never occurs in
UTF-8. A word's key takes its bytes eight at a time; up to eight they are told apart
exactly, and words of one key cannot be made from its arithmetic as with a polynomial.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

END = 0xFF
#: Texts of one batch are handled in blocks of about so many bytes.
BLOCK = 1 << 20

#: Spans of more bytes are hashed one by one.
CHAIN = 128

_ODD = np.uint64(0x9E3779B97F4A7C15)
_SECOND = np.uint64(0xD6E8FEB86659FD93)
_U = np.uint64
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Separator tables: True where a byte belongs to no word.
SPACED = np.zeros(256, bool)
SPACED[[0x20, *range(0x09, 0x0E), END]] = True
ALNUM = np.ones(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0xFF)]] = False


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash; every output bit depends on every input bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _eight(padded: np.ndarray, at: np.ndarray, held: np.ndarray) -> np.ndarray:
    """The ``held`` bytes from each place on, at most eight, as one number."""
    every = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    return every[at] & _MASK[np.minimum(held, 8)]


def span_keys(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of each span's bytes, the same wherever it stands.

    A span longer than eight bytes goes through two chains that mix every eight bytes in
    by different arithmetic; beyond ``CHAIN`` bytes it is hashed by BLAKE2.
    """
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    held = stop - start
    first = _eight(padded, start, held)
    keys = mixed(first ^ held.astype(np.uint64) * _ODD)
    far = np.flatnonzero(held > CHAIN)
    raw = memoryview(padded)
    for i, a, b in zip(far.tolist(), start[far].tolist(), stop[far].tolist()):
        keys[i] = int.from_bytes(blake2b(raw[a:b], digest_size=8).digest(), "little")
    todo = np.flatnonzero((held > 8) & (held <= CHAIN))
    one, two = keys[todo], mixed(first[todo] * _SECOND + _ODD)
    at, left = start[todo] + 8, held[todo] - 8
    while len(todo):
        block = _eight(padded, at, left)
        one, two = mixed(one ^ block), mixed(two + block * _SECOND)
        done = left <= 8
        keys[todo[done]] = mixed(one[done] ^ (two[done] << _U(32) | two[done] >> _U(32)))
        todo, one, two, at, left = (x[~done] for x in (todo, one, two, at + 8, left - 8))
    return keys


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 of each text; null is the empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def blocks(texts: list[bytes], size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Index ranges of about ``size`` bytes; a longer text stands alone, whole."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > size:
            yield first, i
            first, held = i, 0
        held += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer of all texts, each closed by END, and where each begins."""
    data = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return data, np.concatenate(([0], np.cumsum(lengths)))


class Words:
    """Lower-cased words of a block of texts.

    ``start, stop`` are byte spans in ``data``, ``first`` has the index of each
    text's first word (one more entry than texts), ``keys`` the words' hashes.
    """

    def __init__(self, texts: list[bytes], separators: np.ndarray = SPACED):
        raw, self.begin = joined(texts)
        self.data = LOWER[raw]
        apart = separators[raw]
        edge = np.flatnonzero(apart[1:] != apart[:-1]) + 1
        if len(raw) and not apart[0]:
            edge = np.concatenate(([0], edge))
        self.start, self.stop = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.start, self.begin)
        self.keys = span_keys(self.data, self.start, self.stop)

    def __len__(self) -> int:
        return len(self.start)

    def of(self) -> np.ndarray:
        """Index of the text that each word stands in."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def ragged(values: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The runs ``values[begin : begin + length]``, one after another."""
    total = int(length.sum())
    if not total:
        return values[:0]
    ends = np.cumsum(length)
    index = np.arange(total) + np.repeat(begin - (ends - length), length)
    return values[index]
