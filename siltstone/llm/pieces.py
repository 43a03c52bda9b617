"""Token ids of whole texts by the tokenizers library, each distinct piece encoded once.

Both vocabularies cut a text by a pattern and merge bytes within a piece only, so
the ids of a text are those of its pieces in order. ``Encoder`` finds the pieces of
many texts with numpy, asks the library for the pieces it has not met, and keeps
them in a table of fixed size. A text that the byte rules do not cover (a character
above U+023F, or a special token's opening mark) goes to the library as a whole.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np

from siltstone.llm.bytesets import END, LOWER, blocks, joined, ragged, span_keys

_SPACE, _LETTER, _DIGIT, _OTHER, _END = range(5)
#: Lead bytes from here on begin characters above U+023F.
_FOREIGN = 0xC9
#: Texts with these byte pairs go to the library whole: the mark ``<|`` and U+0130,
#: whose lower case is two characters.
_WHOLE = ((0x3C, 0x7C), (0xC4, 0xB0))


def _kind(char: str) -> int:
    group = unicodedata.category(char)
    if char.isspace() and not 0x1C <= ord(char) <= 0x1F:
        return _SPACE
    return _LETTER if group[0] == "L" else _DIGIT if group[0] == "N" else _OTHER


_KIND = np.full(1 << 16, _OTHER, np.uint8)
for _code in range(0x80):
    _KIND[_code] = _kind(chr(_code))
for _code in range(0x80, 0x240):
    _lead, _tail = chr(_code).encode()
    _KIND[_lead << 8 | _tail] = _kind(chr(_code))
_KIND[END] = _END


def kinds(data: np.ndarray) -> np.ndarray:
    """Kind of each byte's character."""
    found = _KIND[data]
    lead = np.flatnonzero((data >= 0xC2) & (data != END))
    if len(lead):
        pair = _KIND[(data[lead].astype(np.uint16) << 8) | data[lead + 1]]
        found[lead] = pair
        found[lead + 1] = pair
    return found


def _contractions(data: np.ndarray, kind: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Begin and length of 's 't 'm 'd 're 've 'll where they are pieces."""
    at = np.flatnonzero(data == 0x27)
    if not len(at):
        return at, at
    before = np.where(at > 0, kind[at - 1], _END)
    held = (before == _OTHER) | ((at > 0) & (data[at - 1] == 0x20) & (not lower))
    at = at[~held]
    padded = np.concatenate((data, np.zeros(2, np.uint8)))
    one, two = padded[at + 1], padded[at + 2]
    single = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    double = ((one == 0x72) | (one == 0x76)) & (two == 0x65) | (one == 0x6C) & (two == 0x6C)
    length = np.where(single, 2, np.where(double, 3, 0))
    return at[length > 0], length[length > 0]


def cut(data: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Spans of the pieces of joined texts, in order; END marks are left out.

    ``lower`` is the pattern that drops white space and takes digits one by one;
    otherwise white space is kept and one blank joins the piece after it.
    """
    kind = kinds(data)
    edge = np.empty(len(data), bool)
    edge[0] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:])
    edge |= kind == _END
    if lower:
        edge |= (kind == _DIGIT) & ((data < 0x80) | (data >= 0xC2))
    at, length = _contractions(data, kind, lower)
    if len(at):
        edge[at + 1] = False
        edge[at + length] = True
    if not lower:
        space = kind == _SPACE
        # the last white-space character before something else stands for itself ...
        last = np.flatnonzero(space[:-1] & (kind[1:] != _SPACE) & (kind[1:] != _END))
        two = data[last] >= 0x80
        head = last - two
        edge[head] = True
        # ... and a blank takes along what follows
        blank = last[data[last] == 0x20]
        edge[blank + 1] = False
    start = np.flatnonzero(edge)
    stop = np.concatenate((start[1:], [len(data)]))
    kept = kind[start] != _END
    if lower:
        kept &= kind[start] != _SPACE
    return start[kept], stop[kept]


class Encoder:
    """Ids of texts by one vocabulary file; its table holds ``2 ** bits`` pieces."""

    def __init__(self, path: str, bits: int = 20):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.lower = self.library.normalizer is not None
        self.mark = "<|endoftext|>"
        self.mark_id = self.library.token_to_id(self.mark)
        self.size = 1 << bits
        self.key = np.zeros(self.size, np.uint64)
        self.held = np.zeros(self.size, bool)
        self.bytes = np.zeros(self.size, np.int32)
        self.begin = np.zeros(self.size, np.int64)
        self.count = np.zeros(self.size, np.int32)
        self.clear()

    def leads(self) -> np.ndarray:
        """Marks of the ids, up to the special token's, that begin with a blank."""
        names = (self.library.id_to_token(i) for i in range(self.mark_id + 1))
        return np.array([bool(n) and n.startswith("\u0120") for n in names])

    def clear(self) -> None:
        self.held[:] = False
        self.flat = np.empty(1 << 16, np.uint32)
        self.used = 0

    def learn(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces and how many each has: one text, kept apart by the special token."""
        whole = self.library.encode_batch_fast([self.mark.join(names)], add_special_tokens=False)
        ids = np.array(whole[0].ids, np.uint32)
        mark = ids == self.mark_id
        bounds = np.concatenate(([-1], np.flatnonzero(mark), [len(ids)]))
        return ids[~mark], np.diff(bounds) - 1

    def _store(self, keys: np.ndarray, start: np.ndarray, stop: np.ndarray, data: bytes) -> None:
        fresh, where = np.unique(keys, return_index=True)
        names = [data[a:b].decode() for a, b in zip(start[where].tolist(), stop[where].tolist())]
        flat, length = self.learn(names)
        if self.used + len(flat) > len(self.flat):
            grown = np.empty(max(2 * len(self.flat), self.used + len(flat)), np.uint32)
            grown[: self.used] = self.flat[: self.used]
            self.flat = grown
        self.flat[self.used : self.used + len(flat)] = flat
        slot = (fresh & np.uint64(self.size - 1)).astype(np.int64)
        self.key[slot], self.held[slot] = fresh, True
        self.bytes[slot] = (stop - start)[where]
        self.begin[slot] = self.used + np.cumsum(length) - length
        self.count[slot] = length
        self.used += len(flat)

    def lookup(self, keys, start, stop, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces in order, and how many each piece has."""
        if self.used > 8 * self.size:
            self.clear()
        slot = (keys & np.uint64(self.size - 1)).astype(np.int64)
        count = np.zeros(len(keys), np.int64)
        begin = np.zeros(len(keys), np.int64)
        todo = np.arange(len(keys))
        while len(todo):  # pieces that share a slot take turns
            own = slot[todo]
            hit = self.held[own] & (self.key[own] == keys[todo]) & (self.bytes[own] == (stop - start)[todo])
            got = todo[hit]
            count[got], begin[got] = self.count[own[hit]], self.begin[own[hit]]
            todo = todo[~hit]
            if len(todo):
                self._store(keys[todo], start[todo], stop[todo], data)
        return ragged(self.flat, begin, count), count

    @staticmethod
    def uncovered(data: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Indexes of the texts that the byte rules do not cover."""
        odd = [np.flatnonzero((data >= _FOREIGN) & (data != END))]
        for one, two in _WHOLE:
            at = np.flatnonzero(data == one)
            odd.append(at[data[np.minimum(at + 1, len(data) - 1)] == two])
        return np.unique(np.searchsorted(begin, np.concatenate(odd), side="right") - 1)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text, as the library gives them for the whole text."""
        out: list[np.ndarray] = [np.empty(0, np.uint32)] * len(texts)
        for a, b in blocks(texts):
            ids, ends = self._block(texts[a:b])
            out[a:b] = np.split(ids, ends[:-1])
        return out

    def _block(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        data, begin = joined(texts)
        whole = self.uncovered(data, begin)
        if len(whole):
            kept = [b"" if i in set(whole.tolist()) else t for i, t in enumerate(texts)]
            ids, ends = self._plain(kept)
            parts = np.split(ids, ends[:-1])
            asked = [texts[i].decode() for i in whole]
            for i, got in zip(whole, self.library.encode_batch_fast(asked, add_special_tokens=False)):
                parts[i] = np.array(got.ids, np.uint32)
            return np.concatenate(parts), np.cumsum([len(x) for x in parts])
        return self._plain(texts)

    def _plain(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        data, begin = joined(texts)
        if self.lower:
            data = LOWER[data]
        start, stop = cut(data, self.lower)
        keys = span_keys(data, start, stop)
        ids, count = self.lookup(keys, start, stop, data.tobytes())
        sums = np.concatenate(([0], np.cumsum(count)))
        return ids, sums[np.searchsorted(start, begin[1:])]


@cache
def encoder(path: str, bits: int = 20) -> Encoder:
    """One encoder per Python worker and file; its table lives as long as the worker."""
    return Encoder(path, bits)
