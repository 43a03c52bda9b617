"""Exact token counts at every prefix of a text, by dynamic programming (operator 8).

Within a piece, the ids of a prefix end in one token whose removal leaves the ids of a
shorter prefix; it is the only token of the vocabulary that ends there and that the
merges leave apart from the token before it. So the count at a byte is one more than
the count where its last token begins, and one walk over a piece gives all counts.
A text's counts are its pieces' counts added up. Two places differ between a prefix
and the whole text and are set right: the last character of a run of white space,
which a cut there leaves in the run, and a cut inside 're, 've or 'll.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siltstone.llm.bytesets import blocks, joined, span_keys, texts_of
from siltstone.llm.pieces import _SPACE, Encoder, cut, kinds

_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SHORT = frozenset(("'re", "'ve", "'ll"))


def _shown() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class PrefixCounter(Encoder):
    """Prefix counts of pieces and texts under one byte-level vocabulary."""

    def __init__(self, path: str, bits: int = 20):
        super().__init__(path, bits)
        if self.lower:
            raise ValueError("prefix counts need a vocabulary that keeps every byte")
        self.table = dict(enumerate(_shown()))
        self.vocab = self.library.get_vocab(with_added_tokens=False)
        self.longest = max(map(len, self.vocab))
        self.apart: dict[tuple[str, str], bool] = {}

    def _tokens(self, text: str) -> list[str]:
        return [t.value for t in self.library.model.tokenize(text)]

    def _is_last(self, before: str, token: str) -> bool:
        """Whether ``token`` can follow ``before`` without a merge across their border."""
        if len(self.apart) > 1 << 20:
            self.apart.clear()
        whole = [before, token] if before else [token]
        kept = self._tokens(token) == [token] and self._tokens(before + token) == whole
        self.apart[before, token] = kept
        return kept

    def walk(self, piece: str) -> list[int]:
        """Token counts of the piece's prefixes, one per character."""
        return self._walk_on(piece, [""], [0], "")[0]

    def _walk_on(self, piece: str, last: list, count: list, before: str) -> tuple[list[int], str]:
        """``walk``, with ``last`` and ``count`` left over from the piece ``before``."""
        raw = piece.encode()
        text = raw.decode("latin-1").translate(self.table)
        same, most = 0, min(len(text), len(before))
        while same < most and text[same] == before[same]:
            same += 1
        del last[same + 1 :], count[same + 1 :]
        vocab, apart = self.vocab, self.apart
        for end in range(same + 1, len(text) + 1):
            for begin in range(max(0, end - self.longest), end):
                token = text[begin:end]
                if token in vocab:
                    kept = apart.get((last[begin], token))
                    if kept or kept is None and self._is_last(last[begin], token):
                        last.append(token)
                        count.append(count[begin] + 1)
                        break
            else:
                raise ValueError(f"no token ends at byte {end} of {piece!r}")
        if piece in _SHORT:
            return [1, 2, count[-1]], text
        if len(raw) == len(piece):
            return count[1:], text
        ends = (i for i in range(1, len(raw) + 1) if i == len(raw) or raw[i] & 0xC0 != 0x80)
        return [count[i] for i in ends], text

    def learn(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Prefix counts of all pieces; in sorted order each takes over its shared beginning."""
        found: list[list[int]] = [[]] * len(names)
        last, count, before = [""], [0], ""
        for i in sorted(range(len(names)), key=names.__getitem__):
            found[i], before = self._walk_on(names[i], last, count, before)
        return (
            np.array([n for counts in found for n in counts], np.uint32),
            np.array([len(counts) for counts in found], np.int64),
        )

    def counts(self, texts: list[bytes]) -> list[np.ndarray]:
        """For each text the token count of its first 1, 2, ... characters."""
        out: list[np.ndarray] = [np.empty(0, np.int64)] * len(texts)
        for a, b in blocks(texts):
            data, begin = joined(texts[a:b])
            whole = set(self.uncovered(data, begin).tolist())
            plain = [b"" if i in whole else t for i, t in enumerate(texts[a:b])]
            out[a:b] = self._counts_of(plain)
            for i in whole:
                out[a + i] = self.counts_of_any(texts[a + i].decode())
        return out

    def _counts_of(self, texts: list[bytes]) -> list[np.ndarray]:
        data, begin = joined(texts)
        raw = data.tobytes()
        start, stop = cut(data, False)
        within, length = self.lookup(span_keys(data, start, stop), start, stop, raw)
        within = within.astype(np.int64)
        ends = np.cumsum(length)
        tokens = within[ends - 1] if len(ends) else ends
        base = np.cumsum(tokens) - tokens
        counts = within + np.repeat(base, length)
        self._mend_runs(data, raw, start, ends - length, base, counts)
        first = np.searchsorted(start, begin)
        chars = np.concatenate(([0], ends))[first]
        bases = np.concatenate((base, [tokens.sum()]))[first]
        return [counts[chars[i] : chars[i + 1]] - bases[i] for i in range(len(texts))]

    def _mend_runs(self, data, raw, start, char, base, counts) -> None:
        """A prefix that ends in a run of white space keeps the run in one piece."""
        space = kinds(data) == _SPACE
        edge = np.flatnonzero(np.diff(np.concatenate(([False], space, [False])).astype(np.int8)))
        begin, end = edge[0::2], edge[1::2]
        begin, end = begin[data[end] != 0xFF], end[data[end] != 0xFF]
        last = end - 1 - (data[end - 1] >= 0x80)
        begin, end, last = (x[last > begin] for x in (begin, end, last))
        if not len(begin):
            return
        within, length = self.lookup(span_keys(data, begin, end), begin, end, raw)
        own = within[np.cumsum(length) - 1].astype(np.int64)
        # the piece of the last white-space character is the run's last or takes it along
        piece, lead = np.searchsorted(start, last), np.searchsorted(start, begin)
        counts[char[piece]] = base[lead] + own

    def counts_of_any(self, text: str) -> np.ndarray:
        """The same for a text of any characters and special tokens, piece by piece."""
        out: list[int] = []
        base = 0
        parts = text.split(self.mark)
        for i, part in enumerate(parts):
            more = self.mark[:-1] if i + 1 < len(parts) else ""
            counts = self._plain_counts(part + more)
            out += [base + n for n in counts]
            base += counts[len(part) - 1] if part else 0
            if i + 1 < len(parts):
                base += 1
                out.append(base)
        return np.array(out, np.int64)

    def _plain_counts(self, text: str) -> list[int]:
        import regex

        out: list[int] = []
        base = 0
        for found in regex.finditer(_PATTERN, text):
            a, b = found.span()
            own = self.walk(text[a:b])
            out += [base + n for n in own]
            base += own[-1]
        for found in regex.finditer(r"\s{2,}(?=\S)", text):
            a, b = found.span()
            out[b - 1] = (out[a - 1] if a else 0) + self.walk(text[a:b])[-1]
        return out


@cache
def counter(path: str) -> PrefixCounter:
    """One counter per Python worker."""
    return PrefixCounter(path)


def longest_prefix(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    fits = np.flatnonzero(counts <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def unpacked(stored: bytes) -> np.ndarray:
    """Counts at every prefix from the stored differences."""
    return np.cumsum(np.frombuffer(stored, "<i2").astype(np.int64))


def prefix_token_counts(
    docs: DataFrame,
    tokenizer: str,
    budget: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Token counts at every prefix of every text.

    Returns ``doc_id, n_bytes, n_tokens, prefix_chars, prefix_counts``: the text's
    UTF-8 length and token count, the characters of its longest prefix of at most
    ``budget`` tokens, and for each character the change of the count, as
    little-endian 16-bit integers (``unpacked`` adds them up). Null and empty texts
    have no tokens. Rows are independent, so repeated rows give repeated results;
    other columns are ignored. There is no shuffle.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(tokenizer)
        for batch in batches:
            texts = texts_of(batch.column(1))
            for a, b in blocks(texts, 4 << 20):
                found = own.counts(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([len(t) for t in texts[a:b]], pa.int64()),
                        pa.array([int(c[-1]) if len(c) else 0 for c in found], pa.int64()),
                        pa.array([longest_prefix(c, budget) for c in found], pa.int64()),
                        pa.array(
                            [np.diff(c, prepend=0).astype("<i2").tobytes() for c in found],
                            pa.binary(),
                        ),
                    ],
                    ["doc_id", "n_bytes", "n_tokens", "prefix_chars", "prefix_counts"],
                )

    return docs.select(id_col, text_col).mapInArrow(
        run,
        f"doc_id {kind}, n_bytes bigint, n_tokens bigint, prefix_chars bigint, prefix_counts binary",
    )
