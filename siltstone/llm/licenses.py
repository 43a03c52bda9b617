"""License scan by a positional index of rare words (operator 13).

1. One pass counts in how many texts each word of the licence wordings occurs.
2. The index holds, for every wording, the positions of its rarest words. Of each text the
   rarest licence words are looked up in it; an occurrence at place p that meets position q
   says that the wording begins at p - q. Beginnings on which several words agree, give or
   take ``SLACK`` words, are candidates.
3. A candidate is compared with the whole wording, each word weighed by its rarity, and its
   mandatory key phrases must stand word for word within it.

Base phrases are found the same way, by their rarest word, and must match in full; all
their places are reported.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.bytesets import ALNUM, blocks, texts_of
from siltstone.llm.lexicon import Cut, Lexicon, cut_words

#: Words by which a wording's parts may be shifted against each other.
SLACK = 4
#: Positions of a wording in the index, the rarest.
INDEXED = 16
#: Licence words of a text that are looked up, the rarest.
LOOKED_UP = 48
#: Looked-up words that must agree on a beginning; shorter wordings need two.
AGREEING = 3
#: Share of a wording's weight that must be there.
LEAST_SHARE = 0.75
_CHUNK = 1 << 22

# Phrases and their base labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


class Wording(NamedTuple):
    """Licence text to look for, and the phrases it must contain."""

    label: str
    text: str
    keys: tuple[str, ...]


# Customary notices of public licences.
WORDINGS = (
    Wording("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Wording(
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in "
        "compliance with the license you may obtain a copy of the license at",
        ("apache license version 2 0", "except in compliance with the license"),
    ),
    Wording(
        "gpl-3.0",
        "licensed under the gnu general public license version 3",
        ("gnu general public license version 3",),
    ),
    Wording(
        "gpl-3.0",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation either version 3 of the license "
        "or at your option any later version",
        ("gnu general public license", "version 3 of the license"),
    ),
    Wording(
        "gpl-2.0",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation either version 2 of the license "
        "or at your option any later version",
        ("gnu general public license", "version 2 of the license"),
    ),
    Wording(
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu "
        "lesser general public license as published by the free software foundation",
        ("gnu lesser general public license",),
    ),
    Wording(
        "agpl-3.0",
        "you can redistribute it and or modify it under the terms of the gnu affero general public license as "
        "published by the free software foundation either version 3 of the license",
        ("gnu affero general public license", "version 3 of the license"),
    ),
    Wording("mit", "this project is released under the mit license", ("mit license",)),
    Wording(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction including "
        "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
        "copies of the software",
        ("permission is hereby granted free of charge", "to deal in the software without restriction"),
    ),
    Wording(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is "
        "hereby granted provided that the above copyright notice and this permission notice appear in all copies",
        ("with or without fee is hereby granted",),
    ),
    Wording(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided "
        "that the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    Wording(
        "bsd-3-clause",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission",
        ("endorse or promote products derived from this software",),
    ),
    Wording(
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl "
        "was not distributed with this file you can obtain one at",
        ("mozilla public license v 2 0",),
    ),
    Wording("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Wording("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Wording("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Wording("cc-by-nd-4.0", "licensed under cc by nd 4 0", ("cc by nd 4 0",)),
    Wording(
        "cc-by-4.0",
        "this work is licensed under a creative commons attribution 4 0 international license",
        ("creative commons attribution 4 0 international license",),
    ),
    Wording(
        "cc0-1.0",
        "to the extent possible under law the author has waived all copyright and related or neighboring rights "
        "to this work",
        ("waived all copyright and related or neighboring rights",),
    ),
    Wording(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("free and unencumbered software",),
    ),
)


def _words(text: str) -> list[bytes]:
    cut = cut_words([text.encode()], ALNUM)
    return [cut.word(i) for i in range(len(cut.start))]


def vocabulary(base: dict[str, str], wordings: Sequence[Wording]) -> list[bytes]:
    """All words of the wordings and phrases."""
    texts = [*base, *(w.text for w in wordings), *(k for w in wordings for k in w.keys)]
    return sorted({word for text in texts for word in _words(text)})


class Index:
    """Rare words of the wordings by position; ``weight`` is each word's rarity."""

    def __init__(self, lexicon: Lexicon, weight: np.ndarray, base: dict[str, str], wordings: Sequence[Wording]):
        self.lexicon, self.weight = lexicon, weight
        number = {w: i for i, w in enumerate(vocabulary(base, wordings))}
        coded = lambda text: np.array([number[w] for w in _words(text)], np.int64)
        self.base = [(label, coded(phrase)) for phrase, label in base.items()]
        self.wordings = [(w.label, coded(w.text), [coded(k) for k in w.keys]) for w in wordings]
        rows = []
        for nth, (_, words, _) in enumerate(self.wordings):
            rarest = np.lexsort((np.arange(len(words)), -weight[words]))[:INDEXED]
            rows += [(words[q], nth, q) for q in rarest.tolist()]
        table = np.array(sorted(rows), np.int64).reshape(-1, 3)
        self.wording, self.position = table[:, 1], table[:, 2]
        self.first = np.searchsorted(table[:, 0], np.arange(len(weight) + 1))

    def places(self, word: np.ndarray, of: np.ndarray, phrase: np.ndarray) -> np.ndarray:
        """All places at which the words of a phrase stand one after another in one text."""
        anchor = int(np.argmax(self.weight[phrase]))
        begin = np.flatnonzero(word == phrase[anchor]) - anchor
        last = begin + len(phrase) - 1
        begin = begin[(begin >= 0) & (last < len(word))]
        for j, number in enumerate(phrase):
            begin = begin[word[begin + j] == number]
        return begin[of[begin] == of[begin + len(phrase) - 1]]

    def rare_hits(self, word: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Where each text's rarest licence words stand."""
        at = np.flatnonzero(word >= 0)
        at = at[self.first[word[at] + 1] > self.first[word[at]]]
        pair = of[at] * len(self.weight) + word[at]
        kinds, which = np.unique(pair, return_inverse=True)
        text, number = np.divmod(kinds, len(self.weight))
        order = np.lexsort((number, -self.weight[number], text))
        rank = np.empty(len(order), np.int64)
        begin = np.searchsorted(text[order], text[order])
        rank[order] = np.arange(len(order)) - begin
        return at[rank[which] < LOOKED_UP]

    def candidates(self, word: np.ndarray, of: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Wordings and the places at which enough rare words say that they begin."""
        at = self.rare_hits(word, of)
        number = self.first[word[at] + 1] - self.first[word[at]]
        # few texts at a time, as one may hold a word any number of times
        bounds = np.searchsorted(np.cumsum(number), np.arange(0, number.sum() + _CHUNK, _CHUNK))
        text = of[at]
        edges = [0]
        for b in bounds.tolist():
            b = min(b, len(at))
            end = int(np.searchsorted(text, text[b])) if b < len(at) else len(at)
            if end > edges[-1]:
                edges.append(end)
        if edges[-1] < len(at):
            edges.append(len(at))
        for a, b in zip(edges, edges[1:]):
            yield self._agreeing(at[a:b], number[a:b], word, of)

    def _agreeing(self, at, number, word, of) -> tuple[np.ndarray, np.ndarray]:
        row = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
        row += np.repeat(self.first[word[at]], number)
        place, wording = np.repeat(at, number), self.wording[row]
        begin = place - self.position[row]
        order = np.lexsort((begin, of[place], wording))
        place, wording, begin, position = place[order], wording[order], begin[order], self.position[row][order]
        # each entry with those of the same text and wording whose beginning is at most SLACK on
        span = len(word) + 2 * SLACK + 1000
        key = (wording * (int(of[-1]) + 1 if len(of) else 1) + of[place]) * span + begin + 500
        end = np.searchsorted(key, key + SLACK, side="right")
        size = end - np.arange(len(key))
        need = np.array([min(AGREEING, max(2, len(w) // 4)) for _, w, _ in self.wordings])[wording]
        chosen = np.flatnonzero(size >= need)
        # several occurrences of one position are one voice
        reach = int(size[chosen].max(initial=0))
        voices = np.zeros((len(chosen), 1), np.int64)
        seen = np.full((len(chosen), min(reach, 64)), -1, np.int64)
        for j in range(min(reach, 64)):
            inside = np.flatnonzero(size[chosen] > j)
            own = position[chosen[inside] + j]
            new = ~(seen[inside] == own[:, None]).any(axis=1)
            seen[inside[new], j] = own[new]
            voices[inside[new], 0] += 1
        chosen = chosen[(voices[:, 0] >= need[chosen]) | (size[chosen] > 64)]
        pair = np.unique(np.stack((wording[chosen], of[place[chosen]], begin[chosen])), axis=1)
        return pair[0], pair[1:]

    def shares(self, words: np.ndarray, word, first, text, begin) -> np.ndarray:
        """Weight share of a wording's words that stand about where they belong."""
        there = np.zeros((len(begin), len(words)), bool)
        low, high = first[text][:, None], first[text + 1][:, None]
        for shift in range(-SLACK, SLACK + 1):
            at = begin[:, None] + np.arange(len(words)) + shift
            inside = (at >= low) & (at < high)
            at[~inside] = 0
            there |= inside & (word[at] == words)
        weight = self.weight[words]
        return np.round((there * weight).sum(axis=1) / weight.sum(), 6)

    def scan(self, texts: list[bytes]) -> tuple[np.ndarray, list[list], list[list]]:
        """Word count, base spans and wordings of each text."""
        cut: Cut = cut_words(texts, ALNUM)
        word = self.lexicon.find(cut.data, cut.start, cut.stop).astype(np.int64)
        of, first = cut.of(), cut.first
        base: list[list] = [[] for _ in texts]
        for label, phrase in self.base:
            for at in self.places(word, of, phrase).tolist():
                begin = at - int(first[of[at]])
                base[of[at]].append({"label": label, "start": begin, "stop": begin + len(phrase)})
        found: list[dict] = [{} for _ in texts]
        keyed: dict[bytes, np.ndarray] = {}
        for wording, (text, begin) in self.candidates(word, of):
            for nth in np.unique(wording).tolist():
                label, words, keys = self.wordings[nth]
                own = wording == nth
                for a in range(0, int(own.sum()), 4096):
                    t, b = text[own][a : a + 4096], begin[own][a : a + 4096]
                    share = self.shares(words, word, first, t, b)
                    low, high = np.maximum(b - SLACK, first[t]), np.minimum(b + len(words) + SLACK, first[t + 1])
                    whole = share >= LEAST_SHARE
                    for key in keys:
                        spots = keyed.setdefault(key.tobytes(), None)
                        if spots is None:
                            spots = keyed[key.tobytes()] = np.sort(self.places(word, of, key))
                        inside = np.searchsorted(spots, high - len(key), side="right") - np.searchsorted(spots, low)
                        whole &= inside > 0
                    for i in np.flatnonzero(whole).tolist():
                        span = (share[i], -int(low[i]))
                        held = found[t[i]].get(label)
                        if held is None or span > held[0]:
                            start = int(low[i] - first[t[i]])
                            row = {"label": label, "start": start, "stop": int(high[i] - first[t[i]]), "share": float(share[i])}
                            found[t[i]][label] = (span, row)
        for spans in base:
            spans.sort(key=lambda s: (s["start"], s["label"]))
        return np.diff(first), base, [[held[label][1] for label in sorted(held)] for held in found]


def _frequencies(texts: DataFrame, lexicon: Lexicon) -> tuple[np.ndarray, int]:
    """In how many of the texts each word of the list occurs, and how many texts there are."""
    sent = texts.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = sent.value
        held, rows = np.zeros(lexicon.size, np.int64), 0
        for batch in batches:
            texts = texts_of(batch.column(0))
            rows += len(texts)
            for a, b in blocks(texts):
                cut = cut_words(texts[a:b], ALNUM)
                word = lexicon.find(cut.data, cut.start, cut.stop).astype(np.int64)
                known = word >= 0
                pair = np.unique(cut.of()[known] * lexicon.size + word[known])
                held += np.bincount(pair % lexicon.size, minlength=lexicon.size)
        number = np.append(np.arange(lexicon.size), -1)  # -1 counts the texts
        yield pa.RecordBatch.from_arrays([pa.array(number, pa.int32()), pa.array(np.append(held, rows))], ["word", "n"])

    counted = texts.mapInArrow(run, "word int, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    out, rows = np.zeros(lexicon.size, np.int64), 0
    for row in counted:
        if row.word >= 0:
            out[row.word] = row.n
        else:
            rows = row.n
    return out, rows


_SPANS = "array<struct<label:string,start:bigint,stop:bigint>>"
_FOUND = "array<struct<label:string,start:bigint,stop:bigint,share:double>>"


def license_scan(
    docs: DataFrame,
    keep: Sequence[str] | None = None,
    text_col: str = "text",
    base: dict[str, str] = BASE,
    wordings: Sequence[Wording] = WORDINGS,
    prefix: str = "",
) -> DataFrame:
    """``docs`` with ``n_words, base_spans, wordings`` of each text added.

    ``base_spans`` has every place of a base phrase (label, first word, word after the last),
    ``wordings`` the best place of each label whose wording and key phrases are there, with
    the share of its weight that was found. Spans count words from 0. A null or empty text
    has no words and no spans. ``keep`` names the input columns to return, all by default;
    input columns of the new names (after ``prefix``) are replaced. Rows stay as they are,
    repeated ones too, and no rows give none.
    """
    names = [f"{prefix}{c}" for c in ("n_words", "base_spans", "wordings")]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
    text = F.col(text_col)
    lexicon = Lexicon(vocabulary(base, wordings))
    held, rows = _frequencies(docs.select(text), lexicon)
    weight = np.log((rows + 1) / (held + 1)) + 0.01
    sent = docs.sparkSession.sparkContext.broadcast(Index(lexicon, weight, base, wordings))
    source = docs.select(*kept, text.alias("__scanned"))
    kinds = T.StructType.fromDDL(f"n bigint, b {_SPANS}, w {_FOUND}")
    fields = [T.StructField(f.name, f.dataType, True) for f in source.schema][:-1]
    schema = T.StructType(fields + [T.StructField(n, k.dataType) for n, k in zip(names, kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])
        share = pa.struct([*span, pa.field("share", pa.float64())])
        for batch in batches:
            texts = texts_of(batch.column(batch.num_columns - 1))
            sizes, spans, found = [], [], []
            for a, b in blocks(texts):
                n, own, met = sent.value.scan(texts[a:b])
                sizes += n.tolist()
                spans += own
                found += met
            added = [pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(span)), pa.array(found, pa.list_(share))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *added], [*batch.schema.names[:-1], *names])

    return source.mapInArrow(run, schema)
