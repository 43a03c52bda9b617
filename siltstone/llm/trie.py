"""Double-array tries over word numbers, walked by all positions of a text at once.

State ``t`` is the child of ``s`` by symbol ``c`` if ``t == base[s] + c`` and
``check[t] == s``. State 0 is the root.
"""

from __future__ import annotations

import numpy as np

#: Rounds in a row that place next to nothing before the arrays grow.
_PATIENCE = 12


class DoubleArray:
    """Built from ``paths``, one row of symbols per sequence, -1 after its end.

    ``end[i]`` is the state in which sequence ``i`` ends.
    """

    def __init__(self, paths: np.ndarray, seed: int = 1):
        self._rng = np.random.default_rng(seed)
        self.width = int(paths.max(initial=0)) + 1
        self.base = np.zeros(1, np.int32)
        self.check = np.full(1, -2, np.int32)  # the root is nobody's child
        self._grow(self.width + 2 * len(paths))
        self.end = np.zeros(len(paths), np.int64)
        for level in range(paths.shape[1] if len(paths) else 0):
            going = np.flatnonzero(paths[:, level] >= 0)
            self._place(going, paths[going, level].astype(np.int64))

    def _grow(self, more: int) -> None:
        self.base = np.concatenate((self.base, np.zeros(more, np.int32)))
        self.check = np.concatenate((self.check, np.full(more, -1, np.int32)))

    def _place(self, rows: np.ndarray, symbol: np.ndarray) -> None:
        """Give every new child of the rows' states a place, parents of many children first."""
        edge = np.unique(self.end[rows] * self.width + symbol)
        parent, child = np.divmod(edge, self.width)
        parents, first, count = np.unique(parent, return_index=True, return_counts=True)
        for size in sorted({int(c).bit_length() for c in count}, reverse=True):
            todo = np.flatnonzero(np.frexp(count.astype(float))[1] == size)
            floor, idle = 1, 0
            while len(todo):
                left = self._round(todo, floor, parents, first, count, child)
                idle = idle + 1 if len(left) > 0.98 * len(todo) else 0
                todo, floor = left, 1
                if idle == _PATIENCE:
                    floor, idle = len(self.check), 0
                    span = child[first[todo] + count[todo] - 1] - child[first[todo]]
                    self._grow(int(span.max()) + 2 + 2 * int(count[todo].sum()))
        self.end[rows] = self.base[self.end[rows]].astype(np.int64) + symbol

    def _round(self, todo, floor, parents, first, count, child) -> np.ndarray:
        """One attempt for each parent at a random place from ``floor`` on; those that found none."""
        own, size = np.repeat(np.arange(len(todo)), count[todo]), count[todo]
        edge = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + first[todo][own]
        low, high = child[first[todo]], child[first[todo] + size - 1]
        room = len(self.check) - floor - (high - low)
        fits = room > 0
        begin = floor + (self._rng.random(len(todo)) * np.maximum(room, 1)).astype(np.int64)
        slot = (begin - low)[own] + child[edge]
        bad = ~fits[own]
        slot[bad] = 0
        bad |= self.check[slot] != -1
        _, winner, which = np.unique(slot, return_index=True, return_inverse=True)
        bad |= winner[which] != np.arange(len(slot))  # two parents at one place: the first has it
        lost = np.zeros(len(todo), bool)
        lost[own[bad]] = True
        kept = ~lost[own]
        self.check[slot[kept]] = parents[todo][own[kept]]
        self.base[parents[todo][~lost]] = (begin - low)[~lost]
        return todo[lost]

    def step(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The states reached from ``state`` by ``symbol``; -1 where there is no child."""
        to = self.base[state].astype(np.int64) + symbol
        inside = (to > 0) & (to < len(self.check)) & (symbol >= 0)
        to[~inside] = 0
        return np.where(inside & (self.check[to] == state), to, -1)
