"""A small causal self-attention model of subword ids, trained and run in numpy.

One attention layer over windows of ``WINDOW`` ids and a hidden layer give the chances of
``CLASSES`` classes of ids; an id's chance within its class is its smoothed frequency. Ids
are classed by the ids that stand beside them. Windows overlap: all but the first window
of a text score only their last ``STRIDE`` ids and take the rest as context, so each id is
scored once, from at least ``WINDOW - STRIDE`` ids before it where the text has them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WINDOW = 32
STRIDE = 24
CLASSES = 48
SIZE = 16
HIDDEN = 32
#: Hashed ids on either side by which ids are classed.
BESIDE = 64
_CLASS_SEED = 3
_MASK = np.tril(np.ones((WINDOW, WINDOW), np.float32))


@dataclass
class Attention:
    """Parameters; ``kind`` and ``inner`` are each id's class and log chance within it."""

    table: np.ndarray
    place: np.ndarray
    query: np.ndarray
    key: np.ndarray
    value: np.ndarray
    into: np.ndarray
    into_shift: np.ndarray
    out: np.ndarray
    out_shift: np.ndarray
    kind: np.ndarray
    inner: np.ndarray
    end: int

    def forward(self, x: np.ndarray, since: int = 0):
        """Hidden layer at every place of windows of ids from ``since`` on, with what the gradient needs."""
        h = np.take(self.table, x, axis=0)
        h += self.place
        n, places = len(h), WINDOW - since
        own = h.reshape(-1, SIZE) if not since else h[:, since:].reshape(-1, SIZE)
        q = (own @ self.query).reshape(n, places, SIZE)
        beside = h.reshape(-1, SIZE) @ np.concatenate((self.key, self.value), axis=1)
        k, v = (beside[:, i : i + SIZE].reshape(n, WINDOW, SIZE) for i in (0, SIZE))
        weight = np.matmul(q, k.transpose(0, 2, 1))
        np.minimum(weight, 30, out=weight)
        np.exp(weight, out=weight)
        weight *= _MASK[since:]
        total = _row_sums(weight)
        seen = np.matmul(weight, v)
        seen /= total
        seen = seen.reshape(-1, SIZE)
        hidden = own @ self.into[:SIZE]
        hidden += seen @ self.into[SIZE:]
        hidden += self.into_shift
        return _tanh(hidden), (own, q, k, v, weight, total, seen)

    def log_chances(self, texts: list[np.ndarray]) -> np.ndarray:
        """Natural log chance of each text's ids and its end, text after text."""
        return self.log_chances_of(texts, np.zeros(len(self.kind), bool))[0]

    def log_chances_of(self, texts: list[np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``log_chances``, and at the same places that of any of ``ids`` (marks) or the end."""
        marked = ids.copy()
        marked[self.end] = True
        share = np.bincount(self.kind, np.exp(self.inner.astype(np.float64)) * marked, CLASSES)
        sums = np.column_stack((np.ones(CLASSES), share)).astype(np.float32)
        size = np.array([len(t) + 1 for t in texts], np.int64)
        first = np.cumsum(size) - size
        x = np.full(int(size.sum()), self.end, np.int64)
        keep = np.ones(len(x), bool)
        keep[first] = False
        if len(texts):
            x[keep] = np.concatenate(texts)
        target = np.append(x[1:], self.end)
        target[first + size - 1] = self.end
        kind, inner = self.kind[target], self.inner[target]
        windows = 1 + np.maximum(0, -(-(size - WINDOW) // STRIDE))
        nth = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        begin = np.repeat(first, windows) + nth * STRIDE
        last = np.repeat(first + size - 1, windows)
        out, any_of = np.empty(len(x), np.float32), np.empty(len(x), np.float32)
        for since, which in ((0, nth == 0), (WINDOW - STRIDE, nth > 0)):
            begins, lasts = begin[which], last[which]
            for a in range(0, len(begins), 64):
                at = begins[a : a + 64, None] + np.arange(WINDOW)
                most = lasts[a : a + 64, None]
                hidden, _ = self.forward(np.take(x, np.minimum(at, most)), since)
                score = hidden @ self.out
                score += self.out_shift
                np.minimum(score, 60, out=score)
                at = at[:, since:]
                real = (at <= most).ravel()
                spot = at.ravel()[real]
                own = score[np.flatnonzero(real), kind[spot]]
                np.exp(score, out=score)
                total, share = (score @ sums)[real].T
                out[spot] = own - np.log(total) + inner[spot]
                any_of[spot] = np.log(np.minimum(share / total, 1) + 1e-30)
        return out, any_of


def _row_sums(x: np.ndarray) -> np.ndarray:
    """Sums over the last axis, which is kept; a product is faster than adding up short rows."""
    return (x.reshape(-1, x.shape[-1]) @ np.ones(x.shape[-1], x.dtype)).reshape(*x.shape[:-1], 1)


def _tanh(x: np.ndarray) -> np.ndarray:
    """Hyperbolic tangent in place, by the exponential function, which takes half the time."""
    np.clip(x, -20, 20, out=x)
    x *= 2
    np.exp(x, out=x)
    x += 1
    np.divide(-2, x, out=x)
    x += 1
    return x


def gathered(texts: list[np.ndarray], vocabulary: int, end: int, into: np.ndarray | None = None) -> np.ndarray:
    """For each id how often it occurs, and hashed counts of the ids before and after it.

    Every text is closed by ``end``, which also stands before its first id. Rows of
    ``1 + 2 * BESIDE`` counts; with ``into`` they are added to those of other texts.
    """
    out = np.zeros((vocabulary, 1 + 2 * BESIDE)) if into is None else into
    hashed = np.random.default_rng(_CLASS_SEED).integers(0, BESIDE, vocabulary)
    stream = np.concatenate([[end], *(np.append(t, end) for t in texts)]).astype(np.int64)
    own, before = stream[1:], stream[:-1]
    out[:, 0] += np.bincount(own, minlength=vocabulary).astype(out.dtype)
    for at, ids, beside in ((1, own, before), (1 + BESIDE, before, own)):
        number = np.bincount(ids * BESIDE + hashed[beside], minlength=vocabulary * BESIDE)
        out[:, at : at + BESIDE] += number.reshape(vocabulary, BESIDE).astype(out.dtype)
    return out


def _classes(counts: np.ndarray, end: int) -> np.ndarray:
    """Class of every id by k-means of what is ``gathered``; the end has class 0 for itself."""
    rng = np.random.default_rng(_CLASS_SEED)
    rng.integers(0, BESIDE, len(counts))  # the hashes of ``gathered``
    kind = 1 + rng.integers(0, CLASSES - 1, len(counts))
    seen = np.flatnonzero(counts[:, 0])
    if len(seen):
        count = counts[seen, 0].astype(np.float64)
        beside = counts[seen, 1:].astype(np.float32)
        beside = np.sqrt(beside / np.maximum(beside.sum(axis=1, keepdims=True), 1))
        weight = np.sqrt(count)[:, None].astype(np.float32)
        centre = beside[rng.choice(len(seen), CLASSES - 1, p=count / count.sum())]
        for _ in range(10):
            near = np.argmax(beside @ centre.T - 0.5 * (centre**2).sum(axis=1), axis=1)
            for c in range(CLASSES - 1):
                own = near == c
                if own.any():
                    centre[c] = (beside[own] * weight[own]).sum(axis=0) / weight[own].sum()
        kind[seen] = 1 + near
    kind[end] = 0
    return kind


def inner(count: np.ndarray, kind: np.ndarray, add: float = 0.02) -> np.ndarray:
    """Log chance of each id within its class, by how often it occurs."""
    count = count.astype(np.float64) + add
    total = np.bincount(kind, count, CLASSES)
    return np.log(count / total[kind]).astype(np.float32)


def start(counts: np.ndarray, end: int, seed: int = 9) -> Attention:
    """Untrained model with the classes and frequencies of what is ``gathered``."""
    rng = np.random.default_rng(seed)
    normal = lambda *shape, scale=0.2: rng.normal(0, scale, shape).astype(np.float32)
    kind = _classes(counts, end)
    model = Attention(
        table=normal(len(counts), SIZE),
        place=normal(WINDOW, SIZE, scale=0.05),
        query=normal(SIZE, SIZE),
        key=normal(SIZE, SIZE),
        value=normal(SIZE, SIZE),
        into=normal(2 * SIZE, HIDDEN),
        into_shift=np.zeros(HIDDEN, np.float32),
        out=normal(HIDDEN, CLASSES, scale=0.1),
        out_shift=np.zeros(CLASSES, np.float32),
        kind=kind,
        inner=inner(counts[:, 0], kind),
        end=end,
    )
    model.out_shift[np.bincount(kind, minlength=CLASSES) == 0] = -1e4  # no chance for no id
    return model


def windows(texts: list[np.ndarray], end: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids of texts in windows, and what follows each; -1 where a text is over."""
    size = np.array([len(t) + 1 for t in texts], np.int64)
    first = np.cumsum(size) - size
    target = np.concatenate([np.append(t, end) for t in texts] or [np.empty(0)]).astype(np.int64)
    x = np.concatenate(([end], target[:-1]))[: len(target)]  # a text begins after an end
    number = -(-size // WINDOW)
    nth = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
    at = (np.repeat(first, number) + nth * WINDOW)[:, None] + np.arange(WINDOW)
    last = np.repeat(first + size - 1, number)[:, None]
    real = at <= last
    at = np.minimum(at, last)
    return x[at], np.where(real, target[at], -1)


class Learner:
    """Adam over windows of ids; ``model`` is changed in place."""

    def __init__(self, model: Attention, seed: int = 9):
        self.model, self.rng, self.moments, self.turn = model, np.random.default_rng(seed), {}, 0

    def learn(self, x: np.ndarray, target: np.ndarray, rates: tuple[float, float], batch: int = 64) -> None:
        """One pass in random order, the rate going from the first to the second."""
        y = np.where(target < 0, -1, self.model.kind[target])
        order = self.rng.permutation(len(x))
        for a in range(0, len(order), batch):
            self.turn += 1
            rate = rates[0] + (rates[1] - rates[0]) * a / len(order)
            own = order[a : a + batch]
            for name, rows, gradient in _gradients(self.model, x[own], y[own]):
                _adam(getattr(self.model, name), rows, gradient, self.moments, name, rate, self.turn)


def fit(model: Attention, texts: list[np.ndarray], epochs: int = 3, seed: int = 9) -> Attention:
    """Train ``model`` on all ids and ends of texts; changes and returns it."""
    learner = Learner(model, seed)
    x, target = windows(texts, model.end)
    rate = lambda turn: 0.01 * (1 - 0.9 * turn / max(epochs, 1))
    for turn in range(epochs):
        learner.learn(x, target, (rate(turn), rate(turn + 1)))
    return model


def train(
    texts: list[np.ndarray], vocabulary: int, end: int, epochs: int = 3, seed: int = 9
) -> Attention:
    """Fit a model to texts of ids below ``vocabulary`` by Adam; ``end`` closes a text."""
    return fit(start(gathered(texts, vocabulary, end), end, seed), texts, epochs, seed)


#: Parameters that every window moves; the rows of ``table`` move with their ids.
DENSE = ("place", "query", "key", "value", "into", "into_shift", "out", "out_shift")


def changes(old: Attention, new: Attention, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What training on ``seen[i]`` places of each id changed, weighted by them.

    Rows of ids (weight, then changes) and the same of all other parameters in one vector.
    Sums of these over several trainings from ``old`` go to ``moved``.
    """
    weight = seen.astype(np.float64)[:, None]
    rows = np.concatenate((weight, (new.table - old.table) * weight), axis=1)
    flat = np.concatenate([(getattr(new, n) - getattr(old, n)).ravel() for n in DENSE]).astype(np.float64)
    return rows, np.concatenate(([weight.sum()], flat * weight.sum()))


def moved(model: Attention, rows: np.ndarray, flat: np.ndarray) -> Attention:
    """``model`` moved in place by the weighted mean of ``changes``."""
    model.table += (rows[:, 1:] / np.maximum(rows[:, :1], 1)).astype(np.float32)
    at = 1
    for name in DENSE:
        value = getattr(model, name)
        value += (flat[at : at + value.size] / max(flat[0], 1)).reshape(value.shape).astype(np.float32)
        at += value.size
    return model


def _adam(value, rows, gradient, moments, name, rate, turn) -> None:
    if name not in moments:
        moments[name] = np.zeros_like(value), np.zeros_like(value)
    m, v = moments[name]
    step = float(rate * np.sqrt(1 - 0.98**turn) / (1 - 0.9**turn))  # a numpy double would make all doubles
    one, two = (m, v) if isinstance(rows, slice) else (np.take(m, rows, axis=0), np.take(v, rows, axis=0))
    one *= 0.9
    one += 0.1 * gradient
    two *= 0.98
    two += 0.02 * np.square(gradient)
    change = np.sqrt(two)
    change += 1e-7
    np.divide(one, change, out=change)
    change *= step
    value[rows] -= change
    if one is not m:
        m[rows], v[rows] = one, two


def _gradients(model: Attention, x: np.ndarray, y: np.ndarray):
    """Gradients of the mean class loss, as (parameter, rows, gradient).

    Places of class -1 have no loss.
    """
    hidden, (flat, q, k, v, weight, total, seen) = model.forward(x)
    score = hidden @ model.out
    score += model.out_shift
    score -= score.max(axis=1, keepdims=True)
    chance = np.exp(score, out=score)
    chance /= _row_sums(chance)
    y = y.ravel()
    real = np.flatnonzero(y >= 0)
    chance[real, y[real]] -= 1
    if len(real) < len(y):
        chance[y < 0] = 0
    chance /= len(real)
    every = slice(None)
    yield "out", every, hidden.T @ chance
    yield "out_shift", every, _ones_sum(chance)
    back = chance @ model.out.T
    np.square(hidden, out=hidden)
    np.subtract(1, hidden, out=hidden)
    back *= hidden
    yield "into", every, np.concatenate((flat.T @ back, seen.T @ back))
    yield "into_shift", every, _ones_sum(back)
    h_back = back @ model.into[:SIZE].T
    seen_back = (back @ model.into[SIZE:].T).reshape(q.shape)
    weight /= total
    backs = np.empty((*q.shape[:2], 3 * SIZE), np.float32)
    np.matmul(weight.transpose(0, 2, 1), seen_back, out=backs[:, :, 2 * SIZE :])
    raw = np.matmul(seen_back, v.transpose(0, 2, 1))
    raw -= np.einsum("nps,nps->np", seen_back, seen.reshape(q.shape))[:, :, None]  # mean by the shares
    raw *= weight
    np.matmul(raw, k, out=backs[:, :, :SIZE])
    np.matmul(raw.transpose(0, 2, 1), q, out=backs[:, :, SIZE : 2 * SIZE])
    backs = backs.reshape(-1, 3 * SIZE)
    h_back += backs @ np.concatenate((model.query, model.key, model.value), axis=1).T
    for i, own in enumerate(np.split(flat.T @ backs, 3, axis=1)):
        yield ("query", "key", "value")[i], every, own
    yield "place", every, _ones_sum(h_back.reshape(len(x), -1)).reshape(WINDOW, SIZE)
    ids = x.ravel()
    order = np.argsort(ids.astype(np.uint16) if len(model.table) <= 1 << 16 else ids, kind="stable")
    ids = ids[order]
    begin = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
    yield "table", ids[begin], np.add.reduceat(np.take(h_back, order, axis=0), begin, axis=0)


def _ones_sum(x: np.ndarray) -> np.ndarray:
    return np.ones(len(x), x.dtype) @ x
