"""A small causal self-attention language model in numpy.

Tokens are subword ids. A token's probability is P(class | context) * P(token |
class): the most frequent subwords are classes of their own, the others share
classes of about equal weight (those that end a word apart from the rest) and
are weighed inside by their smoothed counts. One attention layer over
``WINDOW`` positions predicts the class in two steps, its group and then its
place in the group, so a token costs ``GROUPS + PLACES`` outputs instead of
their product. All factors are normalised, so the product is a probability over
the whole vocabulary.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

WINDOW = 16  # positions of a context window
STRIDE = 8  # new tokens scored by every window after the first, each with at least half a window before it
WIDTH = 32
GROUPS, PLACES = 48, 48
SHARED_CLASSES = 32
SMOOTHING = 0.1  # added to every count inside a class
RATE, BATCH = 0.02, 64  # learning rate at the start, and windows a step
OWN_CLASSES = GROUPS * PLACES - SHARED_CLASSES
CLASSES = GROUPS * PLACES + 1  # the last one stands for the start of a text

_SHAPES = {
    "embed": (CLASSES, WIDTH), "place": (WINDOW, WIDTH), "qkv": (WIDTH, 3 * WIDTH), "mix": (WIDTH, WIDTH),
    "group": (WIDTH + 1, GROUPS), "member": (GROUPS, WIDTH + 1, PLACES),
}
SIZE = sum(int(np.prod(s)) for s in _SHAPES.values())
_MASK = np.triu(np.full((WINDOW, WINDOW), -1e9, "f4"), 1)
_SCALE = np.float32(WIDTH**-0.5)
_ONES = np.ones(GROUPS, "f4")  # a product with ones sums rows faster than sum()
_SEEN = np.ones((WINDOW, 1), "f4")
_SUM = np.ones((PLACES, 1), "f4")
FAR = 60  # up to here exp takes numbers as they are
BLOCK = 16_384  # weights updated at a time: their averages stay in the cache


@dataclass(frozen=True)
class Vocabulary:
    """``class_of`` every subword id, and log P(subword | class)."""

    class_of: np.ndarray
    inside: np.ndarray
    class_counts: np.ndarray

    @staticmethod
    def from_counts(counts: np.ndarray, ends_word: np.ndarray) -> Vocabulary:
        """``counts`` of every subword id in the training texts; ``ends_word``:
        whether the subword is the last of a word."""
        smooth = counts.astype("f8") + SMOOTHING
        order = np.argsort(-smooth, kind="stable")
        class_of = np.zeros(len(counts), "i2")
        own = order[:OWN_CLASSES]
        # Groups are stretches of class numbers: word ends apart, by frequency.
        class_of[own[np.argsort(~ends_word[own], kind="stable")]] = np.arange(len(own))
        half = SHARED_CLASSES // 2
        for k in (0, 1):
            rest = order[OWN_CLASSES:]
            rest = rest[ends_word[rest] == bool(k)]
            mass = np.cumsum(smooth[rest])
            share = (mass - smooth[rest] / 2) / mass[-1] * half if len(rest) else mass
            class_of[rest] = OWN_CLASSES + k * half + np.minimum(share.astype("i8"), half - 1)
        total = np.bincount(class_of, weights=smooth, minlength=CLASSES - 1)
        return Vocabulary(class_of, (np.log(smooth) - np.log(np.maximum(total, 1e-300)[class_of])).astype("f4"), total)


def initial_weights(vocabulary: Vocabulary, seed: int = 7) -> np.ndarray:
    """Small random weights; the last input row, a constant, starts at the
    frequencies of groups and of classes in their group."""
    rng = np.random.default_rng(seed)
    parts = {k: (rng.standard_normal(s) * 0.1).astype("f4") for k, s in _SHAPES.items()}
    total = np.maximum(vocabulary.class_counts, 1e-3).reshape(GROUPS, PLACES)
    by_group = total.sum(axis=1)
    parts["group"][WIDTH] = np.log(by_group / by_group.sum())
    parts["member"][:, WIDTH] = np.log(total / by_group[:, None])
    return np.concatenate([parts[k].ravel() for k in _SHAPES])


_ENDS = np.cumsum([int(np.prod(s)) for s in _SHAPES.values()]).tolist()
_PLACED = [(k, s, a, b) for (k, s), a, b in zip(_SHAPES.items(), [0, *_ENDS], _ENDS, strict=False)]


def unpack(weights: np.ndarray) -> dict[str, np.ndarray]:
    """Views of the parts."""
    return {k: weights[a:b].reshape(s) for k, s, a, b in _PLACED}


def _times(x: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """``x @ matrix`` as one product, where numpy would take one for each window."""
    return (x.reshape(-1, x.shape[2]) @ matrix).reshape(*x.shape[:2], -1)


def _attend(p: dict, given: np.ndarray):
    """Hidden states of windows of class ids ``given`` (n, WINDOW), and what the
    backward pass needs. Masked: a position sees itself and what is before it."""
    x = np.take(p["embed"], given, axis=0)
    x += p["place"]
    qkv = _times(x, p["qkv"])
    q, k, v = (qkv[:, :, i * WIDTH : (i + 1) * WIDTH] for i in range(3))
    a = q @ k.transpose(0, 2, 1)
    a *= _SCALE
    far = _reach(a) > FAR
    a += _MASK
    if far:
        a -= a.max(axis=2, keepdims=True)
    np.exp(a, out=a)
    a /= a @ _SEEN
    o = a @ v
    hidden = _times(o, p["mix"])
    hidden += x
    return hidden, (x, q, k, v, a, o)


def _by_group(wanted: np.ndarray):
    """An order that brings targets of one group together, and each group's end."""
    group = wanted // PLACES
    order = np.argsort(group.astype("i1"), kind="stable")
    return group, order, np.cumsum(np.bincount(group, minlength=GROUPS))


def _reach(x: np.ndarray) -> float:
    """The largest absolute value."""
    return max(float(x.max(initial=0.0)), -float(x.min(initial=0.0)))


def _log_softmax_at(logits: np.ndarray, target: np.ndarray, reach: float) -> np.ndarray:
    """log softmax(logits)[target] by row; ``logits`` are overwritten."""
    if reach > FAR:
        logits -= logits.max(axis=1, keepdims=True)
    picked = logits[np.arange(len(target)), target]
    return picked - np.log(np.exp(logits, out=logits) @ _ONES)


def _longest(rows: np.ndarray) -> float:
    """The largest Euclidean length of a row."""
    return float(np.sqrt((rows.astype("f8") ** 2).sum(axis=1)).max())


class Scorer:
    """The forward pass alone, arranged for speed: the projections of every
    (class, position) are tables, so a window starts with two lookups, and windows
    scored in their last ``STRIDE`` positions alone attend from those only. Same
    values as ``_attend``."""

    def __init__(self, weights: np.ndarray):
        self.p = p = unpack(weights)
        mine = np.concatenate([np.eye(WIDTH, dtype="f4"), p["qkv"][:, :WIDTH] * _SCALE], axis=1)
        self.mine = [p[k] @ mine for k in ("embed", "place")]  # state and query
        self.seen = [p[k] @ p["qkv"][:, WIDTH:] for k in ("embed", "place")]  # key and value
        columns = np.concatenate([p["group"], *p["member"]], axis=1)
        self.steepest = _longest(columns.T)
        # Bound of every attention score (Cauchy-Schwarz): exp needs no maximum
        # taken off while it is small.
        self.sharpest = math.prod(
            sum(_longest(t) for t in part) for part in ([t[:, WIDTH:] for t in self.mine], [t[:, :WIDTH] for t in self.seen])
        )

    def _hidden(self, given: np.ndarray, scored: np.ndarray, start: int) -> np.ndarray:
        """Hidden states at the positions ``scored``, none of them before ``start``."""
        seen = np.take(self.seen[0], given, axis=0)
        seen += self.seen[1]
        mine = np.take(self.mine[0], given[:, start:], axis=0)
        mine += self.mine[1][start:]
        a = mine[:, :, WIDTH:] @ seen[:, :, :WIDTH].transpose(0, 2, 1)
        a += _MASK[start:]
        if self.sharpest > FAR:
            a -= a.max(axis=2, keepdims=True)
        np.exp(a, out=a)
        o = a @ seen[:, :, WIDTH:]
        o /= a @ _SEEN
        hidden = _times(o, self.p["mix"])
        hidden += mine[:, :, :WIDTH]
        return hidden[scored[:, start:]]

    def log_probabilities(self, given: np.ndarray, wanted: np.ndarray, scored: np.ndarray) -> np.ndarray:
        """log P of the classes ``wanted`` at the positions ``scored`` (mask), in order."""
        p, early = self.p, WINDOW - STRIDE
        target = wanted[scored]
        hidden = np.ones((len(target), WIDTH + 1), "f4")
        whole = scored[:, :early].any(axis=1)
        of_whole = np.repeat(whole, scored.sum(axis=1))
        for windows, rows, start in ((~whole, ~of_whole, early), (whole, of_whole, 0)):
            if rows.any():
                hidden[rows, :WIDTH] = self._hidden(given[windows], scored[windows], start)
        group, order, ends = _by_group(target)
        # Bound of every logit in the same way, without a pass over them.
        reach = _reach(hidden) * math.sqrt(WIDTH + 1) * self.steepest
        out = _log_softmax_at(hidden @ p["group"], group, reach)
        hidden = np.take(hidden, order, axis=0)
        members = np.empty((len(target), PLACES), "f4")
        at = 0
        for member, end in zip(p["member"], ends.tolist(), strict=True):
            if end > at:
                hidden[at:end].dot(member, members[at:end])
            at = end
        out[order] += _log_softmax_at(members, target[order] % PLACES, reach)
        return out


def log_probabilities(weights: np.ndarray, given: np.ndarray, wanted: np.ndarray, scored: np.ndarray) -> np.ndarray:
    return Scorer(weights).log_probabilities(given, wanted, scored)


def windows_of(classes: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of one text's class ids: (given, wanted, scored), each (n, WINDOW),
    overlapping unless ``stride`` is WINDOW. Every position is scored in exactly
    one window."""
    n = len(classes)
    count = 1 + max(0, -(-(n - WINDOW) // stride))
    at = (np.arange(count) * stride)[:, None] + np.arange(WINDOW)
    inside = at < n
    at = np.minimum(at, n - 1)
    wanted = classes[at]
    given = np.where(at > 0, classes[at - 1], CLASSES - 1)
    scored = inside.copy()
    scored[1:, : WINDOW - stride] = False
    return given, wanted, scored


def _softmax_loss(logits: np.ndarray, target: np.ndarray) -> tuple[float, np.ndarray]:
    """Summed loss, and its gradient by the logits (which are overwritten)."""
    if _reach(logits) > FAR:
        logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits @ _SUM
    rows = np.arange(len(target))
    loss = -float(np.log(logits[rows, target] + 1e-12).sum())
    logits[rows, target] -= 1
    return loss, logits


def _gradient(weights: np.ndarray, given: np.ndarray, wanted: np.ndarray, real: np.ndarray):
    p = unpack(weights)
    flat = np.zeros(SIZE, "f4")
    g = unpack(flat)
    hidden, (x, q, k, v, a, o) = _attend(p, given)
    target = wanted[real]
    n = np.float32(max(1, len(target)))
    # Positions in the order of their targets' groups.
    group, order, ends = _by_group(target)
    at = np.flatnonzero(real)[order]
    h = np.ones((len(at), WIDTH + 1), "f4")
    h[:, :WIDTH] = np.take(hidden.reshape(-1, WIDTH), at, axis=0)
    loss, d = _softmax_loss(h @ p["group"], group[order])
    d /= n
    np.matmul(h.T, d, out=g["group"])
    dh = d @ p["group"].T
    starts = [0, *ends[:-1].tolist()]
    spans = [x for x in zip(p["member"], g["member"], starts, ends.tolist(), strict=True) if x[3] > x[2]]
    members = np.empty((len(h), PLACES), "f4")
    for member, _, i, j in spans:
        h[i:j].dot(member, members[i:j])
    part, d = _softmax_loss(members, target[order] % PLACES)
    loss += part
    d /= n
    dm = np.empty_like(h)
    for member, slope, i, j in spans:
        h[i:j].T.dot(d[i:j], slope)
        d[i:j].dot(member.T, dm[i:j])
    dh += dm
    dhidden = np.zeros_like(hidden)
    dhidden.reshape(-1, WIDTH)[at] = dh[:, :WIDTH]
    np.matmul(o.reshape(-1, WIDTH).T, dhidden.reshape(-1, WIDTH), out=g["mix"])
    do = _times(dhidden, p["mix"].T)
    ds = do @ v.transpose(0, 2, 1)
    ds -= (ds * a) @ _SEEN
    ds *= a
    ds *= _SCALE
    dqkv = np.empty((*given.shape, 3 * WIDTH), "f4")
    np.matmul(ds, k, out=dqkv[:, :, :WIDTH])
    np.matmul(ds.transpose(0, 2, 1), q, out=dqkv[:, :, WIDTH : 2 * WIDTH])
    np.matmul(a.transpose(0, 2, 1), do, out=dqkv[:, :, 2 * WIDTH :])
    np.matmul(x.reshape(-1, WIDTH).T, dqkv.reshape(-1, 3 * WIDTH), out=g["qkv"])
    dx = _times(dqkv, p["qkv"].T)
    dx += dhidden
    np.sum(dx, axis=0, out=g["place"])
    by_class = np.argsort(given.ravel().astype("i2"), kind="stable")
    seen = given.ravel()[by_class]
    first = np.flatnonzero(np.append(True, seen[1:] != seen[:-1]))
    g["embed"][seen[first]] = np.add.reduceat(np.take(dx.reshape(-1, WIDTH), by_class, axis=0), first)
    return loss, flat


class Trainer:
    """Adam over batches of windows; its averages last from one ``learn`` to the
    next. The rate falls in a line over the ``expected`` windows, of which ``done``
    lie behind, to a twentieth of its start, and stays there."""

    def __init__(self, weights: np.ndarray, expected: int, *, done: int = 0, rate: float = RATE, batch: int = BATCH):
        self.weights = weights.astype("f4").copy()
        self.sums, self.squares = np.zeros_like(self.weights), np.zeros_like(self.weights)
        self.expected, self.done, self.rate, self.batch = max(1, expected), done, rate, batch
        self.steps = self.windows = 0

    def learn(self, given: np.ndarray, wanted: np.ndarray, real: np.ndarray, seed: int = 1) -> float:
        """One pass over the windows in a shuffled order; the summed loss."""
        order = np.random.default_rng(seed).permutation(len(given))
        total = 0.0
        for at in range(0, len(order), self.batch):
            part = order[at : at + self.batch]
            loss, g = _gradient(self.weights, given[part], wanted[part], real[part])
            total += float(loss)
            self.steps += 1
            rate = self.rate * max(0.05, 1 - (self.done + self.windows) / self.expected) / (1 - 0.9**self.steps)
            # The sums are 10 and 100 times the averages; ``unit`` is the root of a
            # sum over that of its average, corrected for the start at zero.
            unit = math.sqrt(100 * (1 - 0.99**self.steps))
            for i in range(0, SIZE, BLOCK):
                w, sums, squares, d = (k[i : i + BLOCK] for k in (self.weights, self.sums, self.squares, g))
                sums *= np.float32(0.9)
                sums += d
                squares *= np.float32(0.99)
                d *= d
                squares += d
                np.sqrt(squares, out=d)
                d += np.float32(1e-8 * unit)
                np.divide(sums, d, out=d)
                d *= np.float32(rate * unit / 10)
                w -= d
            self.windows += len(part)
        return total
