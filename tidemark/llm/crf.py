"""Linear-chain conditional random fields over many chains at once, with numpy.

Chains lie one after another in flat arrays (`first`: where each begins, one entry more). Forward, backward and Viterbi
go place by place over all chains that are long enough, longest first, so the work of a step is one small matrix product
whatever the number of chains. Sums are kept as probabilities scaled to one at every place, so long chains neither
overflow nor vanish.
"""

from __future__ import annotations

import numpy as np


class Steps:
    """For every place the rows of the chains that reach it: chains sorted by length, longest first."""

    def __init__(self, first: np.ndarray):
        length = np.diff(first)
        order = np.argsort(-length, kind="stable")
        self.begin = first[:-1][order]
        length = length[order]
        self.longest = int(length[0]) if len(length) else 0
        self.active = np.searchsorted(-length, -np.arange(self.longest), "left") if self.longest else np.zeros(0, np.int64)

    def rows(self, t: int) -> np.ndarray:
        return self.begin[: self.active[t]] + t


def _potentials(emission: np.ndarray) -> np.ndarray:
    return np.exp(emission - emission.max(axis=1, keepdims=True))


def marginals(emission: np.ndarray, first: np.ndarray, transition: np.ndarray, start: np.ndarray, pairs: bool = False):
    """Posterior label probabilities of every place (forward-backward), and with `pairs` the expected transitions."""
    steps = Steps(first)
    e = _potentials(emission)
    move, alpha = np.exp(transition), np.empty_like(e)
    held = None
    for t in range(steps.longest):
        rows = steps.rows(t)
        now = e[rows] * (np.exp(start) if t == 0 else held[: len(rows)] @ move)
        now /= now.sum(axis=1, keepdims=True)
        alpha[rows] = held = now
    beta = np.ones_like(e)
    expected = np.zeros_like(move)
    for t in range(steps.longest - 1, 0, -1):
        rows = steps.rows(t)
        ahead = e[rows] * beta[rows]
        back = ahead @ move.T
        back /= back.sum(axis=1, keepdims=True)
        if pairs:
            before = alpha[rows - 1]
            total = ((before @ move) * ahead).sum(axis=1)
            expected += move * ((before / total[:, None]).T @ ahead)
        beta[rows - 1] = back
    gamma = alpha * beta
    gamma /= gamma.sum(axis=1, keepdims=True)
    return (gamma, expected) if pairs else gamma


#: How much more than the bound a place must speak for label 0, so that rounding decides nothing.
SLACK = 1e-6


def settled(emission: np.ndarray, first: np.ndarray, transition: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Places that have label 0 in every best sequence, whatever the other places have: their emissions speak for it by more
    than any label's best way there and on can gain. Places that are not marked may have it too."""
    with np.errstate(invalid="ignore"):  # what is not a number settles nothing
        came = np.maximum((transition - transition[:, :1]).max(axis=0), start - start[0])
        # What label k at a place may gain over label l by what follows.
        on = (transition[:, None, :] - transition[None, :, :]).max(axis=2)
        e = np.ascontiguousarray(emission.T)
        sure = np.ones(len(emission), dtype=bool)
        last = first[1:][np.diff(first) > 0] - 1
        for k in range(1, len(e)):
            # The same over label 0, now with the emissions of the next place: its best label against the best known reply.
            gain = np.zeros(len(emission))
            gain[:-1] = -np.inf
            for j, ahead in enumerate(e):
                least = np.full(max(len(emission) - 1, 0), transition[k, j] - transition[0, j])
                for i, reply in enumerate(e):
                    if i != j:
                        np.minimum(least, ahead[1:] - reply[1:] + (transition[k, j] - transition[0, i] + on[j, i]), out=least)
                np.maximum(gain[:-1], least, out=gain[:-1])
            gain[last] = 0
            sure &= e[0] - e[k] > gain + came[k] + SLACK
    return sure


def viterbi(emission: np.ndarray, first: np.ndarray, transition: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The best label sequence of every chain. Settled places part the chains, so only stretches between them are gone through."""
    sure = settled(emission, first, transition, start)
    begins = np.zeros(len(emission), dtype=bool)
    begins[first[:-1][np.diff(first) > 0]] = True
    taken = ~sure  # and the neighbours in their chain, which hold a stretch at both ends
    taken[:-1] |= ~sure[1:] & ~begins[1:]
    taken[1:] |= ~sure[:-1] & ~begins[1:]
    at = np.flatnonzero(taken)
    own = emission[at]
    own[sure[at], 1:] = -np.inf
    heads = begins[at] | (np.diff(at, prepend=-2) > 1)
    best = np.zeros(len(emission), dtype=np.int8)
    best[at] = _decoded(own, np.append(np.flatnonzero(heads), len(at)), transition, start)
    return best


def _decoded(emission: np.ndarray, first: np.ndarray, transition: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The best label sequence of every chain, place by place."""
    steps = Steps(first)
    best = np.zeros(len(emission), dtype=np.int8)
    came = np.zeros(emission.shape, dtype=np.int8)
    labels = emission.shape[1]
    held = None
    ends = np.zeros((len(first) - 1, labels))
    for t in range(steps.longest):
        rows = steps.rows(t)
        if t == 0:
            held = emission[rows] + start
        else:
            n = len(rows)
            if len(held) > n:
                ends[n : len(held)] = held[n:]
            options = held[:n, :, None] + transition
            came[rows] = options.argmax(axis=1)
            held = options.max(axis=1) + emission[rows]
            held -= held.max(axis=1, keepdims=True)
    if held is not None:
        ends[: len(held)] = held
    label = ends.argmax(axis=1).astype(np.int8)
    for t in range(steps.longest - 1, -1, -1):
        rows = steps.rows(t)
        n = len(rows)
        best[rows] = label[:n]
        if t:
            label[:n] = came[rows, label[:n]]
    return best


#: Rows and places that are worked on at once while fitting, so that its memory is that of its input and little more.
BLOCK = 1 << 16


def _blocks(first: np.ndarray) -> list[tuple[int, int]]:
    """Neighbouring chains of about BLOCK places together (one chain at least)."""
    cuts, at = [], 0
    while at < len(first) - 1:
        stop = max(at + 1, int(np.searchsorted(first, first[at] + BLOCK, "right")) - 1)
        cuts.append((at, stop))
        at = stop
    return cuts


class Model:
    """Weights of hashed features, transitions and starts, fitted by gradient steps scaled per weight (Adagrad)."""

    def __init__(self, features: int, labels: int):
        self.weights = np.zeros((features, labels), dtype=np.float32)
        self.transition = np.zeros((labels, labels))
        self.start = np.zeros(labels)

    def emissions(self, feature: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Sums of weights; row i has the features edges[i]..edges[i+1]-1 (one at least)."""
        out = np.empty((len(edges) - 1, self.weights.shape[1]))
        for lo in range(0, len(out), BLOCK):
            own = edges[lo : lo + BLOCK + 1]
            out[lo : lo + BLOCK] = np.add.reduceat(self.weights[feature[own[0] : own[-1]]], own[:-1] - own[0], axis=0)
        return out

    def _errors(self, emission: np.ndarray, row: np.ndarray, first: np.ndarray, gold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What the labels `gold` have beyond the model's probabilities at every place, and the expected transitions."""
        wrong, expected = np.zeros((len(gold), self.weights.shape[1])), np.zeros_like(self.transition)
        for a, b in _blocks(first):
            lo, hi = first[a], first[b]
            gamma, moves = marginals(emission[row[lo:hi]], first[a : b + 1] - lo, self.transition, self.start, pairs=True)
            wrong[lo:hi] = -gamma
            expected += moves
        wrong[np.arange(len(gold)), gold] += 1
        return wrong, expected

    def _by_feature(self, feature: np.ndarray, edges: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Sums over the rows that have a feature."""
        total = np.zeros(len(self.weights))
        for lo in range(0, len(value), BLOCK):
            own = edges[lo : lo + BLOCK + 1]
            total += np.bincount(feature[own[0] : own[-1]], np.repeat(value[lo : lo + BLOCK], np.diff(own)), minlength=len(total))
        return total

    def fit(self, feature: np.ndarray, edges: np.ndarray, row: np.ndarray, first: np.ndarray, gold: np.ndarray, rounds: int = 30, rate: float = 0.5, decay: float = 1e-4) -> None:
        """Maximise the likelihood of the labels `gold`. row: which feature row each place has."""
        labels = self.weights.shape[1]
        inside = np.ones(len(gold), dtype=bool)
        inside[first[:-1][first[:-1] < len(gold)]] = False
        at = np.flatnonzero(inside)
        seen = np.zeros_like(self.transition)
        np.add.at(seen, (gold[at - 1], gold[at]), 1)
        begins = first[:-1][np.diff(first) > 0]
        square = [np.full(x.shape, 1e-8) for x in (self.weights, self.transition, self.start)]
        scale = max(1, len(gold))
        for _ in range(rounds):
            wrong, expected = self._errors(self.emissions(feature, edges), row, first, gold)
            spread = (np.bincount(row, wrong[:, k], minlength=len(edges) - 1) for k in range(labels))
            grads = [
                np.stack([self._by_feature(feature, edges, x) for x in spread], axis=1) / scale - decay / scale * self.weights,
                (seen - expected) / scale, wrong[begins].sum(axis=0) / scale]
            for value, grad, total in zip((self.weights, self.transition, self.start), grads, square):
                total += grad * grad
                value += (rate * grad / np.sqrt(total)).astype(value.dtype)
