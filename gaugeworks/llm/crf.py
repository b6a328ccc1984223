"""A linear-chain conditional random field with two labels, in numpy.

Sequences lie one after another; `bounds` holds their ends. All sequences step
together, the longest first, so a step is one array operation.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Chain:
    """Weights of the features for label 1, and of the label pairs."""

    weights: np.ndarray
    moves: np.ndarray  # 2 x 2

    def viterbi(self, x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The likeliest labels of each sequence."""
        steps = _Steps(bounds)
        score = np.stack([np.zeros(len(x)), x @ self.weights], axis=1)
        best = np.zeros((len(x), 2))
        came = np.zeros((len(x), 2), dtype=np.int64)
        labels = np.zeros(len(x), dtype=np.int64)
        for t, at in steps:
            if t == 0:
                best[at] = score[at]
                continue
            total = best[at - 1][:, :, None] + self.moves
            came[at] = total.argmax(axis=1)
            best[at] = total.max(axis=1) + score[at]
        labels[steps.last] = best[steps.last].argmax(axis=1)
        for t, at in reversed(list(steps)):
            if t:
                labels[at - 1] = came[at, labels[at]]
        return labels


class _Steps:
    """For each step t the rows that are t-th in their sequence."""

    def __init__(self, bounds: np.ndarray):
        starts = np.concatenate(([0], bounds[:-1]))
        lengths = bounds - starts
        order = np.argsort(-lengths, kind="stable")
        self.starts, self.lengths = starts[order], lengths[order]
        self.last = (starts + lengths - 1)[lengths > 0]

    def __iter__(self):
        for t in range(int(self.lengths[0]) if len(self.lengths) else 0):
            yield t, self.starts[: np.searchsorted(-self.lengths, -t, side="left")] + t


def _logsumexp(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))


def fit(x: np.ndarray, labels: np.ndarray, bounds: np.ndarray, rounds: int = 120, rate: float = 0.15, l2: float = 1e-4) -> Chain:
    """Maximise the mean conditional log-likelihood of the label sequences (Adam)."""
    n, width = x.shape
    weights, moves = np.zeros(width), np.zeros((2, 2))
    if n == 0:
        return Chain(weights, moves)
    steps = list(_Steps(bounds))
    last = _Steps(bounds).last
    follow = np.ones(n, dtype=bool)  # rows that have a row before them in their sequence
    follow[np.concatenate(([0], bounds[:-1]))[np.diff(np.concatenate(([0], bounds))) > 0]] = False
    after = np.flatnonzero(follow)
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[after - 1], labels[after]), 1)
    want = x.T @ labels
    state = [np.zeros(width + 4), np.zeros(width + 4)]
    for r in range(1, rounds + 1):
        score = np.stack([np.zeros(n), x @ weights], axis=1)
        alpha, beta = np.zeros((n, 2)), np.zeros((n, 2))
        for t, at in steps:
            alpha[at] = score[at] if t == 0 else score[at] + _logsumexp(alpha[at - 1][:, :, None] + moves, 1)
        for t, at in reversed(steps):
            if t:
                beta[at - 1] = _logsumexp(moves + (beta[at] + score[at])[:, None, :], 2)
        norm = _logsumexp(alpha + beta, 1)
        p = np.exp(alpha + beta - norm[:, None])[:, 1]
        pair = alpha[after - 1][:, :, None] + moves + (score[after] + beta[after])[:, None, :]
        expected = np.exp(pair - norm[after][:, None, None]).sum(axis=0)
        grad = np.concatenate([(want - x.T @ p), (seen - expected).ravel()]) / n
        grad -= l2 * np.concatenate([weights, moves.ravel()])
        state[0] = 0.9 * state[0] + 0.1 * grad
        state[1] = 0.99 * state[1] + 0.01 * grad**2
        step = rate * (state[0] / (1 - 0.9**r)) / (np.sqrt(state[1] / (1 - 0.99**r)) + 1e-8)
        weights = weights + step[:width]
        moves = moves + step[width:].reshape(2, 2)
    return Chain(weights, moves)
