"""A bidirectional window network over word ids, in numpy.

A token is predicted from the words on both sides of it: position-wise embeddings
are summed, passed through tanh, and a two-level softmax gives the class of the
token and the token within its class. The token itself is never part of its input.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, log2, prod, sqrt

import numpy as np

OFFSETS = (-2, -1, 1, 2)
WIDTH = 16
# The fewest ids, and the ids for the square root of a corpus's tokens.
LEAST_IDS = 4096
IDS_PER_ROOT = 1 / 4
# Tokens whose logits are held at a time: blocks that stay in the processor's cache.
BLOCK = 1024
# Logits within this bound need no shift before they are exponentiated in 32 bits.
SAFE = 60.0


@dataclass(frozen=True)
class Net:
    """The sizes of a network: its ids are in classes of equally many members."""

    classes: int = 64
    members: int = 64

    @staticmethod
    def of_ids(ids: int) -> "Net":
        bits = ids.bit_length() - 1
        return Net(1 << (bits + 1) // 2, 1 << bits // 2)

    @staticmethod
    def for_tokens(tokens: int) -> "Net":
        """The vocabulary grows with the square root of the corpus, in powers of two."""
        return Net.of_ids(1 << ceil(log2(max(LEAST_IDS, IDS_PER_ROOT * sqrt(tokens)))))

    @property
    def vocabulary(self) -> int:
        return self.classes * self.members

    @property
    def edge(self) -> int:
        """The id beyond either end of a text."""
        return self.vocabulary

    @property
    def shapes(self) -> dict[str, tuple[int, ...]]:
        return {
            "inputs": (len(OFFSETS), self.vocabulary + 1, WIDTH),
            "hidden": (WIDTH,),
            "classes": (self.classes, WIDTH),
            "class_bias": (self.classes,),
            "members": (self.classes, self.members, WIDTH),
            "member_bias": (self.classes, self.members),
        }

    @property
    def size(self) -> int:
        return sum(prod(s) for s in self.shapes.values())

    @property
    def minibatch(self) -> int:
        """Tokens of one step: about as many for each class in every network."""
        return 128 * self.classes


SMALL = Net()


def views(flat: np.ndarray, net: Net = SMALL) -> dict[str, np.ndarray]:
    """The named parameters inside one flat array."""
    out, at = {}, 0
    for name, shape in net.shapes.items():
        n = prod(shape)
        out[name] = flat[at : at + n].reshape(shape)
        at += n
    return out


def initial(counts: np.ndarray, seed: int = 5) -> np.ndarray:
    """Parameters that give the corpus frequencies of the ids before any training."""
    net = Net.of_ids(len(counts))
    flat = np.zeros(net.size, dtype=np.float32)
    p = views(flat, net)
    r = np.random.default_rng(seed)
    for name in ("inputs", "classes", "members"):
        p[name][...] = r.normal(0, 0.1, p[name].shape)
    share = (counts + 0.5).reshape(net.classes, net.members)
    p["class_bias"][...] = np.log(share.sum(axis=1) / share.sum())
    p["member_bias"][...] = np.log(share / share.sum(axis=1, keepdims=True))
    return flat


def contexts(ids: np.ndarray, bounds: np.ndarray, net: Net = SMALL, of: np.ndarray | None = None) -> np.ndarray:
    """For each token, or the tokens `of`, the ids at OFFSETS in its own text; `bounds` holds the texts' ends."""
    lengths = np.diff(np.concatenate(([0], bounds)))
    at = np.arange(len(ids)) if of is None else of
    start, end = np.repeat(bounds - lengths, lengths)[at], np.repeat(bounds, lengths)[at]
    out = np.empty((len(OFFSETS), len(at)), dtype=np.int32)
    for row, offset in enumerate(OFFSETS):
        there = at + offset
        out[row] = ids.take(there, mode="clip")
        out[row, (there < start) | (there >= end)] = net.edge
    return out


def _hidden(p: dict[str, np.ndarray], near: np.ndarray) -> np.ndarray:
    total = np.take(p["inputs"][0], near[0], axis=0, mode="clip")
    for row in range(1, len(OFFSETS)):
        total += np.take(p["inputs"][row], near[row], axis=0, mode="clip")
    total += p["hidden"]
    return np.tanh(total, out=total)


def _by_class(ids: np.ndarray, net: Net) -> tuple[np.ndarray, np.ndarray]:
    """The order of tokens by class, and where each class starts in that order (and the last ends)."""
    kinds = (ids // net.members).astype(np.uint16 if net.classes <= 1 << 16 else np.int64)
    order = np.argsort(kinds, kind="stable")
    return order, np.searchsorted(kinds[order], np.arange(net.classes + 1))


def _blocks(first: int, last: int):
    for a in range(first, last, BLOCK):
        yield a, min(a + BLOCK, last)


class _Softmax:
    """Softmax of one layer over hidden values, a block at a time in one piece of memory."""

    def __init__(self, net: Net):
        self.room = np.empty(BLOCK * max(net.classes, net.members), dtype=np.float32)
        self.ones = np.ones(max(BLOCK, net.classes, net.members), dtype=np.float32)

    @staticmethod
    def in_range(weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
        """Whether no logit can grow too large, as hidden values lie between -1 and 1."""
        return (np.abs(weights).sum(axis=-1) + np.abs(bias)).max(axis=-1) < SAFE

    def logits(self, h: np.ndarray, weights: np.ndarray, bias: np.ndarray, safe: bool) -> np.ndarray:
        z = self.room[: len(h) * len(weights)].reshape(len(h), len(weights))
        np.matmul(h, weights.T, out=z)
        z += bias
        if not safe:
            z -= z.max(axis=1, keepdims=True)
        return z

    def log_share(self, z: np.ndarray, of: np.ndarray | int) -> np.ndarray:
        """The log of the softmax of each row of logits, at one column."""
        own = z[np.arange(len(z)), of]
        np.exp(z, out=z)
        return own - np.log(z @ self.ones[: z.shape[1]])

    def error(self, z: np.ndarray, of: np.ndarray | int, n: int) -> np.ndarray:
        """The gradient of the loss by the logits, in their place; the loss is a mean over n tokens."""
        np.exp(z, out=z)
        z *= (1 / (n * (z @ self.ones[: z.shape[1]])))[:, None]
        z[np.arange(len(z)), of] -= np.float32(1 / n)
        return z


def log_probabilities(flat: np.ndarray, ids: np.ndarray, near: np.ndarray, net: Net = SMALL) -> np.ndarray:
    """Log-probability of each token given its neighbours."""
    p, soft = views(flat, net), _Softmax(net)
    wide = bool(soft.in_range(p["classes"], p["class_bias"]))
    safe = soft.in_range(p["members"], p["member_bias"])
    out = np.empty(len(ids))
    order, edges = _by_class(ids, net)
    for first, last in _blocks(0, len(ids)):
        rows = order[first:last]
        kinds, own = np.divmod(ids[rows], net.members)
        h = _hidden(p, near.take(rows, axis=1))
        logs = soft.log_share(soft.logits(h, p["classes"], p["class_bias"], wide), kinds)
        for c in range(kinds[0], kinds[-1] + 1):
            a, b = max(edges[c] - first, 0), min(edges[c + 1] - first, last - first)
            if a < b:
                z = soft.logits(h[a:b], p["members"][c], p["member_bias"][c], safe[c])
                logs[a:b] += soft.log_share(z, own[a:b])
        out[rows] = logs
    return out


class Learner:
    """Adagrad over minibatches, from given parameters; only the classes of a minibatch are updated."""

    def __init__(self, flat: np.ndarray, net: Net = SMALL, rate: float = 0.2):
        self.flat = flat.astype(np.float32).copy()
        self.net, self.rate = net, rate
        self.p = views(self.flat, net)
        self.seen = views(np.full_like(self.flat, 1e-4), net)
        self.soft = _Softmax(net)
        # memory of a minibatch: new large arrays at every step cost more than the sums in them
        self.rooms = np.empty((3, net.minibatch, WIDTH), dtype=np.float32)

    def gradient(self, ids: np.ndarray, near: np.ndarray) -> list[tuple[str, tuple, np.ndarray]]:
        """Of the mean loss, by parameter: (name, what part of it, gradient); elsewhere it is zero."""
        p, net, soft, n = self.p, self.net, self.soft, len(ids)
        order, edges = _by_class(ids, net)
        ids, near = ids[order], near.take(order, axis=1)
        kinds, own = np.divmod(ids, net.members)
        if n > self.rooms.shape[1]:
            self.rooms = np.empty((3, n, WIDTH), dtype=np.float32)
        h, back, by_id = self.rooms[:, :n]
        safe = bool(soft.in_range(p["classes"], p["class_bias"]))
        upper, upper_bias = np.zeros_like(p["classes"]), np.zeros_like(p["class_bias"])
        for a, b in _blocks(0, n):
            h[a:b] = _hidden(p, near[:, a:b])
            wrong = soft.error(soft.logits(h[a:b], p["classes"], p["class_bias"], safe), kinds[a:b], n)
            upper += wrong.T @ h[a:b]
            upper_bias += soft.ones[: b - a] @ wrong
            np.matmul(wrong, p["classes"], out=back[a:b])
        out = [("classes", (...,), upper), ("class_bias", (...,), upper_bias)]
        there = np.flatnonzero(np.diff(edges))
        safe = soft.in_range(p["members"][there], p["member_bias"][there])
        for c, within in zip(there, safe):
            weights, bias = p["members"][c], p["member_bias"][c]
            lower, lower_bias = 0, 0
            for a, b in _blocks(edges[c], edges[c + 1]):
                wrong = soft.error(soft.logits(h[a:b], weights, bias, within), own[a:b], n)
                lower = lower + wrong.T @ h[a:b]
                lower_bias = lower_bias + soft.ones[: b - a] @ wrong
                back[a:b] += wrong @ weights
            out += [("members", (c,), lower), ("member_bias", (c,), lower_bias)]
        h *= h
        back *= np.subtract(1, h, out=h)
        out.append(("hidden", (...,), back.sum(axis=0)))
        # sums for each place and id that occurs there
        for row in range(len(OFFSETS)):
            at = near[row].astype(np.uint16) if net.edge < 1 << 16 else near[row]
            order = np.argsort(at, kind="stable")
            at = at[order]
            first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
            np.take(back, order, axis=0, out=by_id, mode="clip")
            out.append(("inputs", (row, at[first]), np.add.reduceat(by_id, first, axis=0)))
        return out

    def step(self, ids: np.ndarray, near: np.ndarray) -> None:
        for name, part, g in self.gradient(ids, near):
            seen = self.seen[name][part]
            seen += g * g
            self.seen[name][part] = seen
            g *= self.rate
            g /= np.sqrt(seen)
            self.p[name][part] -= g
