"""A linear-chain conditional random field over word shapes: training and Viterbi in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LABELS = ("O", "email", "ip", "card", "phone")
OTHER, LOWER, UPPER, DIGIT, AT, DOT, HYPHEN, PLUS, PAREN, SPACE = range(10)

CLASSES = np.full(128, OTHER, dtype=np.uint8)
CLASSES[[9, 10, 11, 12, 13, 32]] = SPACE
CLASSES[97:123], CLASSES[65:91], CLASSES[48:58] = LOWER, UPPER, DIGIT
for _char, _class in (("@", AT), (".", DOT), ("-", HYPHEN), ("+", PLUS), ("(", PAREN), (")", PAREN)):
    CLASSES[ord(_char)] = _class

# Upper ends of the buckets of each count.
LENGTHS = np.array([1, 2, 3, 5, 8, 12, 16, 20, 32])
DIGITS = np.array([0, 1, 2, 3, 4, 8, 12, 19])
FEW = np.array([0, 1, 2, 3])
#: How many values each shape feature has.
SIZES = (10, 9, 5, 2, 5, 5, 5, 2, 2, 2, 4, 4, 2)


def words_of(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in an array of code points, and the class of each point."""
    kinds = np.where(points < 128, CLASSES[np.minimum(points, 127)], LOWER)
    solid = np.concatenate([[False], kinds != SPACE, [False]])
    edge = np.diff(solid.astype(np.int8))
    return np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0], kinds


def shapes(starts: np.ndarray, ends: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """The shape features of words, one row each."""
    if not len(starts):
        return np.empty((0, len(SIZES)), dtype=np.int64)

    def count(kind: int) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(kinds == kind)])
        return total[ends] - total[starts]

    length = ends - starts
    digits, upper, lower = count(DIGIT), count(UPPER), count(LOWER)
    at, dots, hyphens, parens = count(AT), count(DOT), count(HYPHEN), count(PAREN)
    other = count(OTHER)
    edge = np.array([3, 0, 1, 2, 3, 3, 3, 3, 3, 3])
    first, last = kinds[starts], kinds[ends - 1]
    return np.stack(
        [
            np.searchsorted(LENGTHS, length),
            np.searchsorted(DIGITS, digits),
            np.searchsorted(FEW, upper),
            (lower > 0).astype(np.int64),
            np.searchsorted(FEW, at),
            np.searchsorted(FEW, dots),
            np.searchsorted(FEW, hyphens),
            (first == PLUS).astype(np.int64),
            (parens > 0).astype(np.int64),
            (other > 0).astype(np.int64),
            edge[first],
            edge[last],
            (digits + dots + hyphens + parens + (first == PLUS) == length).astype(np.int64),
        ],
        axis=1,
    )


@dataclass
class Field:
    """Weights of (neighbour -1, 0, +1) x feature x value x label, and of label pairs."""

    weights: np.ndarray
    moves: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum((0, *SIZES[:-1]))

    def table(self, rows: np.ndarray, place: int) -> np.ndarray:
        """Scores that shapes give to the labels of the word at ``place`` from them."""
        return self.weights[place][rows + self.starts].sum(axis=1)

    def emissions(self, rows: np.ndarray, breaks: np.ndarray) -> np.ndarray:
        """Label scores of words in order; ``breaks``: words that begin a text."""
        radix = np.concatenate([[1], np.cumprod(SIZES[:-1])])
        distinct, where = np.unique(rows @ radix, return_inverse=True)
        known = distinct[:, None] // radix % np.array(SIZES)
        before, own, after = (self.table(known, place) for place in range(3))
        scores = own[where]
        joined = ~breaks[1:]
        scores[1:][joined] += before[where[:-1][joined]]
        scores[:-1][joined] += after[where[1:][joined]]
        return scores

    def decode(self, scores: np.ndarray, breaks: np.ndarray) -> np.ndarray:
        """The best labels of words in order; before and after a text stands "O".

        A word that "O" suits best whatever stands beside it cuts its text into independent parts,
        so only the words between such words are searched, parts of like length together.
        """
        n, moves = len(scores), self.moves
        gain = scores - scores[:, :1]
        reach = (moves - moves[:, :1]).max(axis=0) + (moves - moves[:1, :]).max(axis=1)
        open_word = ((gain + reach)[:, 1:] > 0).any(axis=1)
        labels = np.zeros(n, dtype=np.int64)
        begin = open_word & (breaks | ~np.concatenate([[False], open_word[:-1]]))
        begins = np.nonzero(begin)[0]
        if not len(begins):
            return labels
        part = np.cumsum(begin)[open_word] - 1
        lengths = np.bincount(part)
        for length in np.unique(lengths):
            at = begins[lengths == length]
            labels[at[:, None] + np.arange(length)] = self._viterbi(scores, at, int(length))
        return labels

    def _viterbi(self, scores: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
        best = self.moves[0] + scores[at]
        back = np.zeros((length, len(at), len(LABELS)), dtype=np.int8)
        for step in range(1, length):
            ways = best[:, :, None] + self.moves
            back[step] = ways.argmax(axis=1)
            best = ways.max(axis=1) + scores[at + step]
        path = np.zeros((len(at), length), dtype=np.int64)
        path[:, -1] = (best + self.moves[:, 0]).argmax(axis=1)
        for step in range(length - 1, 0, -1):
            path[:, step - 1] = back[step][np.arange(len(at)), path[:, step]]
        return path


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(lines: list[tuple[np.ndarray, np.ndarray]], steps: int = 120, l2: float = 1e-3) -> Field:
    """Penalised maximum likelihood by Adam; ``lines``: (shape rows, labels) of each sentence."""
    count, longest, kinds = len(lines), max(len(y) for _, y in lines), len(LABELS)
    field = Field(np.zeros((3, sum(SIZES), kinds)), np.zeros((kinds, kinds)))
    cells = np.full((count, longest + 2, len(SIZES)), -1)
    gold = np.zeros((count, longest), dtype=np.int64)
    real = np.zeros((count, longest), dtype=bool)
    for i, (rows, y) in enumerate(lines):
        cells[i, 1 : len(y) + 1] = rows + field.starts
        gold[i, : len(y)], real[i, : len(y)] = y, True
    views = [cells[:, place : place + longest] for place in range(3)]
    masks = [(v[..., :1] >= 0) & real[..., None] for v in views]
    length = real.sum(axis=1)
    every = np.arange(count)
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (field.weights, field.moves)]
    for step in range(1, steps + 1):
        scores = sum(field.weights[p][views[p]].sum(axis=2) * masks[p] for p in range(3))
        moves = field.moves
        ahead = np.zeros((longest, count, kinds))
        ahead[0] = moves[0] + scores[:, 0]
        for t in range(1, longest):
            following = log_sum(ahead[t - 1][:, :, None] + moves, 1) + scores[:, t]
            ahead[t] = np.where(real[:, t, None], following, ahead[t - 1])
        total = log_sum(ahead[-1] + moves[:, 0], 1)
        behind = np.tile(moves[:, 0], (count, 1))
        error = np.zeros_like(scores)
        pull = np.zeros_like(moves)
        for t in range(longest - 1, -1, -1):
            at = real[:, t]
            share = np.exp(ahead[t] + behind - total[:, None])
            error[at, t] = share[at]
            if t:
                pair = ahead[t - 1][:, :, None] + moves + (scores[:, t] + behind)[:, None, :]
                pull += np.exp(pair - total[:, None, None])[at].sum(axis=0)
                behind = np.where(at[:, None], log_sum(moves + (scores[:, t] + behind)[:, None, :], 2), behind)
        pull[0] += error[:, 0].sum(axis=0)
        np.add.at(pull[:, 0], np.arange(kinds), error[every, length - 1].sum(axis=0))
        # Expected minus observed.
        error[np.nonzero(real)[0], np.nonzero(real)[1], gold[real]] -= 1
        np.add.at(pull, (0, gold[:, 0]), -1)
        np.add.at(pull, (gold[every, length - 1], 0), -1)
        inner = real[:, 1:]
        np.add.at(pull, (gold[:, :-1][inner], gold[:, 1:][inner]), -1)
        slope = np.zeros_like(field.weights)
        for p in range(3):
            used = masks[p][..., 0]
            index = views[p][used]
            for f in range(len(SIZES)):
                np.add.at(slope[p], index[:, f], error[used])
        for (mean, square), value, grad in zip(
            state, (field.weights, field.moves), (slope / count, pull / count)
        ):
            grad = grad + l2 * value
            mean += 0.1 * (grad - mean)
            square += 0.001 * (grad**2 - square)
            value -= 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return field
