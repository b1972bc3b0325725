"""A small linear-chain conditional random field in numpy."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np

#: Token places that one decoded batch holds at most (one longer sequence alone).
BATCH_CELLS = 1 << 18


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Crf:
    """Scores are sums of feature weights per label and of label transitions.
    Features are strings; those not seen in training weigh nothing."""

    def __init__(self, labels: Sequence[str], number: dict[str, int], emit: np.ndarray, move: np.ndarray,
                 begin: np.ndarray):
        self.labels, self.number, self.emit, self.move, self.begin = list(labels), number, emit, move, begin

    @classmethod
    def train(cls, tokens: list[list[list[str]]], tags: list[list[str]], labels: Sequence[str], *,
              steps: int = 250, rate: float = 0.15, ridge: float = 0.01) -> Crf:
        """Maximum likelihood with a ridge, by Adam over the whole table."""
        number = {"": 0}
        for sentence in tokens:
            for features in sentence:
                for f in features:
                    number.setdefault(f, len(number))
        at = {x: i for i, x in enumerate(labels)}
        n, k = len(number), len(labels)
        rows = [_ids(s, number) for s in tokens]
        gold = [np.array([at[t] for t in s]) for s in tags]
        seen = [np.zeros((n, k)), np.zeros((k, k)), np.zeros(k)]
        for ids, y in zip(rows, gold, strict=True):
            np.add.at(seen[0], (ids, y[:, None]), 1)
            np.add.at(seen[1], (y[:-1], y[1:]), 1)
            seen[2][y[0]] += 1
        w = [np.zeros((n, k)), np.zeros((k, k)), np.zeros(k)]
        m, v = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
        for step in range(1, steps + 1):
            expected = [np.zeros_like(x) for x in w]
            for ids in rows:
                e = w[0][ids].sum(axis=1)
                t = len(e)
                a, b = np.zeros((t, k)), np.zeros((t, k))
                a[0] = w[2] + e[0]
                for i in range(1, t):
                    a[i] = _logsum(a[i - 1][:, None] + w[1], 0) + e[i]
                for i in range(t - 2, -1, -1):
                    b[i] = _logsum(w[1] + (e[i + 1] + b[i + 1])[None, :], 1)
                z = _logsum(a[-1], 0)
                p = np.exp(a + b - z)
                np.add.at(expected[0], ids, p[:, None, :])
                for i in range(1, t):
                    expected[1] += np.exp(a[i - 1][:, None] + w[1] + (e[i] + b[i])[None, :] - z)
                expected[2] += p[0]
            for j in range(3):
                g = expected[j] - seen[j] + ridge * w[j]
                m[j] = 0.9 * m[j] + 0.1 * g
                v[j] = 0.99 * v[j] + 0.01 * g * g
                w[j] = w[j] - rate * (m[j] / (1 - 0.9 ** step)) / (np.sqrt(v[j] / (1 - 0.99 ** step)) + 1e-8)
        w[0][0] = 0
        return cls(labels, number, *w)

    def decode(self, tokens: list[list[list[str]]]) -> list[list[str]]:
        """Best labels of each sequence, by Viterbi over batches of like length."""
        out: list[list[str]] = [[] for _ in tokens]
        order = sorted((i for i in range(len(tokens)) if tokens[i]), key=lambda i: len(tokens[i]))
        while order:
            batch = [order.pop()]
            longest = len(tokens[batch[0]])
            while order and (len(batch) + 1) * longest <= BATCH_CELLS and 2 * len(tokens[order[-1]]) >= longest:
                batch.append(order.pop())
            for i, best in zip(batch, self._viterbi([tokens[i] for i in batch]), strict=True):
                out[i] = [self.labels[x] for x in best]
        return out

    def decode_slices(self, slices: Iterable[list[list[str]]]) -> np.ndarray:
        """Best labels (their numbers) of one long sequence that comes in
        slices: the scores are carried over, and a byte per place and label is
        kept to find the way back."""
        own, backs = None, []
        for tokens in slices:
            scores = self.emit[_ids(tokens, self.number)].sum(axis=1)
            back = np.zeros(scores.shape, dtype=np.int8)
            for i, e in enumerate(scores):
                if own is None:
                    own = self.begin + e
                else:
                    step = own[:, None] + self.move
                    back[i] = step.argmax(axis=0)
                    own = step.max(axis=0) + e
            backs.append(back)
        path = np.zeros(sum(map(len, backs)), dtype=np.int8)
        place, at = len(path), 0 if own is None else int(own.argmax())
        for back in reversed(backs):
            for row in back[::-1]:
                place -= 1
                path[place] = at
                at = row[at]
        return path

    def _viterbi(self, tokens: list[list[list[str]]]) -> list[list[int]]:
        n, t, k = len(tokens), max(map(len, tokens)), len(self.labels)
        scores = np.zeros((n, t, k))
        for i, sentence in enumerate(tokens):
            scores[i, : len(sentence)] = self.emit[_ids(sentence, self.number)].sum(axis=1)
        length = np.array([len(s) for s in tokens])
        back = np.zeros((t, n, k), dtype=np.int8)
        own = self.begin + scores[:, 0]
        for i in range(1, t):
            step = own[:, :, None] + self.move
            back[i] = step.argmax(axis=1)
            new = step.max(axis=1) + scores[:, i]
            live = length > i  # an ended sequence keeps its scores and its place
            own = np.where(live[:, None], new, own)
            back[i][~live] = np.arange(k)
        at = own.argmax(axis=1)
        path = np.zeros((n, t), dtype=np.int64)
        for i in range(t - 1, -1, -1):
            path[:, i] = at
            at = back[i][np.arange(n), at]
        return [path[i, : length[i]].tolist() for i in range(n)]


def _ids(sentence: list[list[str]], number: dict[str, int]) -> np.ndarray:
    width = max(map(len, sentence))
    return np.array([[number.get(f, 0) for f in features] + [0] * (width - len(features)) for features in sentence])
