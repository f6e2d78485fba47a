"""A linear-chain conditional random field over short sequences of dense feature vectors (numpy)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)


@dataclass
class Crf:
    """emit: (features, labels); step: (labels, labels); first: (labels,)."""

    emit: np.ndarray
    step: np.ndarray
    first: np.ndarray

    def viterbi(self, x: np.ndarray) -> list[int]:
        scores = x @ self.emit
        best = scores[0] + self.first
        back = []
        for row in scores[1:]:
            through = best[:, None] + self.step
            back.append(through.argmax(axis=0))
            best = through.max(axis=0) + row
        path = [int(best.argmax())]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        return path[::-1]

    def viterbi_all(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Best tags of many sequences at once; sequence i is x[first[i] : first[i + 1]]."""
        scores = x @ self.emit
        size = np.diff(first)
        order = np.argsort(-size, kind="stable")
        size, begin = size[order], first[:-1][order]
        out = np.zeros(len(x), np.int64)
        live = int((size > 0).sum())
        if not live:
            return out
        best = scores[begin[:live]] + self.first
        ways, ends = [], []
        for step in range(1, int(size[0])):
            m = int(np.searchsorted(-size, -step, side="left"))  # sequences longer than step
            ends.append(best[m:])
            through = best[:m, :, None] + self.step
            ways.append(through.argmax(axis=1))
            best = through.max(axis=1) + scores[begin[:m] + step]
        ends.append(best)
        final = np.concatenate(ends[::-1]).argmax(axis=1)
        for step in range(int(size[0]) - 1, -1, -1):
            m = int(np.searchsorted(-size, -step, side="left"))
            out[begin[:m] + step] = final[:m]
            if step:
                final[:m] = np.take_along_axis(ways[step - 1], final[:m, None], axis=1)[:, 0]
        return out


def fit(xs: list[np.ndarray], ys: list[list[int]], labels: int, rounds: int = 60, rate: float = 0.2, decay: float = 1e-3) -> Crf:
    """Maximum likelihood by Adam over all sequences, longest first, so that each step of the recursions sees only those that reach it; deterministic."""
    order = sorted(range(len(xs)), key=lambda i: -len(ys[i]))
    xs, ys = [xs[i] for i in order], [ys[i] for i in order]
    size = np.array([len(y) for y in ys])
    n, t, f = len(xs), int(size[0]), xs[0].shape[1]
    live = [int((size > k).sum()) for k in range(t)]
    # rows step by step: all first clauses, then all second ones
    begin = np.concatenate(([0], np.cumsum(live)))
    x = np.concatenate([np.stack([xs[i][k] for i in range(live[k])]) for k in range(t)])
    y = np.concatenate([np.array([ys[i][k] for i in range(live[k])]) for k in range(t)])
    hot = np.eye(labels)[y]
    seen = np.zeros((labels, labels))
    for k in range(1, t):
        np.add.at(seen, (y[begin[k - 1] : begin[k - 1] + live[k]], y[begin[k] : begin[k + 1]]), 1)
    w = [np.zeros((f, labels)), np.zeros((labels, labels)), np.zeros(labels)]
    m1 = [np.zeros_like(p) for p in w]
    m2 = [np.zeros_like(p) for p in w]
    for r in range(1, rounds + 1):
        scores = x @ w[0]
        at = [scores[begin[k] : begin[k + 1]] for k in range(t)]
        alpha = [at[0] + w[2]]
        for k in range(1, t):
            alpha.append(_logsumexp(alpha[k - 1][: live[k], :, None] + w[1], 1) + at[k])
        beta = [np.zeros((live[k], labels)) for k in range(t)]
        for k in range(t - 2, -1, -1):
            beta[k][: live[k + 1]] = _logsumexp((beta[k + 1] + at[k + 1])[:, None, :] + w[1], 2)
        z = _logsumexp(alpha[0] + beta[0], 1)
        node = np.concatenate([np.exp(alpha[k] + beta[k] - z[: live[k], None]) for k in range(t)])
        off = hot - node
        grad = [x.T @ off, seen.copy(), off[:n].sum(0)]
        for k in range(1, t):
            m = live[k]
            grad[1] -= np.exp(alpha[k - 1][:m, :, None] + w[1] + (at[k] + beta[k])[:, None, :] - z[:m, None, None]).sum(0)
        for i in range(3):
            g = grad[i] / n - decay * w[i]
            m1[i] = 0.9 * m1[i] + 0.1 * g
            m2[i] = 0.999 * m2[i] + 0.001 * g * g
            w[i] = w[i] + rate * (m1[i] / (1 - 0.9**r)) / (np.sqrt(m2[i] / (1 - 0.999**r)) + 1e-8)
    return Crf(*w)
