"""A linear-chain conditional random field in numpy, over batches of padded sequences."""

from __future__ import annotations

import numpy as np


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def marginals(emit: np.ndarray, lengths: np.ndarray, trans: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log Z, label marginals, expected transitions) of scores emit[batch, time, label]; forward-backward."""
    b, t, k = emit.shape
    alpha, beta = np.empty_like(emit), np.zeros_like(emit)
    alpha[:, 0] = emit[:, 0] + start
    for i in range(1, t):
        step = _logsumexp(alpha[:, i - 1, :, None] + trans, 1) + emit[:, i]
        alpha[:, i] = np.where((i < lengths)[:, None], step, alpha[:, i - 1])
    for i in range(t - 2, -1, -1):
        step = _logsumexp(trans + (emit[:, i + 1] + beta[:, i + 1])[:, None, :], 2)
        beta[:, i] = np.where((i + 1 < lengths)[:, None], step, 0)
    logz = _logsumexp(alpha[:, -1], 1)
    inside = (np.arange(t) < lengths[:, None])[:, :, None]
    single = np.where(inside, np.exp(np.minimum(alpha + beta - logz[:, None, None], 0)), 0)
    if t == 1:
        return logz, single, np.zeros((k, k))
    pair = alpha[:, :-1, :, None] + trans + (emit[:, 1:] + beta[:, 1:])[:, :, None, :] - logz[:, None, None, None]
    pair = np.where(inside[:, 1:, :, None], np.exp(np.minimum(pair, 0)), 0)
    return logz, single, pair.sum((0, 1))


def viterbi(emit: np.ndarray, lengths: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Labels of the best sequences, [batch, time]; beyond a sequence's end they mean nothing."""
    b, t, k = emit.shape
    back = np.zeros((b, t, k), np.int64)
    score = emit[:, 0] + start
    for i in range(1, t):
        cand = score[:, :, None] + trans
        back[:, i] = cand.argmax(1)
        go = (i < lengths)[:, None]
        back[:, i] = np.where(go, back[:, i], np.arange(k))
        score = np.where(go, cand.max(1) + emit[:, i], score)
    out = np.empty((b, t), np.int64)
    out[:, -1] = score.argmax(1)
    for i in range(t - 1, 0, -1):
        out[:, i - 1] = back[np.arange(b), i, out[:, i]]
    return out


def padded(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sequences of rows as one array, zero-filled, and their lengths."""
    lengths = np.array([len(p) for p in parts])
    out = np.zeros((len(parts), max(1, lengths.max(initial=1)), *parts[0].shape[1:]), parts[0].dtype)
    out[np.arange(out.shape[1]) < lengths[:, None]] = np.concatenate(parts)
    return out, lengths


class Model:
    """Label scores are linear in features: emit = features @ weights."""

    def __init__(self, n_features: int, n_labels: int) -> None:
        self.w, self.trans, self.start = np.zeros((n_features, n_labels)), np.zeros((n_labels, n_labels)), np.zeros(n_labels)

    def fit(self, batches: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], epochs: int, rate: float, decay: float) -> Model:
        """Maximum likelihood with an L2 penalty, by Adam. A batch: features [b, t, f], labels [b, t], lengths, weights [b]."""
        params = [self.w, self.trans, self.start]
        m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        k = self.w.shape[1]
        for _ in range(epochs):
            for x, y, lengths, weight in batches:
                step += 1
                inside = (np.arange(x.shape[1]) < lengths[:, None]) * weight[:, None]
                _, single, pair = marginals(x @ self.w, lengths, self.trans, self.start)
                gold = np.eye(k)[y]
                diff = (single - gold) * inside[:, :, None]
                if np.ptp(weight):  # expected transitions by sequence weight
                    pair = sum(marginals((x @ self.w)[weight == u], lengths[weight == u], self.trans, self.start)[2] * u for u in np.unique(weight))
                else:
                    pair = pair * weight[0]
                gold_pair = np.einsum("btk,btl,bt->kl", gold[:, :-1], gold[:, 1:], inside[:, 1:])
                n = weight.sum()
                grads = [np.einsum("btf,btk->fk", x, diff) / n + decay * self.w, (pair - gold_pair) / n + decay * self.trans, diff[:, 0].sum(0) / n]
                for i, (p, g) in enumerate(zip(params, grads, strict=True)):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    p -= rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        return self
