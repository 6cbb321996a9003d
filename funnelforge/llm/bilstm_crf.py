"""A character-level bidirectional LSTM with a CRF on top, in numpy.

Sequences have one fixed length. Training minimises the CRF's negative log-likelihood with Adam by
back-propagation through time; decoding is Viterbi over emissions and transitions.
"""

from __future__ import annotations

import numpy as np


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logsumexp(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    def __init__(self, symbols: int, tags: int, width: int = 8, hidden: int = 16, seed: int = 7):
        r = np.random.Generator(np.random.PCG64(seed))
        self.hidden = hidden
        draw = lambda *shape: (r.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {"embed": draw(symbols, width), "out": draw(2 * hidden, tags), "bias": np.zeros(tags, np.float32),
                  "trans": np.zeros((tags, tags), np.float32), "first": np.zeros(tags, np.float32), "last": np.zeros(tags, np.float32)}
        for side in "fb":
            self.p[f"w{side}"] = draw(width + hidden, 4 * hidden)
            b = np.zeros(4 * hidden, np.float32)
            b[hidden : 2 * hidden] = 1  # remember by default
            self.p[f"b{side}"] = b

    def _lstm(self, x, side, keep):
        """Hidden states of one direction; x is [time, batch, width]."""
        w, b, n = self.p[f"w{side}"], self.p[f"b{side}"], self.hidden
        steps = range(len(x)) if side == "f" else range(len(x) - 1, -1, -1)
        h = c = np.zeros((x.shape[1], n), np.float32)
        into = x.reshape(-1, x.shape[2]) @ w[: x.shape[2]] + b
        into = into.reshape(len(x), x.shape[1], 4 * n)
        out, trace = np.empty((len(x), x.shape[1], n), np.float32), []
        for t in steps:
            z = into[t] + h @ w[x.shape[2] :]
            gates = _sigmoid(z[:, : 3 * n])
            i, f, o, g = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :], np.tanh(z[:, 3 * n :])
            before, held = c, h
            c = f * before + i * g
            tc = np.tanh(c)
            h = out[t] = o * tc
            if keep:
                trace.append((t, i, f, o, g, before, held, tc))
        return out, trace

    def _lstm_back(self, x, side, trace, dout, grads):
        w, n, width = self.p[f"w{side}"], self.hidden, x.shape[2]
        dx = np.zeros_like(x)
        dh = dc = np.zeros((x.shape[1], n), np.float32)
        dw, db = np.zeros_like(w), np.zeros_like(self.p[f"b{side}"])
        for t, i, f, o, g, before, held, tc in reversed(trace):
            dh = dh + dout[t]
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
            dw[:width] += x[t].T @ dz
            dw[width:] += held.T @ dz
            db += dz.sum(0)
            dx[t] += dz @ w[:width].T
            dh, dc = dz @ w[width:].T, dc * f
        grads[f"w{side}"], grads[f"b{side}"] = dw, db
        return dx

    def emissions(self, symbols: np.ndarray) -> np.ndarray:
        """[time, batch, tags] from symbols [batch, time]."""
        x = self.p["embed"][symbols.T]
        h = np.concatenate([self._lstm(x, s, False)[0] for s in "fb"], axis=2)
        return h @ self.p["out"] + self.p["bias"]

    def loss(self, symbols: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        """Mean negative log-likelihood of the tags [batch, time], and its gradients."""
        p, grads = self.p, {}
        x = p["embed"][symbols.T]
        forward, tf = self._lstm(x, "f", True)
        backward, tb = self._lstm(x, "b", True)
        h = np.concatenate([forward, backward], axis=2)
        e = (h @ p["out"] + p["bias"]).astype(np.float64)
        n, y, size = len(e), tags.T, len(tags)
        alpha, beta = np.empty_like(e), np.empty_like(e)
        alpha[0] = p["first"] + e[0]
        for t in range(1, n):
            alpha[t] = _logsumexp(alpha[t - 1][:, :, None] + p["trans"][None], 1) + e[t]
        beta[-1] = p["last"]
        for t in range(n - 2, -1, -1):
            beta[t] = _logsumexp(p["trans"][None] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        z = _logsumexp(alpha[-1] + p["last"], 1)
        who = np.arange(size)
        gold = p["first"][y[0]] + e[0, who, y[0]] + p["last"][y[-1]]
        dtrans = np.zeros_like(p["trans"], dtype=np.float64)
        for t in range(1, n):
            gold = gold + p["trans"][y[t - 1], y[t]] + e[t, who, y[t]]
            both = alpha[t - 1][:, :, None] + p["trans"][None] + (e[t] + beta[t])[:, None, :] - z[:, None, None]
            dtrans += np.exp(both).sum(0)
            np.subtract.at(dtrans, (y[t - 1], y[t]), 1)
        de = np.exp(alpha + beta - z[None, :, None])
        grads["first"], grads["last"] = de[0].sum(0), de[-1].sum(0)
        np.subtract.at(grads["first"], y[0], 1)
        np.subtract.at(grads["last"], y[-1], 1)
        de[np.arange(n)[:, None], who[None, :], y] -= 1
        de = de.astype(np.float32)
        grads["trans"], grads["bias"] = dtrans, de.sum((0, 1))
        grads["out"] = h.reshape(-1, h.shape[2]).T @ de.reshape(-1, de.shape[2])
        dh = de @ p["out"].T
        dx = self._lstm_back(x, "f", tf, dh[:, :, : self.hidden], grads) + self._lstm_back(x, "b", tb, dh[:, :, self.hidden :], grads)
        grads["embed"] = np.zeros_like(p["embed"])
        np.add.at(grads["embed"], symbols.T, dx)
        return float((z - gold).mean()), {k: (g / size).astype(np.float32) for k, g in grads.items()}

    def train(self, symbols: np.ndarray, tags: np.ndarray, epochs: int = 10, batch: int = 32, rate: float = 0.02, seed: int = 7) -> None:
        r = np.random.Generator(np.random.PCG64(seed))
        one = {k: np.zeros_like(v) for k, v in self.p.items()}
        two = {k: np.zeros_like(v) for k, v in self.p.items()}
        t, total = 0, epochs * -(-len(symbols) // batch)
        for _ in range(epochs):
            order = r.permutation(len(symbols))
            for at in range(0, len(order), batch):
                some = order[at : at + batch]
                _, grads = self.loss(symbols[some], tags[some])
                t += 1
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                step = rate * (1 - 0.9 * t / total) * min(1.0, 5.0 / (norm + 1e-9))
                for k, g in grads.items():
                    one[k] = 0.9 * one[k] + 0.1 * g
                    two[k] = 0.999 * two[k] + 0.001 * g * g
                    self.p[k] -= (step * (one[k] / (1 - 0.9**t)) / (np.sqrt(two[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)

    def decode(self, symbols: np.ndarray) -> np.ndarray:
        """The best tags [batch, time]."""
        return np.stack([self.viterbi(e) for e in self.emissions(symbols).transpose(1, 0, 2)])

    def viterbi(self, e: np.ndarray) -> np.ndarray:
        """The best tags of one sequence of any length from its emissions [time, tags]."""
        trans, score = self.p["trans"], self.p["first"] + e[0]
        back = np.empty(e.shape, dtype=np.int64)
        for t in range(1, len(e)):
            every = score[:, None] + trans
            back[t] = every.argmax(0)
            score = every.max(0) + e[t]
        out = np.empty(len(e), dtype=np.int64)
        out[-1] = best = int((score + self.p["last"]).argmax())
        for t in range(len(e) - 1, 0, -1):
            out[t - 1] = best = back[t, best]
        return out
