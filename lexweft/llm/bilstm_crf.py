"""A character-level bidirectional LSTM with CRF transitions, in numpy: training by back-propagation, decoding by Viterbi."""

from __future__ import annotations

import numpy as np

#: Character classes: printable ASCII by itself, other letters, other characters, and padding.
CLASSES = 98


def classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    out = np.where((points >= 32) & (points < 127), points - 32, 96).astype(np.int64)
    for i in np.flatnonzero(points >= 127):
        out[i] = 95 if text[i].isalpha() else 96
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Tagger:
    """tags: number of labels. All parameters in self.p, by name."""

    def __init__(self, tags: int, embed: int = 12, hidden: int = 20, seed: int = 3):
        r = np.random.default_rng(seed)
        self.hidden, self.tags = hidden, tags
        small = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"E": small(CLASSES, embed) * 3, "O": small(2 * hidden, tags), "o": np.zeros(tags, np.float32), "T": np.zeros((tags, tags), np.float32)}
        for d in "fb":
            self.p |= {f"W{d}": small(embed, 4 * hidden), f"U{d}": small(hidden, 4 * hidden), f"c{d}": np.repeat(np.float32([0, 1, 0, 0]), hidden)}

    def _run(self, x: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """Hidden states (time, batch, hidden) of direction d over x (time, batch, embed), and what the way back needs."""
        h_size, (steps, batch, _) = self.hidden, x.shape
        pre = x @ self.p[f"W{d}"] + self.p[f"c{d}"]
        h, c = np.zeros((batch, h_size), np.float32), np.zeros((batch, h_size), np.float32)
        out, tape = np.empty((steps, batch, h_size), np.float32), [None] * steps
        for t in range(steps) if d == "f" else reversed(range(steps)):
            z = pre[t] + h @ self.p[f"U{d}"]
            gates = _sigmoid(z[:, : 3 * h_size])
            i, f, o = gates[:, :h_size], gates[:, h_size : 2 * h_size], gates[:, 2 * h_size :]
            g = np.tanh(z[:, 3 * h_size :])
            new = f * c + i * g
            tanh = np.tanh(new)
            tape[t] = (i, f, o, g, c, tanh, h)
            c, h = new, o * tanh
            out[t] = h
        return out, tape

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """Scores (batch, time, tags) for classes x (batch, time)."""
        e = self.p["E"][x.T]
        both = np.concatenate([self._run(e, "f")[0], self._run(e, "b")[0]], axis=2)
        return (both @ self.p["O"] + self.p["o"]).transpose(1, 0, 2)

    def _crf(self, s: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Loss, and its gradients by the scores (time, batch, tags) and the transitions."""
        steps, batch, k = s.shape
        trans = self.p["T"].astype(np.float64)
        s = s.astype(np.float64)

        def total(x, axis):
            top = x.max(axis, keepdims=True)
            return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))

        alpha, beta = np.empty_like(s), np.zeros_like(s)
        alpha[0] = s[0]
        for t in range(1, steps):
            alpha[t] = s[t] + total(alpha[t - 1][:, :, None] + trans, 1)
        for t in range(steps - 2, -1, -1):
            beta[t] = total(trans + (s[t + 1] + beta[t + 1])[:, None, :], 2)
        z = total(alpha[-1], 1)
        d_s = np.exp(alpha + beta - z[:, None])
        d_t = np.exp(alpha[:-1, :, :, None] + trans + (s[1:] + beta[1:])[:, :, None, :] - z[:, None, None]).sum((0, 1))
        at = np.arange(batch)
        gold = s[np.arange(steps)[:, None], at, y].sum() + trans[y[:-1], y[1:]].sum()
        d_s[np.arange(steps)[:, None], at, y] -= 1
        np.add.at(d_t, (y[:-1], y[1:]), -1)
        return (z.sum() - gold) / batch, (d_s / batch).astype(np.float32), (d_t / batch).astype(np.float32)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss of labelled windows (batch, time) and its gradients."""
        x, y = x.T, y.T
        e = self.p["E"][x]
        runs = {d: self._run(e, d) for d in "fb"}
        both = np.concatenate([runs["f"][0], runs["b"][0]], axis=2)
        loss, d_s, d_t = self._crf(both @ self.p["O"] + self.p["o"], y)
        g = {"T": d_t, "o": d_s.sum((0, 1)), "O": np.einsum("tbh,tbk->hk", both, d_s)}
        d_both, h_size, d_e = d_s @ self.p["O"].T, self.hidden, np.zeros_like(e)
        for n, d in enumerate("fb"):
            d_out, tape = d_both[:, :, n * h_size : (n + 1) * h_size], runs[d][1]
            d_h, d_c, d_z = np.zeros_like(d_out[0]), np.zeros_like(d_out[0]), np.empty((*e.shape[:2], 4 * h_size), np.float32)
            u, g[f"U{d}"] = self.p[f"U{d}"].T, np.zeros_like(self.p[f"U{d}"])
            for t in reversed(range(len(e))) if d == "f" else range(len(e)):
                i, f, o, c_in, c_old, tanh, h_old = tape[t]
                d_h = d_h + d_out[t]
                d_c = d_c + d_h * o * (1 - tanh**2)
                d_z[t] = np.concatenate([d_c * c_in * i * (1 - i), d_c * c_old * f * (1 - f), d_h * tanh * o * (1 - o), d_c * i * (1 - c_in**2)], axis=1)
                g[f"U{d}"] += h_old.T @ d_z[t]
                d_h, d_c = d_z[t] @ u, d_c * f
            g[f"W{d}"], g[f"c{d}"] = np.einsum("tbe,tbz->ez", e, d_z), d_z.sum((0, 1))
            d_e += d_z @ self.p[f"W{d}"].T
        g["E"] = np.zeros_like(self.p["E"])
        np.add.at(g["E"], x, d_e)
        return loss, g

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 48, rate: float = 0.01, seed: int = 4) -> float:
        """Trains on labelled windows (count, time) by Adam with clipped gradients; returns the last epoch's mean loss."""
        r, step, mean = np.random.default_rng(seed), 0, 0.0
        m, v = ({k: np.zeros_like(a) for k, a in self.p.items()} for _ in range(2))
        steps = epochs * max(1, -(-len(x) // batch))
        for _ in range(epochs):
            order, losses = r.permutation(len(x)), []
            for start in range(0, len(x), batch):
                at = order[start : start + batch]
                loss, g = self.gradients(x[at], y[at])
                losses.append(loss)
                step += 1
                norm = np.sqrt(sum(float((a**2).sum()) for a in g.values()))
                lr = rate * (1 - 0.9 * step / steps)
                for k, a in g.items():
                    a = a * np.float32(min(1.0, 5 / (norm + 1e-9)))
                    m[k] = 0.9 * m[k] + 0.1 * a
                    v[k] = 0.999 * v[k] + 0.001 * a * a
                    self.p[k] = (self.p[k] - lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            mean = float(np.mean(losses))
        return mean

    def viterbi(self, s: np.ndarray) -> np.ndarray:
        """The best labels for one sequence's scores (time, tags)."""
        back, best = np.zeros(s.shape, np.int64), s[0].astype(np.float64)  # sums of many scores
        for t in range(1, len(s)):
            x = best[:, None] + self.p["T"]
            back[t] = x.argmax(0)
            best = x.max(0) + s[t]
        out = np.empty(len(s), np.int64)
        out[-1] = best.argmax()
        for t in range(len(s) - 1, 0, -1):
            out[t - 1] = back[t, out[t]]
        return out
