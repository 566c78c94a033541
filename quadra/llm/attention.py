"""A small causal self-attention model in numpy: it predicts the class of the next word from the subword ids of the
words before it. A word's input is the mean of its subwords' embeddings; one head with a bias by distance; the output
reads the last input and the attended values. Gradients are written out; training is Adagrad over batches of windows."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np

WINDOW, OVERLAP = 32, 8
_FAR = np.arange(WINDOW)[:, None] - np.arange(WINDOW)[None, :]


def _add_rows(out: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """``out[at] += rows`` with repeated numbers in ``at``."""
    if len(at):
        order = np.argsort(at, kind="stable")
        at = at[order]
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        out[at[first]] += np.add.reduceat(rows[order], first, axis=0)


@dataclass
class Attention:
    """``rows`` embeddings of subwords, and one more for the start of a text."""

    rows: int
    classes: int
    d: int = 16
    seed: int = 7
    p: dict = field(default_factory=dict)

    def __post_init__(self):
        if not self.p:
            r = np.random.default_rng(self.seed)
            g = lambda *s: (r.standard_normal(s) * 0.3).astype(np.float32)
            self.p = {"e": g(self.rows + 1, self.d), "q": g(self.d, self.d), "k": g(self.d, self.d), "v": g(self.d, self.d), "o": g(2 * self.d, self.classes), "c": np.zeros(self.classes, np.float32), "b": np.zeros(WINDOW, np.float32)}

    def embed(self, pieces: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Mean embedding of each word; pieces of all words joined, ``n`` of each (no word is without)."""
        if not len(n):
            return np.empty((0, self.d), np.float32)
        sums = np.add.reduceat(self.p["e"][pieces], np.r_[0, np.cumsum(n)[:-1]], axis=0)
        return sums / n[:, None].astype(np.float32)

    def _forward(self, x: np.ndarray):
        p, w = self.p, x.shape[1]
        q, k, v = x @ p["q"], x @ p["k"], x @ p["v"]
        s = q @ k.transpose(0, 2, 1)
        s *= np.float32(self.d**-0.5)
        s += self._bias(w)
        s -= s.max(axis=2, keepdims=True)
        np.exp(s, out=s)
        s /= s.sum(axis=2, keepdims=True)
        xh = np.concatenate([x, s @ v], axis=2)
        z = xh @ p["o"] + p["c"]
        z -= z.max(axis=2, keepdims=True)
        z -= np.log(np.exp(z).sum(axis=2, keepdims=True))
        return q, k, v, s, xh, z

    def _bias(self, w: int) -> np.ndarray:
        far = _FAR[:w, :w]
        return np.where(far >= 0, self.p["b"][np.clip(far, 0, None)], np.float32(-1e9)).astype(np.float32)

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        """(windows, positions, d) -> natural log of each class at each position, seeing it and earlier ones only."""
        return self._forward(x)[5]

    def gradients(self, x: np.ndarray, y: np.ndarray):
        """(mean loss, gradients, gradient of x); positions with y < 0 do not count."""
        p, scale, w = self.p, np.float32(self.d**-0.5), x.shape[1]
        q, k, v, a, xh, z = self._forward(x)
        use = y >= 0
        n = max(1, int(use.sum()))
        rows = np.clip(y, 0, None)
        loss = -float((np.take_along_axis(z, rows[..., None], 2)[..., 0] * use).sum()) / n
        dz = np.exp(z)
        np.put_along_axis(dz, rows[..., None], np.take_along_axis(dz, rows[..., None], 2) - 1, 2)
        dz *= (use / n)[..., None].astype(x.dtype)
        flat = lambda m: m.reshape(-1, m.shape[2])
        g = {"o": flat(xh).T @ flat(dz), "c": dz.sum((0, 1))}
        dxh = dz @ p["o"].T
        dx, dh = dxh[..., : self.d].copy(), dxh[..., self.d :]
        da, dv = dh @ v.transpose(0, 2, 1), a.transpose(0, 2, 1) @ dh
        ds = a * (da - (da * a).sum(2, keepdims=True))
        seen = _FAR[:w, :w] >= 0
        g["b"] = np.bincount(_FAR[:w, :w][seen], ds.sum(0)[seen], WINDOW)
        dq, dk = ds @ k * scale, ds.transpose(0, 2, 1) @ q * scale
        for name, d in (("q", dq), ("k", dk), ("v", dv)):
            g[name] = flat(x).T @ flat(d)
            dx += d @ p[name].T
        return loss, g, dx

    def fresh(self) -> dict:
        """Adagrad's state before the first step."""
        return {n: np.full_like(v, 1e-3) for n, v in self.p.items()}

    def train(self, at: np.ndarray, y: np.ndarray, pieces: np.ndarray, n: np.ndarray, state: dict, rate: float = 0.15) -> float:
        """One step on a batch of windows; returns the mean loss. ``at`` (windows, positions): which word is the input,
        -1 for the start of a text, -2 for none; ``y``: the class to predict, or -1. ``pieces``, ``n``: of these words."""
        table = np.concatenate([self.embed(pieces, n), np.zeros((1, self.d), np.float32), self.p["e"][-1:]])  # rows -2 and -1
        loss, g, dx = self.gradients(table[at], y)
        dw = np.zeros((len(n) + 2, self.d), np.float32)
        _add_rows(dw, np.where(at < 0, len(dw) + at, at).ravel(), dx.reshape(-1, self.d))
        ge = np.zeros_like(self.p["e"])
        _add_rows(ge, pieces, np.repeat(dw[: len(n)] / n[:, None].astype(np.float32), n, axis=0))
        ge[-1] += dw[-1]
        for name, value in {"e": ge, **g}.items():
            state[name] += value**2
            self.p[name] -= (rate * value / np.sqrt(state[name])).astype(np.float32)
        return loss

    def positions(self, inputs: np.ndarray, lengths: np.ndarray, targets: np.ndarray, chunk: int = 256) -> np.ndarray:
        """log10 probability of the target class at each position of joined texts of ``lengths`` positions.

        Windows of WINDOW positions step on by WINDOW - OVERLAP; each scores the positions that no earlier one did."""
        out = np.zeros(len(targets), np.float32)
        if not len(targets):
            return out
        step = WINDOW - OVERLAP
        begins = np.r_[0, np.cumsum(lengths)[:-1]]
        count = 1 + np.maximum(0, -(-(lengths - WINDOW) // step))
        owner = np.repeat(np.arange(len(lengths)), count)
        number = np.arange(len(owner)) - np.repeat(np.r_[0, np.cumsum(count)[:-1]], count)
        at, stop = begins[owner] + number * step, (begins + lengths)[owner]
        # queries, keys and values of each position once, not once a window
        d, scale = self.d, np.float32(self.d**-0.5)
        qkv = inputs @ np.concatenate([self.p["q"] * scale, self.p["k"], self.p["v"]], axis=1)
        bias, span = self._bias(WINDOW), np.arange(WINDOW)
        for skip, group in ((0, np.flatnonzero(number == 0)), (OVERLAP, np.flatnonzero(number > 0))):
            for lo in range(0, len(group), chunk):
                part = group[lo : lo + chunk]
                end = stop[part, None]
                pos = np.minimum(at[part, None] + span, end - 1)
                rows = qkv[pos]
                s = rows[:, skip:, :d] @ rows[:, :, d : 2 * d].transpose(0, 2, 1)
                s += bias[skip:]
                np.minimum(s, 60, out=s)
                np.exp(s, out=s)
                h = s @ rows[:, :, 2 * d :]
                h /= s.sum(axis=2, keepdims=True)
                use = (at[part, None] + span[skip:] < end).ravel()
                pos = pos[:, skip:].ravel()[use]
                z = np.concatenate([inputs[pos], h.reshape(-1, d)[use]], axis=1) @ self.p["o"] + self.p["c"]
                got = z[np.arange(len(z)), targets[pos]]
                np.minimum(z, 60, out=z)
                np.exp(z, out=z)
                out[pos] = (got - np.log(z.sum(axis=1))) * np.float32(1 / np.log(10))
        return out


def windows_once(length: int) -> Iterable[int]:
    """How often each of ``length`` positions is scored, by the rule of :meth:`Attention.positions`."""
    step, seen = WINDOW - OVERLAP, [0] * length
    for k in range(1 + max(0, -(-(length - WINDOW) // step))):
        for i in range(0 if k == 0 else OVERLAP, WINDOW):
            if k * step + i < length:
                seen[k * step + i] += 1
    return seen
