"""A small character-level bidirectional LSTM with CRF transitions, in numpy: training and decoding."""

from __future__ import annotations

import numpy as np

_SIGNS = "@.+-_()/:,;'\"%=#&*!?[]{}<>|\\$~^`"
#: Index of a character: one each for digits, lower and upper case letters, blanks, signs, and other characters.
_ASCII = np.array([1 if 48 <= c < 58 else 2 if 97 <= c < 123 else 3 if 65 <= c < 91 else 4 if c in (9, 10, 11, 12, 13, 32) else 6 + _SIGNS.index(chr(c)) if chr(c) in _SIGNS else 5 for c in range(128)])
CLASSES = 6 + len(_SIGNS)


def coded(points: np.ndarray) -> np.ndarray:
    """Code points -> character classes; characters beyond ASCII count as lower-case letters; 0 is padding."""
    return np.where(points < 128, _ASCII[np.minimum(points, 127)], 2)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Tagger:
    def __init__(self, tags: int, hidden: int = 16, seed: int = 1):
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        self.hidden, self.tags = hidden, tags
        self.p = {"x": draw(2, CLASSES, 4 * hidden, scale=0.3), "h": draw(2, hidden, 4 * hidden, scale=0.2), "b": np.zeros((2, 1, 1, 4 * hidden), np.float32), "e": draw(2 * hidden, tags, scale=0.2), "eb": np.zeros(tags, np.float32), "t": np.zeros((tags, tags), np.float32), "s": np.zeros(tags, np.float32)}
        self.p["b"][..., hidden : 2 * hidden] = 1

    def forward(self, x: np.ndarray):
        """x: batch x length of classes -> emissions (length, batch, tags), and what the backward pass needs."""
        p, n = self.p, self.hidden
        both = np.stack([x.T, x.T[::-1]])
        z = np.stack([p["x"][d][both[d]] for d in (0, 1)]) + p["b"]
        length, batch = x.shape[1], x.shape[0]
        h, c = np.zeros((2, batch, n), np.float32), np.zeros((2, batch, n), np.float32)
        gates, cells, hs = [], [c], [h]
        for t in range(length):
            a = z[:, t] + h @ p["h"]
            s, g = _sigmoid(a[..., : 3 * n]), np.tanh(a[..., 3 * n :])
            c = s[..., n : 2 * n] * c + s[..., :n] * g
            h = s[..., 2 * n :] * np.tanh(c)
            gates.append((s, g))
            cells.append(c)
            hs.append(h)
        out = np.stack(hs[1:], axis=1)
        joined = np.concatenate([out[0], out[1][::-1]], axis=-1)
        return joined @ p["e"] + p["eb"], (both, gates, cells, hs, joined)

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Best tag of each position by Viterbi: batch x length. Padding (class 0) lies outside all spans."""
        e, _ = self.forward(x)
        e = e.copy()
        e[..., 0] = np.where(x.T == 0, 1e4, e[..., 0])
        score, back = e[0] + self.p["s"], []
        for t in range(1, len(e)):
            total = score[:, :, None] + self.p["t"]
            back.append(total.argmax(axis=1))
            score = total.max(axis=1) + e[t]
        tag = score.argmax(axis=1)
        out = [tag]
        for b in reversed(back):
            tag = np.take_along_axis(b, tag[:, None], 1)[:, 0]
            out.append(tag)
        return np.stack(out[::-1], axis=1)

    def gradients(self, x: np.ndarray, y: np.ndarray):
        """Mean negative log-likelihood of the tags y, and its gradients."""
        p, n = self.p, self.hidden
        e, (both, gates, cells, hs, joined) = self.forward(x)
        e = e.astype(np.float64)
        length, batch, k = e.shape
        trans = p["t"].astype(np.float64)
        up = np.empty((length, batch, k))
        down = np.zeros((length, batch, k))

        def lse(a, axis):
            m = a.max(axis=axis, keepdims=True)
            return np.squeeze(m, axis) + np.log(np.exp(a - m).sum(axis=axis))

        up[0] = e[0] + p["s"]
        for t in range(1, length):
            up[t] = lse(up[t - 1][:, :, None] + trans, 1) + e[t]
        for t in range(length - 2, -1, -1):
            down[t] = lse(trans + (e[t + 1] + down[t + 1])[:, None, :], 2)
        z = lse(up[-1], 1)
        one = np.exp(up + down - z[None, :, None])
        pair = np.exp(up[:-1, :, :, None] + trans + (e[1:] + down[1:])[:, :, None, :] - z[None, :, None, None]).sum(axis=(0, 1))
        gold = np.eye(k)[y.T]
        path = (gold * e).sum(axis=(0, 2)) + p["s"][y[:, 0]] + trans[y[:, :-1], y[:, 1:]].sum(axis=1)
        g_e = ((one - gold) / batch).astype(np.float32)
        pairs = np.zeros((k, k))
        np.add.at(pairs, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
        g = {"t": (pair - pairs) / batch, "s": g_e[0].sum(axis=0), "eb": g_e.sum(axis=(0, 1)), "e": np.einsum("tbh,tbk->hk", joined, g_e)}
        g_out = g_e @ p["e"].T
        g_out = np.stack([g_out[..., :n], g_out[::-1, :, n:]])
        g_z = np.empty((2, length, batch, 4 * n), np.float32)
        g_h, g_c = np.zeros((2, batch, n), np.float32), np.zeros((2, batch, n), np.float32)
        for t in range(length - 1, -1, -1):
            s, cand = gates[t]
            i, f, o = s[..., :n], s[..., n : 2 * n], s[..., 2 * n :]
            g_h = g_h + g_out[:, t]
            tc = np.tanh(cells[t + 1])
            g_c = g_c + g_h * o * (1 - tc * tc)
            a = np.concatenate([g_c * cand * i * (1 - i), g_c * cells[t] * f * (1 - f), g_h * tc * o * (1 - o), g_c * i * (1 - cand * cand)], axis=-1)
            g_z[:, t] = a
            g_h, g_c = a @ p["h"].transpose(0, 2, 1), g_c * f
        before = np.stack(hs[:-1], axis=1)
        g["h"] = np.einsum("dtbh,dtbz->dhz", before, g_z)
        g["b"] = g_z.sum(axis=(1, 2), keepdims=True)
        g["x"] = np.zeros_like(p["x"])
        for d in (0, 1):
            np.add.at(g["x"][d], both[d], g_z[d])
        return float((z - path).mean()), g

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 8, batch: int = 48, rate: float = 0.02, seed: int = 2) -> list[float]:
        """Adam over shuffled batches; returns the mean loss of each epoch."""
        rng = np.random.default_rng(seed)
        m, v, step, losses = {k: 0.0 for k in self.p}, {k: 0.0 for k in self.p}, 0, []
        for _ in range(epochs):
            total = []
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                rows = order[at : at + batch]
                loss, g = self.gradients(x[rows], y[rows])
                step += 1
                size = np.sqrt(sum(float((a * a).sum()) for a in g.values()))
                for k, a in g.items():
                    a = a * min(1.0, 5.0 / (size + 1e-9))
                    m[k], v[k] = 0.9 * m[k] + 0.1 * a, 0.99 * v[k] + 0.01 * a * a
                    self.p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
                total.append(loss)
            losses.append(float(np.mean(total)))
        return losses
