"""Character-level bidirectional LSTM with a CRF on top, in numpy.

Arrays are time-major: (time, windows). Both directions run as one batch of
two; the second reads each window backwards.
"""

from __future__ import annotations

import numpy as np

CHARS = 130  # ASCII, other letters, everything else
PAD = 129


def char_ids(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    wide = codes >= 128
    if wide.any():
        codes = codes.copy()
        codes[wide] = [128 if chr(c).isalpha() else PAD for c in codes[wide]]
    return codes


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Tagger:
    def __init__(self, tags: int, embed: int = 12, hidden: int = 20, seed: int = 5):
        rng = np.random.default_rng(seed)

        def init(*shape):
            return (rng.normal(size=shape) / np.sqrt(shape[-2])).astype(np.float32)

        self.hidden, self.tags = hidden, tags
        bias = np.zeros((2, 1, 4 * hidden), np.float32)
        bias[..., hidden : 2 * hidden] = 1  # remember at first
        self.p = {
            "embed": (0.3 * rng.normal(size=(CHARS, embed))).astype(np.float32),
            "wx": init(2, embed, 4 * hidden),
            "wh": init(2, hidden, 4 * hidden),
            "b": bias,
            "out": init(2 * hidden, tags),
            "c": np.zeros(tags, np.float32),
            "move": np.zeros((tags, tags), np.float32),
        }

    def _forward(self, ids: np.ndarray, keep: bool = False):
        """Scores of each tag, (time, windows, tags)."""
        p, hid = self.p, self.hidden
        steps, n = ids.shape
        x = p["embed"][np.stack([ids, ids[::-1]])]  # (2, time, windows, embed)
        given = x @ p["wx"][:, None] + p["b"][:, None]
        h, c = np.zeros((2, 2, n, hid), np.float32)
        outs, kept = np.empty((2, steps, n, hid), np.float32), []
        for t in range(steps):
            g = given[:, t] + h @ p["wh"]
            gates = _sigmoid(g[..., : 3 * hid])
            i, f, o = gates[..., :hid], gates[..., hid : 2 * hid], gates[..., 2 * hid :]
            u = np.tanh(g[..., 3 * hid :])
            before, c = c, f * c + i * u
            tc = np.tanh(c)
            if keep:
                kept.append((h, before, i, f, o, u, tc))
            h = o * tc
            outs[:, t] = h
        both = np.concatenate([outs[0], outs[1, ::-1]], axis=-1)
        return both @ p["out"] + p["c"], (x, both, kept)

    def _sums(self, scores: np.ndarray):
        """Log-sums forward and backward of the chain."""
        move, steps = self.p["move"], len(scores)
        ahead, back = np.empty_like(scores), np.zeros_like(scores)
        ahead[0] = scores[0]
        for t in range(1, steps):
            ahead[t] = scores[t] + _lse(ahead[t - 1][:, :, None] + move[None])
        for t in range(steps - 2, -1, -1):
            back[t] = _lse((move[None] + (scores[t + 1] + back[t + 1])[:, None, :]).swapaxes(1, 2))
        return ahead, back, _lse(ahead[-1][:, :, None])[:, 0]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags (Viterbi) and their posterior, (time, windows)."""
        scores, _ = self._forward(ids)
        move, steps, n = self.p["move"], *ids.shape
        came = np.zeros((steps, n, self.tags), np.int8)
        best = scores[0]
        for t in range(1, steps):
            paths = best[:, :, None] + move[None]
            came[t] = paths.argmax(axis=1)
            best = paths.max(axis=1) + scores[t]
        tags = np.empty((steps, n), np.int64)
        tags[-1] = best.argmax(axis=1)
        rows = np.arange(n)
        for t in range(steps - 1, 0, -1):
            tags[t - 1] = came[t, rows, tags[t]]
        ahead, back, total = self._sums(scores)
        sure = np.exp(ahead + back - total[None, :, None])
        return tags, np.take_along_axis(sure, tags[:, :, None], axis=2)[:, :, 0]

    def gradients(self, ids: np.ndarray, tags: np.ndarray):
        """Mean negative log-likelihood per window and its gradients."""
        p, hid = self.p, self.hidden
        steps, n = ids.shape
        scores, (x, both, kept) = self._forward(ids, keep=True)
        ahead, back, total = self._sums(scores)
        gold = np.take_along_axis(scores, tags[:, :, None], 2).sum() + p["move"][tags[:-1], tags[1:]].sum()
        loss = (total.sum() - gold) / n
        d = np.exp(ahead + back - total[None, :, None])
        np.put_along_axis(d, tags[:, :, None], np.take_along_axis(d, tags[:, :, None], 2) - 1, 2)
        d /= n
        pair = ahead[:-1, :, :, None] + p["move"] + (scores[1:] + back[1:])[:, :, None, :]
        grad_move = np.exp(pair - total[None, :, None, None]).sum(axis=(0, 1))
        np.subtract.at(grad_move, (tags[:-1].ravel(), tags[1:].ravel()), 1)
        g = {
            "move": grad_move / n,
            "c": d.sum(axis=(0, 1)),
            "out": np.tensordot(both, d, axes=([0, 1], [0, 1])),
        }
        d_both = d @ p["out"].T
        d_out = np.stack([d_both[..., :hid], d_both[::-1, :, hid:]])
        d_gates = np.empty((2, steps, n, 4 * hid), np.float32)
        dh, dc = np.zeros((2, 2, n, hid), np.float32)
        g["wh"] = np.zeros_like(p["wh"])
        for t in range(steps - 1, -1, -1):
            h, before, i, f, o, u, tc = kept[t]
            dh = dh + d_out[:, t]
            dc = dc + dh * o * (1 - tc * tc)
            part = np.concatenate(
                [dc * u * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - u * u)],
                axis=-1,
            )
            d_gates[:, t] = part
            g["wh"] += h.swapaxes(1, 2) @ part
            dh, dc = part @ p["wh"].swapaxes(1, 2), dc * f
        g["wx"] = np.stack([np.tensordot(x[k], d_gates[k], axes=([0, 1], [0, 1])) for k in (0, 1)])
        g["b"] = d_gates.sum(axis=(1, 2))[:, None]
        dx = d_gates @ p["wx"].swapaxes(1, 2)[:, None]
        g["embed"] = np.zeros_like(p["embed"])
        np.add.at(g["embed"], ids, dx[0] + dx[1, ::-1])
        return float(loss), g

    def fit(self, ids: np.ndarray, tags: np.ndarray, passes: int, batch: int = 32, rate: float = 0.015, seed: int = 3):
        """Adam over shuffled batches; ids and tags are (windows, time)."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, steps = 0, passes * -(-len(ids) // batch)
        for _ in range(passes):
            order = rng.permutation(len(ids))
            for at in range(0, len(ids), batch):
                own = order[at : at + batch]
                _, g = self.gradients(ids[own].T, tags[own].T)
                step += 1
                size = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
                cut = min(1.0, 5.0 / max(size, 1e-9))
                now = rate * (1 - step / (steps + 1))
                for k, x in g.items():
                    x = x * cut
                    first[k] = 0.9 * first[k] + 0.1 * x
                    second[k] = 0.99 * second[k] + 0.01 * x * x
                    fair = first[k] / (1 - 0.9**step)
                    self.p[k] -= (now * fair / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return self


def _lse(x: np.ndarray) -> np.ndarray:
    """Log of the sum of exponentials over axis 1."""
    top = x.max(axis=1, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=1)) + top[:, 0]
