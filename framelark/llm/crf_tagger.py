"""Character tagger: bidirectional LSTM with CRF transitions, in numpy.

Windows of characters have one length, so a batch is a rectangle and both directions run in one matrix
product per step. Training is full gradient through the CRF likelihood with Adam; everything is seeded.
"""

import numpy as np

KINDS = ("email", "ip", "card", "phone")
TAGS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
VOCABULARY = 130  # ASCII, any other character, padding
PAD = 129
_NEVER = -1e4


def char_ids(text: str) -> np.ndarray:
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.minimum(code, 128).astype(np.int64)


def allowed() -> np.ndarray:
    """0 where tag j may follow tag i, else a large negative number: I needs B or I of its kind before it."""
    m = np.zeros((len(TAGS), len(TAGS)), np.float32)
    for j, t in enumerate(TAGS):
        if t[0] == "I":
            m[[i for i, s in enumerate(TAGS) if s[1:] != t[1:]], j] = _NEVER
    return m


def _first() -> np.ndarray:
    return np.array([_NEVER if t[0] == "I" else 0 for t in TAGS], np.float32)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lse(x, axis):
    m = x.max(axis=axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis=axis))


class Tagger:
    def __init__(self, weights):
        self.w = weights

    @classmethod
    def fresh(cls, hidden=24, embed=16, seed=0):
        rng = np.random.default_rng(seed)
        draw = lambda *s, k: (rng.standard_normal(s) * k).astype(np.float32)
        t = len(TAGS)
        b = np.zeros((2, 1, 4 * hidden), np.float32)
        b[:, :, hidden : 2 * hidden] = 1  # remember at first
        return cls({"e": draw(VOCABULARY, embed, k=0.3), "x": draw(2, embed, 4 * hidden, k=embed**-0.5), "h": draw(2, hidden, 4 * hidden, k=hidden**-0.5),
                    "b": b, "o": draw(2 * hidden, t, k=hidden**-0.5), "c": np.zeros(t, np.float32), "m": np.zeros((t, t), np.float32)})

    def emissions(self, ids, keep=None):
        """Scores (time, window, tag) of windows (window, time); `keep` receives what the gradient needs."""
        w, (n, length) = self.w, ids.shape
        hidden = w["h"].shape[1]
        emb = w["e"][ids.T]  # time, window, embed
        both = np.stack([emb, emb[::-1]])  # direction, time, window, embed
        pre = both @ w["x"][:, None] + w["b"][:, None]
        h = c = np.zeros((2, n, hidden), np.float32)
        hs, saved = np.empty((length, 2, n, hidden), np.float32), []
        for t in range(length):
            z = pre[:, t] + h @ w["h"]
            gates = _sigmoid(z[..., : 3 * hidden])
            i, f, o = gates[..., :hidden], gates[..., hidden : 2 * hidden], gates[..., 2 * hidden :]
            g = np.tanh(z[..., 3 * hidden :])
            before, c = c, f * c + i * g
            tc = np.tanh(c)
            prev, h = h, o * tc
            hs[t] = h
            if keep is not None:
                saved.append((i, f, o, g, before, tc, prev))
        top = np.concatenate([hs[:, 0], hs[::-1, 1]], axis=2)
        if keep is not None:
            keep.update(both=both, saved=saved, top=top, ids=ids)
        return top @ w["o"] + w["c"]

    def _forward_backward(self, em):
        move = self.w["m"] + allowed()
        length = len(em)
        alpha, beta = np.empty_like(em), np.zeros_like(em)
        alpha[0] = em[0] + _first()
        for t in range(1, length):
            alpha[t] = _lse(alpha[t - 1][:, :, None] + move, 1) + em[t]
        for t in range(length - 2, -1, -1):
            beta[t] = _lse(move + (em[t + 1] + beta[t + 1])[:, None, :], 2)
        return alpha, beta, _lse(alpha[-1], 1), move

    def posteriors(self, em):
        """Probability of each tag at each place (time, window, tag)."""
        alpha, beta, z, _ = self._forward_backward(em)
        return np.exp(alpha + beta - z[:, None])

    def decode(self, em):
        """Best tags (window, time)."""
        move, length = self.w["m"] + allowed(), len(em)
        score, back = em[0] + _first(), np.empty(em.shape, np.int8)
        for t in range(1, length):
            every = score[:, :, None] + move
            back[t] = every.argmax(axis=1)
            score = every.max(axis=1) + em[t]
        tags = np.empty((em.shape[1], length), np.int8)
        tags[:, -1] = score.argmax(axis=1)
        rows = np.arange(em.shape[1])
        for t in range(length - 1, 0, -1):
            tags[:, t - 1] = back[t][rows, tags[:, t]]
        return tags

    def gradient(self, ids, gold):
        """(loss, gradients) of the negative log likelihood of gold tags (window, time)."""
        keep, w = {}, self.w
        em = self.emissions(ids, keep)
        length, n, _ = em.shape
        alpha, beta, z, move = self._forward_backward(em)
        post = np.exp(alpha + beta - z[:, None])
        g, rows = gold.T, np.arange(n)
        hot = np.zeros_like(em)
        hot[np.arange(length)[:, None], rows, g] = 1
        gold_score = (em * hot).sum(axis=(0, 2)) + move[g[:-1], g[1:]].sum(axis=0)
        loss = float((z - gold_score).mean())
        d_em = (post - hot) / n
        pair = np.exp(alpha[:-1, :, :, None] + move + (em[1:] + beta[1:])[:, :, None, :] - z[None, :, None, None])
        d_move = pair.sum(axis=(0, 1))
        np.add.at(d_move, (g[:-1].ravel(), g[1:].ravel()), -1)
        out = {"m": d_move / n, "o": np.einsum("tnh,tnk->hk", keep["top"], d_em), "c": d_em.sum(axis=(0, 1))}
        d_top = d_em @ w["o"].T
        hidden = w["h"].shape[1]
        d_out = np.stack([d_top[..., :hidden], d_top[::-1, :, hidden:]], axis=1)  # time, direction, window
        d_h = d_c = np.zeros((2, n, hidden), np.float32)
        d_pre, d_wh = np.empty((2, length, n, 4 * hidden), np.float32), np.zeros_like(w["h"])
        back = w["h"].transpose(0, 2, 1)
        for t in range(length - 1, -1, -1):
            i, f, o, c_new, before, tc, prev = keep["saved"][t]
            d_h = d_h + d_out[t]
            d_c = d_c + d_h * o * (1 - tc * tc)
            d_z = np.concatenate([d_c * c_new * i * (1 - i), d_c * before * f * (1 - f), d_h * tc * o * (1 - o), d_c * i * (1 - c_new * c_new)], axis=2)
            d_pre[:, t] = d_z
            d_wh += prev.transpose(0, 2, 1) @ d_z
            d_h, d_c = d_z @ back, d_c * f
        out["h"], out["b"] = d_wh, d_pre.sum(axis=(1, 2))[:, None, :]
        out["x"] = np.einsum("dtne,dtnk->dek", keep["both"], d_pre, optimize=True)
        d_both = d_pre @ w["x"].transpose(0, 2, 1)[:, None]
        d_emb = d_both[0] + d_both[1][::-1]
        out["e"] = np.zeros_like(w["e"])
        np.add.at(out["e"], keep["ids"].T, d_emb)
        return loss, out

    def fit(self, ids, gold, epochs=6, batch=32, rate=0.02, seed=0):
        """Adam over shuffled batches with a falling rate; returns the loss of each epoch."""
        rng, step = np.random.default_rng(seed), 0
        one, two = ({k: np.zeros_like(v) for k, v in self.w.items()} for _ in range(2))
        total, losses = epochs * -(-len(ids) // batch), []
        for _ in range(epochs):
            order, sums = rng.permutation(len(ids)), []
            for at in range(0, len(ids), batch):
                part = order[at : at + batch]
                loss, grad = self.gradient(ids[part], gold[part])
                sums.append(loss)
                step += 1
                lr = rate * (1 - 0.9 * step / total)
                for k, g in grad.items():
                    g = np.clip(g, -1, 1)
                    one[k] = 0.9 * one[k] + 0.1 * g
                    two[k] = 0.99 * two[k] + 0.01 * g * g
                    self.w[k] = (self.w[k] - lr * (one[k] / (1 - 0.9**step)) / (np.sqrt(two[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
            losses.append(float(np.mean(sums)))
        return losses
