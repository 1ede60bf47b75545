"""A bidirectional gated recurrent network with attention pooling over word and character inputs, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Rows of the two hashed tables and the length of their vectors.
WORD_ROWS, GRAM_ROWS, DIM = 1 << 16, 1 << 17, 8
#: Bytes of the character n-grams; a word counts with a mark at either end.
GRAMS = (3, 4, 6)
HIDDEN, ATTENTION = 12, 8
#: Windows in one step of scoring.
BATCH = 2048
_FNV = np.uint32(16777619)

Parameters = dict[str, np.ndarray]


def fresh_parameters(seed: int = 0, hidden: int = HIDDEN, attention: int = ATTENTION, dim: int = DIM, words: int = WORD_ROWS, grams: int = GRAM_ROWS) -> Parameters:
    """Tables start at zero, so a word or n-gram that no label has taught says nothing."""
    rng = np.random.default_rng(seed)

    def mix(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    zero = lambda *shape: np.zeros(shape, np.float32)
    return {
        "words": zero(words, dim), "grams": zero(grams, dim),
        "Wf": mix(2 * dim, 3 * hidden), "bf": zero(3 * hidden), "Uf": mix(hidden, 3 * hidden),
        "Wb": mix(2 * dim, 3 * hidden), "bb": zero(3 * hidden), "Ub": mix(hidden, 3 * hidden),
        "A": mix(2 * hidden, attention), "a": zero(attention), "v": mix(attention),
        "w": mix(2 * hidden), "c": zero(1),
    }


# --- inputs -------------------------------------------------------------------------------------


@dataclass
class Features:
    """Rows of the tables for each distinct word: one of ``words``, several of ``grams`` (those from ``starts[i]`` on)."""

    word: np.ndarray
    gram: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    def take(self, which: np.ndarray) -> Features:
        sizes = self.sizes[which]
        starts = np.cumsum(sizes) - sizes
        at = np.repeat(self.starts[which] - starts, sizes) + np.arange(int(sizes.sum()))
        return Features(self.word[which], self.gram[at], starts, sizes)


def features_of(words: list[bytes], word_rows: int = WORD_ROWS, gram_rows: int = GRAM_ROWS) -> Features:
    """Hashes of each word and of its n-grams; a word of fewer bytes than an n-gram has none of that length."""
    joined = np.frombuffer(b"".join(b"<%b>" % w for w in words), np.uint8).astype(np.uint32)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(sizes) - sizes
    place = (np.arange(len(joined)) - np.repeat(starts, sizes)).astype(np.uint32)
    mixed = (joined + np.uint32(257) * place) * np.uint32(0x9E3779B1)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x85EBCA77)
    whole = np.bitwise_xor.reduceat(mixed, starts) if len(words) else np.zeros(0, np.uint32)
    whole ^= whole >> np.uint32(13)
    rows, owner = [], []
    for n in GRAMS:
        many = np.maximum(sizes - n + 1, 0)
        at = np.repeat(starts - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        h = np.full(len(at), 2166136261 + n, np.uint32)
        for i in range(n):
            h = (h ^ joined[at + i]) * _FNV
        rows.append(h ^ (h >> np.uint32(16)))
        owner.append(np.repeat(np.arange(len(words)), many))
    rows, owner = np.concatenate(rows), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    counts = np.bincount(owner, minlength=len(words)).astype(np.int64)
    return Features((whole % np.uint32(word_rows)).astype(np.int64), (rows[order] % np.uint32(gram_rows)).astype(np.int64), np.cumsum(counts) - counts, counts)


def inputs_of(p: Parameters, f: Features) -> np.ndarray:
    """Each word's vector and the mean of its n-grams'."""
    chars = np.zeros((len(f.word), p["grams"].shape[1]), p["grams"].dtype)
    some = f.sizes > 0
    if some.any():
        chars[some] = np.add.reduceat(p["grams"][f.gram], f.starts[some], axis=0) / f.sizes[some, None]
    return np.concatenate((p["words"][f.word], chars), axis=1)


def windows_of(per_text: np.ndarray, window: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All overlapping windows over texts of ``per_text`` words, laid end to end: text, first word, words.

    Windows begin every ``stride`` words; the last one ends with the text.  A shorter text is one window, an empty one none.
    """
    many = np.where(per_text > window, -(-(per_text - window) // stride) + 1, (per_text > 0).astype(np.int64))
    text = np.repeat(np.arange(len(per_text)), many)
    number = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    begin = np.minimum(number * stride, np.maximum(per_text[text] - window, 0))
    first = (np.cumsum(per_text) - per_text)[text] + begin
    return text, first, np.minimum(per_text[text], window)


# --- the network --------------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _run(given: np.ndarray, ids: np.ndarray, U: np.ndarray, mask: np.ndarray | None, backwards: bool, out: np.ndarray, keep: list | None) -> None:
    """One direction over ``ids (batch, time)``; states go to ``out (time, batch, hidden)``."""
    hidden = U.shape[0]
    h = np.zeros((len(ids), hidden), given.dtype)
    steps = range(ids.shape[1] - 1, -1, -1) if backwards else range(ids.shape[1])
    for t in steps:
        x, u = given[ids[:, t]], h @ U
        zr = _sigmoid(x[:, : 2 * hidden] + u[:, : 2 * hidden])
        z, r, un = zr[:, :hidden], zr[:, hidden:], u[:, 2 * hidden :]
        n = np.tanh(x[:, 2 * hidden :] + r * un)
        new = n + z * (h - n)
        if mask is not None:
            new = np.where(mask[:, t, None], new, h)
        if keep is not None:
            keep.append((t, h, z, r, un, n))
        h = new
        out[t] = h


def _attend(p: Parameters, H: np.ndarray, mask: np.ndarray | None):
    u = np.tanh(H @ p["A"] + p["a"])
    e = u @ p["v"]
    if mask is not None:
        e = np.where(mask.T, e, np.float32(-1e9))
    e = np.exp(e - e.max(axis=0))
    alpha = e / e.sum(axis=0)
    pooled = (alpha[:, :, None] * H).sum(axis=0)
    return u, alpha, pooled, pooled @ p["w"] + p["c"][0]


def logits(p: Parameters, inputs: np.ndarray, codes: np.ndarray, first: np.ndarray, sizes: np.ndarray, window: int) -> np.ndarray:
    """The network's output for each window; ``codes`` are the rows of ``inputs`` at each word."""
    pad = np.zeros((1, inputs.shape[1]), inputs.dtype)
    padded = np.concatenate((inputs, pad))
    forth, back = padded @ p["Wf"] + p["bf"], padded @ p["Wb"] + p["bb"]
    out = np.zeros(len(first), np.float32)
    short = sizes < window
    for group in (np.flatnonzero(~short), np.flatnonzero(short)):
        for i in range(0, len(group), BATCH):
            at = group[i : i + BATCH]
            ids, mask = word_ids(codes, first[at], sizes[at], window, len(inputs))
            out[at] = _forward(p, forth, back, ids, mask)[-1]
    return out


def word_ids(codes: np.ndarray, first: np.ndarray, sizes: np.ndarray, window: int, pad: int) -> tuple[np.ndarray, np.ndarray | None]:
    at = first[:, None] + np.arange(window)
    if (sizes == window).all():
        return codes[at], None
    mask = np.arange(window) < sizes[:, None]
    return np.where(mask, codes[np.minimum(at, max(len(codes) - 1, 0))], pad), mask


def _forward(p: Parameters, forth: np.ndarray, back: np.ndarray, ids: np.ndarray, mask: np.ndarray | None, keep: tuple | None = None):
    hidden = p["Uf"].shape[0]
    H = np.empty((ids.shape[1], len(ids), 2 * hidden), forth.dtype)
    _run(forth, ids, p["Uf"], mask, False, H[:, :, :hidden], keep[0] if keep else None)
    _run(back, ids, p["Ub"], mask, True, H[:, :, hidden:], keep[1] if keep else None)
    return H, *_attend(p, H, mask)


def loss_and_gradients(p: Parameters, f: Features, ids: np.ndarray, mask: np.ndarray | None, y: np.ndarray, weight: np.ndarray) -> tuple[float, dict]:
    """Weighted cross-entropy of windows and its gradients; ``ids`` are places in ``f``, its length stands for padding.

    Gradients of the two tables are rows and what they get.
    """
    x = np.concatenate((inputs_of(p, f), np.zeros((1, 2 * p["words"].shape[1]), p["words"].dtype)))
    forth, back = x @ p["Wf"] + p["bf"], x @ p["Wb"] + p["bb"]
    kept: tuple[list, list] = ([], [])
    H, u, alpha, pooled, z = _forward(p, forth, back, ids, mask, kept)
    q = _sigmoid(z)
    loss = float((weight * (np.logaddexp(0, z) - y * z)).sum() / weight.sum())
    dz = (weight * (q - y) / weight.sum()).astype(z.dtype)
    g: Parameters = {"w": pooled.T @ dz, "c": dz.sum(keepdims=True)}
    dpooled = dz[:, None] * p["w"]
    dH = alpha[:, :, None] * dpooled
    dalpha = (H * dpooled).sum(axis=2)
    de = alpha * (dalpha - (alpha * dalpha).sum(axis=0))
    du = de[:, :, None] * p["v"] * (1 - u * u)
    g["v"] = np.tensordot(de, u, 2)
    g["A"], g["a"] = np.tensordot(H, du, ((0, 1), (0, 1))), du.sum(axis=(0, 1))
    dH = dH + du @ p["A"].T
    hidden = p["Uf"].shape[0]
    dx = np.zeros_like(x)
    flat = ids.T.ravel()
    by_word = np.argsort(flat, kind="stable")
    present, at = np.unique(flat[by_word], return_index=True)
    for W, b, U, steps, part in (("Wf", "bf", "Uf", kept[0], dH[:, :, :hidden]), ("Wb", "bb", "Ub", kept[1], dH[:, :, hidden:])):
        dsteps = np.empty((ids.shape[1], len(ids), 3 * hidden), x.dtype)
        g[U] = np.zeros_like(p[U])
        dh = np.zeros((len(ids), hidden), x.dtype)
        for t, h, z_, r, un, n in reversed(steps):
            dh = dh + part[t]
            dnew = dh if mask is None else np.where(mask[:, t, None], dh, 0)
            dn = dnew * (1 - z_) * (1 - n * n)
            dzg = dnew * (h - n) * z_ * (1 - z_)
            drg = dn * un * r * (1 - r)
            dsteps[t] = np.concatenate((dzg, drg, dn), axis=1)
            du_ = np.concatenate((dzg, drg, dn * r), axis=1)
            g[U] += h.T @ du_
            through = dnew * z_ + du_ @ p[U].T
            dh = through if mask is None else through + np.where(mask[:, t, None], 0, dh)
        dgiven = np.zeros((len(x), 3 * hidden), x.dtype)
        dgiven[present] = np.add.reduceat(dsteps.reshape(-1, 3 * hidden)[by_word], at, axis=0)
        dgiven[-1] = 0
        g[W], g[b] = x.T @ dgiven, dgiven.sum(axis=0)
        dx += dgiven @ p[W].T
    dim = p["words"].shape[1]
    g["words"] = _by_row(f.word, dx[:-1, :dim])
    g["grams"] = _by_row(f.gram, np.repeat(dx[:-1, dim:] / np.maximum(f.sizes, 1)[:, None], f.sizes, axis=0))
    return loss, g


def _by_row(rows: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a table that have a gradient, and their sums."""
    order = np.argsort(rows, kind="stable")
    present, at = np.unique(rows[order], return_index=True)
    return present, np.add.reduceat(d[order], at, axis=0) if len(at) else d


class Adam:
    """Adam; the tables' rows move only in steps in which they occur."""

    def __init__(self, p: Parameters, rate: float):
        self.rate, self.step = rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.s = {k: np.zeros_like(v) for k, v in p.items()}

    def apply(self, p: Parameters, g: dict) -> None:
        self.step += 1
        a, b = 1 - 0.9**self.step, 1 - 0.999**self.step
        for k in p:
            rows, d = g[k] if k in ("words", "grams") else (slice(None), g[k])
            m = self.m[k][rows] = 0.9 * self.m[k][rows] + 0.1 * d
            s = self.s[k][rows] = 0.999 * self.s[k][rows] + 0.001 * d * d
            p[k][rows] -= (self.rate * (m / a) / (np.sqrt(s / b) + 1e-8)).astype(p[k].dtype)
