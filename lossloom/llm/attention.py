"""A small causal self-attention model over token classes: training step and batched scoring in numpy."""

from __future__ import annotations

import numpy as np

HALF = 8  # tokens that a window scores; it sees as many before them
SPAN = 2 * HALF
KEY, VALUE, HIDDEN = 8, 8, 24
PAD, BEGIN = 0, 1  # input symbols that are no token
NEVER = np.float32(-1e9)
MOST = np.float32(60)  # of an attention score: exp stays finite
LEAST = np.float32(0.05)
STEP = 128  # windows that are scored together: their arrays stay in a core's cache

_GAP = np.arange(HALF)[:, None] + HALF - np.arange(SPAN)[None, :]  # distance from query to key
CAUSAL = np.where(_GAP >= 0, np.float32(0), NEVER)
GAP = np.clip(_GAP, 0, SPAN - 1)


def new_model(inputs: int, classes: int, seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)

    def normal(*size: int, scale: float = 0.1) -> np.ndarray:
        return (rng.standard_normal(size) * scale).astype(np.float32)

    return {"q": normal(inputs, KEY, scale=0.2), "k": normal(inputs, KEY, scale=0.2), "v": normal(inputs, VALUE, scale=0.3),
            "gap": np.zeros(SPAN, np.float32), "r": normal(inputs, HIDDEN, scale=0.3), "o": normal(VALUE, HIDDEN, scale=0.25),
            "b": np.zeros(HIDDEN, np.float32), "u": normal(HIDDEN, classes, scale=0.005), "c": np.zeros(classes, np.float32)}


def windows(inputs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(windows, SPAN) input symbols of sequences, and how many windows each has.

    Windows overlap by half: the first half is context, the second half holds the positions that are scored, so every
    position is scored once. Before the first token the context is padding.
    """
    counts = np.array([-(-len(x) // HALF) for x in inputs])
    flat = np.full(int((counts + 1).sum()) * HALF, PAD, np.int32)
    begin = np.concatenate([[0], np.cumsum(counts + 1)[:-1]]) * HALF
    for at, x in zip(begin, inputs):
        flat[at + HALF:at + HALF + len(x)] = x
    first = np.repeat(begin, counts) + HALF * (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))
    return flat[first[:, None] + np.arange(SPAN)], counts


def forward(m: dict[str, np.ndarray], x: np.ndarray, prior: np.ndarray, room: np.ndarray | None = None) -> tuple:
    """Attention, hidden states and class values at the second half of each window.

    A class has a probability in proportion to the 16th power of its value, which is at least LEAST: near exp(16 (value - 1)), for
    four multiplications. `prior` holds the values that the model corrects, one row a position.
    """
    own = x[:, HALF:]
    q, k, v = m["q"].take(own, 0), m["k"].take(x, 0), m["v"].take(x, 0)
    s = np.matmul(q, k.transpose(0, 2, 1))
    s += m["gap"][GAP] + CAUSAL
    padded = np.flatnonzero((x == PAD).any(1))
    s[padded] += np.where(x[padded] == PAD, NEVER, np.float32(0))[:, None, :]
    np.minimum(s, MOST, out=s)
    a = np.exp(s, out=s)
    # A position past the end of a text may see padding alone; its weight is zero.
    a /= np.maximum(np.einsum("ijk->ij", a), np.float32(1e-30))[:, :, None]
    o = np.matmul(a, v).reshape(-1, VALUE)
    h = m["r"].take(own, 0).reshape(-1, HIDDEN)
    h += o @ m["o"]
    h += m["b"]
    np.maximum(h, 0, out=h)
    y = np.matmul(h, m["u"], out=None if room is None else room[:len(h)])
    y += m["c"]
    y += prior
    np.maximum(y, LEAST, out=y)
    return own, q, k, v, a, o, h, y


def powers(y: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    out = np.multiply(y, y, out=out)
    for _ in range(3):
        np.multiply(out, out, out=out)
    return out


def class_scores(m: dict[str, np.ndarray], x: np.ndarray, prior: np.ndarray, before: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural log probability of the target class at each scored position, (windows, HALF); `prior[before]` are its prior values."""
    out = np.empty(target.shape, np.float32)
    room = np.empty((STEP * HALF, m["u"].shape[1]), np.float32)  # memory of one step, used again by the next
    ones = np.ones(m["u"].shape[1], np.float32)
    for s in range(0, len(x), STEP):
        y = forward(m, x[s:s + STEP], prior.take(before[s:s + STEP].reshape(-1), 0), room)[-1]
        t = target[s:s + STEP].reshape(-1)
        hit = y[np.arange(len(t)), t]
        out[s:s + STEP] = (16 * np.log(hit) - np.log(powers(y, y) @ ones)).reshape(-1, HALF)
    return out


def row_sums(rows: int, at: np.ndarray, values: np.ndarray) -> np.ndarray:
    """(rows, width) sums of the rows of `values` that have each number."""
    width = values.shape[1]
    cell = np.multiply(at, width, dtype=np.int64)[:, None] + np.arange(width)
    return np.bincount(cell.reshape(-1), values.reshape(-1), rows * width).reshape(rows, width).astype(np.float32)


def gradient(m: dict[str, np.ndarray], x: np.ndarray, prior: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss over the weighted positions and its gradient."""
    t, w = target.reshape(-1), weight.reshape(-1).astype(np.float32)
    w /= max(1.0, float(w.sum()))
    own, q, k, v, a, o, h, y = forward(m, x, prior)
    rows = np.arange(len(t))
    hit = y[rows, t]
    # The loss has the slope 16 (y ** 15 / z - [target] / y); no value falls below LEAST.
    low = y <= LEAST if y.min() <= LEAST else None
    p = y * y
    p *= y
    fourth = p * y
    p *= fourth
    np.multiply(fourth, fourth, out=fourth)
    p *= fourth
    z = np.einsum("ij,ij->i", p, y)
    scale = 16 * w
    p *= (scale / z)[:, None]
    p[rows, t] -= scale / hit
    if low is not None:
        p[low] = 0
    ones = np.ones(len(t), np.float32)
    loss = float((w * (np.log(z) - 16 * np.log(hit))).sum())
    g = {"u": h.T @ p, "c": ones @ p}
    dh = p @ m["u"].T
    dh *= h > 0
    g["b"], g["o"] = ones @ dh, o.T @ dh
    do = (dh @ m["o"].T).reshape(len(x), HALF, VALUE)
    ds = np.matmul(do, v.transpose(0, 2, 1))
    ds -= np.einsum("ijk,ijk->ij", ds, a)[:, :, None]
    ds *= a
    g["gap"] = np.bincount(GAP.reshape(-1), ds.sum(0).reshape(-1), SPAN).astype(np.float32)
    # The tables of one position share a sum: q and r of its own, k and v of every one that is seen.
    mine = np.concatenate([np.matmul(ds, k).reshape(-1, KEY), dh], 1)
    seen = np.empty((len(x), SPAN, KEY + VALUE), np.float32)
    np.matmul(ds.transpose(0, 2, 1), q, out=seen[:, :, :KEY])
    np.matmul(a.transpose(0, 2, 1), do, out=seen[:, :, KEY:])
    mine = row_sums(len(m["q"]), own.reshape(-1), mine)
    seen = row_sums(len(m["k"]), x.reshape(-1), seen.reshape(-1, KEY + VALUE))
    g["q"], g["r"], g["k"], g["v"] = mine[:, :KEY], mine[:, KEY:], seen[:, :KEY], seen[:, KEY:]
    return loss, g


class Adam:
    """Adam steps on a model, whose arrays become views of one vector."""

    def __init__(self, model: dict[str, np.ndarray], rate: float):
        self.rate, self.step = rate, 0
        self.all = np.concatenate([v.reshape(-1) for v in model.values()])
        self.slope, self.room = np.empty_like(self.all), np.empty_like(self.all)
        self.first, self.second = np.zeros_like(self.all), np.zeros_like(self.all)
        self.model, self.own = model, {}
        at = 0
        for k, v in model.items():
            model[k], self.own[k] = (vector[at:at + v.size].reshape(v.shape) for vector in (self.all, self.slope))
            at += v.size

    def update(self, g: dict[str, np.ndarray]) -> None:
        self.step += 1
        rate = np.float32(self.rate * (1 - 0.99 ** self.step) ** 0.5 / (1 - 0.9 ** self.step))
        for k, v in self.own.items():
            v[...] = g[k]
        slope, room = self.slope, self.room
        np.multiply(slope, slope, out=room)
        self.first *= np.float32(0.9)
        slope *= np.float32(0.1)
        self.first += slope
        self.second *= np.float32(0.99)
        room *= np.float32(0.01)
        self.second += room
        np.sqrt(self.second, out=room)
        room += np.float32(1e-7)
        np.divide(self.first, room, out=room)
        room *= rate
        self.all -= room
