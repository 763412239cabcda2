"""Character-level bidirectional LSTM with a CRF on top, in numpy: training, and decoding of overlapping windows."""

from __future__ import annotations

import numpy as np

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)  # 0 is outside; 1 + 2 k begins a span of kind k, 2 + 2 k goes on with it
SIGNS = ".@+-_%(),:;/=\"'#*$&|<>[]!?"
CLASSES = 26 + 1 + len(SIGNS) + 4
EMBED, HIDDEN = 12, 24
WINDOW = 64


def _class_table() -> np.ndarray:
    """Class of each of the first 128 code points; higher ones are other letters."""
    space, line, letter, other = (27 + len(SIGNS) + k for k in range(4))
    out = np.full(129, other, np.int64)
    for k in range(26):
        out[ord("a") + k] = out[ord("A") + k] = k
    out[ord("0"):ord("9") + 1] = 26
    for k, c in enumerate(SIGNS):
        out[ord(c)] = 27 + k
    out[ord(" ")] = out[ord("\t")] = space
    out[ord("\n")] = out[ord("\r")] = line
    out[128] = letter
    return out


_CLASS = _class_table()


def classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _CLASS[np.minimum(points, 128)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def new_model(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    model = {"embed": rng.normal(0, 0.3, (CLASSES, EMBED)), "out": rng.normal(0, 0.2, (2 * HIDDEN, TAGS)),
             "out_b": np.zeros(TAGS), "move": np.zeros((TAGS, TAGS)), "first": np.zeros(TAGS)}
    for side in "fb":
        model[f"x{side}"] = rng.normal(0, 0.25, (EMBED, 4 * HIDDEN))
        model[f"h{side}"] = rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN))
        model[f"b{side}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
    return model


def _lstm(model: dict, side: str, x: np.ndarray, keep: list | None) -> np.ndarray:
    """States (time, batch, hidden) of one direction; gates go into ``keep`` for the way back."""
    pre = x @ model[f"x{side}"] + model[f"b{side}"]
    h = c = np.zeros((x.shape[1], HIDDEN))
    out = np.empty((*x.shape[:2], HIDDEN))
    steps = range(len(x)) if side == "f" else range(len(x) - 1, -1, -1)
    for t in steps:
        z = pre[t] + h @ model[f"h{side}"]
        s = _sigmoid(z[:, :3 * HIDDEN])
        i, f, o, g = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:], np.tanh(z[:, 3 * HIDDEN:])
        before_h, before_c = h, c
        c = f * c + i * g
        y = np.tanh(c)
        h = o * y
        out[t] = h
        if keep is not None:
            keep.append((t, i, f, o, g, y, before_h, before_c))
    return out


def _lstm_back(model: dict, side: str, x: np.ndarray, keep: list, grad: np.ndarray, sums: dict) -> np.ndarray:
    dx = np.empty_like(x)
    dh_next = np.zeros((x.shape[1], HIDDEN))
    dc_next = np.zeros_like(dh_next)
    for t, i, f, o, g, y, before_h, before_c in reversed(keep):
        dh = grad[t] + dh_next
        dc = dh * o * (1 - y * y) + dc_next
        dz = np.hstack([dc * g * i * (1 - i), dc * before_c * f * (1 - f), dh * y * o * (1 - o), dc * i * (1 - g * g)])
        sums[f"x{side}"] += x[t].T @ dz
        sums[f"h{side}"] += before_h.T @ dz
        sums[f"b{side}"] += dz.sum(axis=0)
        dx[t] = dz @ model[f"x{side}"].T
        dh_next, dc_next = dz @ model[f"h{side}"].T, dc * f
    return dx


def _loss_grad(model: dict, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
    """Mean negative log-likelihood of the tag paths and its gradient; codes and tags are (time, batch)."""
    steps, batch = codes.shape
    x = model["embed"][codes]
    keep = {"f": [], "b": []}
    h = np.concatenate([_lstm(model, s, x, keep[s]) for s in "fb"], axis=2)
    e = h @ model["out"] + model["out_b"]
    move, rows = model["move"], np.arange(batch)
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[0] = model["first"] + e[0]
    for t in range(1, steps):
        alpha[t] = _logsum(alpha[t - 1][:, :, None] + move, 1) + e[t]
    for t in range(steps - 2, -1, -1):
        beta[t] = _logsum(move[None] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
    total = _logsum(alpha[-1], 1)
    gold = model["first"][tags[0]] + e[0, rows, tags[0]]
    sums = {k: np.zeros_like(v) for k, v in model.items()}
    de = np.exp(alpha + beta - total[None, :, None])
    for t in range(1, steps):
        gold += move[tags[t - 1], tags[t]] + e[t, rows, tags[t]]
        both = np.exp(alpha[t - 1][:, :, None] + move + (e[t] + beta[t] - total[:, None])[:, None, :])
        sums["move"] += both.sum(axis=0)
        np.add.at(sums["move"], (tags[t - 1], tags[t]), -1)
    sums["first"] += de[0].sum(axis=0)
    np.add.at(sums["first"], tags[0], -1)
    np.add.at(de, (np.arange(steps)[:, None], rows[None], tags), -1)
    sums["out"] += np.einsum("tbh,tbk->hk", h, de)
    sums["out_b"] += de.sum(axis=(0, 1))
    dh = de @ model["out"].T
    dx = (_lstm_back(model, "f", x, keep["f"], dh[:, :, :HIDDEN], sums)
          + _lstm_back(model, "b", x, keep["b"], dh[:, :, HIDDEN:], sums))
    np.add.at(sums["embed"], codes, dx)
    return float((total - gold).mean()), {k: v / batch for k, v in sums.items()}


def train(codes: np.ndarray, tags: np.ndarray, steps: int, batch: int, rate: float = 0.02, seed: int = 7) -> dict:
    """Adam over random batches of labelled windows (window, time)."""
    model, rng = new_model(seed), np.random.default_rng(seed)
    m, v = ({k: np.zeros_like(x) for k, x in model.items()} for _ in range(2))
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(codes), batch)
        _, grad = _loss_grad(model, codes[pick].T, tags[pick].T)
        norm = np.sqrt(sum((g * g).sum() for g in grad.values()))
        now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in grad.items():
            g = g * min(1.0, 5.0 / (norm + 1e-9))
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            model[k] = model[k] - now * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)
    return model


def decode(model: dict, codes: np.ndarray) -> np.ndarray:
    """Best tag paths of windows (window, time)."""
    x = model["embed"][codes.T]
    e = np.concatenate([_lstm(model, s, x, None) for s in "fb"], axis=2) @ model["out"] + model["out_b"]
    best, back = model["first"] + e[0], []
    for t in range(1, len(e)):
        paths = best[:, :, None] + model["move"]
        back.append(paths.argmax(axis=1))
        best = paths.max(axis=1) + e[t]
    tags = np.empty(codes.T.shape, np.int64)
    tags[-1] = best.argmax(axis=1)
    rows = np.arange(len(codes))
    for t in range(len(e) - 2, -1, -1):
        tags[t] = back[t][rows, tags[t + 1]]
    return tags.T


def spans_of(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the runs of one kind in a tag path."""
    out, start, kind = [], None, None
    for at in np.append(np.flatnonzero(tags), len(tags)).tolist():
        tag = int(tags[at]) if at < len(tags) else 0
        goes_on = tag and not tag & 1 and start is not None and kind == tag // 2 - 1 and at == stop  # noqa: F821
        if start is not None and not goes_on:
            out.append((kind, start, stop))
            start = None
        if tag:
            if start is None:
                start, kind = at, (tag - 1) // 2
            stop = at + 1
    return out
