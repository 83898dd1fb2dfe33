"""Forward and backward pass of a small fully connected network, per batch of rows."""

import numpy as np

Layers = list[tuple[np.ndarray, np.ndarray]]


def sizes(widths: list[int]) -> int:
    return sum(a * b + b for a, b in zip(widths, widths[1:]))


def unpack(flat: np.ndarray, widths: list[int]) -> Layers:
    layers, at = [], 0
    for a, b in zip(widths, widths[1:]):
        layers.append((flat[at:at + a * b].reshape(a, b), flat[at + a * b:at + a * b + b]))
        at += a * b + b
    return layers


def pack(layers: Layers) -> np.ndarray:
    return np.concatenate([np.concatenate([np.asarray(w, dtype=float).ravel(), np.asarray(b, dtype=float)]) for w, b in layers])


def glorot(widths: list[int], seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return pack([(rng.uniform(-1, 1, (a, b)) * np.sqrt(6.0 / (a + b)), np.zeros(b)) for a, b in zip(widths, widths[1:])])


def activate(z: np.ndarray, output: str) -> np.ndarray:
    if output == "softmax":
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)
    if output == "sigmoid":
        return 1.0 / (1.0 + np.exp(-z))
    if output == "relu":
        return np.maximum(z, 0.0)
    return z


def predict(layers: Layers, x: np.ndarray, output: str) -> np.ndarray:
    for w, b in layers[:-1]:
        x = np.maximum(x @ w + b, 0.0)
    w, b = layers[-1]
    return activate(x @ w + b, output)


def row_losses(out: np.ndarray, y: np.ndarray, output: str) -> tuple[float, float]:
    """Summed loss and number of correct rows (0 for a regression)."""
    if output == "softmax":
        picked = out[np.arange(len(y)), y.astype(np.int64)]
        return float(-np.log(np.clip(picked, 1e-7, 1 - 1e-7)).sum()), float((out.argmax(axis=1) == y).sum())
    if output == "sigmoid":
        p = np.clip(out[:, 0], 1e-7, 1 - 1e-7)
        return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()), float(((out[:, 0] > 0.5) == y).sum())
    return float(((out[:, 0] - y) ** 2).sum()), 0.0


def gradient(flat: np.ndarray, widths: list[int], x: np.ndarray, y: np.ndarray, output: str, dropout: float, rng):
    """Mean gradient of one mini-batch, its summed loss and correct count."""
    layers = unpack(flat, widths)
    inputs, masks = [x], []
    for w, b in layers[:-1]:
        hidden = np.maximum(inputs[-1] @ w + b, 0.0)
        mask = (rng.random(hidden.shape) >= dropout) / (1.0 - dropout) if dropout else None
        masks.append(mask)
        inputs.append(hidden if mask is None else hidden * mask)
    out = activate(inputs[-1] @ layers[-1][0] + layers[-1][1], output)
    loss, correct = row_losses(out, y, output)
    n = len(y)
    if output == "softmax":
        delta = out.copy()
        delta[np.arange(n), y.astype(np.int64)] -= 1.0
    else:
        delta = out - y[:, None]
        if output == "linear":
            delta *= 2.0
    delta /= n
    grads = []
    for i in range(len(layers) - 1, -1, -1):
        grads.append((inputs[i].T @ delta, delta.sum(axis=0)))
        if i:
            delta = (delta @ layers[i][0].T) * (inputs[i] > 0)
            if masks[i - 1] is not None:
                delta = delta * masks[i - 1]
    return pack(grads[::-1]), loss, correct


def matrix(column) -> np.ndarray:
    """An Arrow column of vectors as (rows, values); all must be present, complete and of one length."""
    lengths = column.value_lengths().unique().to_pylist()
    values = column.flatten()
    if len(lengths) != 1 or lengths[0] is None or values.null_count:
        raise ValueError(f"vectors need one length and no missing values; lengths here: {sorted(lengths, key=str)}, missing values: {values.null_count}")
    return values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), lengths[0])


def scrambled(x: np.ndarray) -> np.ndarray:
    """64-bit numbers mixed so that neighbours share nothing (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class RowDraws:
    """Uniforms of (seed, epoch, row number, layer, unit): the same whichever worker holds the row."""

    def __init__(self, seed: int, epoch: int, rows: np.ndarray):
        start = scrambled(np.array([seed], dtype=np.int64).view(np.uint64)) + np.uint64(epoch)
        self._rows = scrambled(scrambled(start) + rows.astype(np.uint64))

    def random(self, shape: tuple[int, int]) -> np.ndarray:
        """The next layer's uniforms, one per row and unit."""
        self._rows = scrambled(self._rows + np.uint64(1))
        units = scrambled(self._rows[:, None] + np.arange(1, shape[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        return (units >> np.uint64(11)) * 2.0**-53
