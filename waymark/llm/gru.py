"""A gated recurrent layer in numpy, forward and backward through time, and the Adam step; float32 throughout.

The inputs come as sums already multiplied by the input weights, one row of 3 x H per position (update, reset,
candidate): for symbols that is a lookup in a table, which is trained itself.
"""

from __future__ import annotations

import numpy as np

Weights = dict[str, np.ndarray]


def uniform(rng: np.random.Generator, *shape: int) -> np.ndarray:
    bound = shape[0] ** -0.5
    return rng.uniform(-bound, bound, shape).astype(np.float32)


def apart(rows: np.ndarray) -> np.ndarray:
    """Update, reset and candidate parts of rows of 3 x H as three arrays in one: what is computed with them is then in a piece.

    Those of the gates are halved, as their logistic function by tanh asks for.
    """
    out = np.array(np.moveaxis(rows.reshape(*rows.shape[:-1], 3, -1), -2, 0), order="C")
    out[:2] *= 0.5
    return out


def _step(x: np.ndarray, h: np.ndarray, U: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    from_state = np.matmul(h, U)
    from_state += b
    gates = x[:2] + from_state[:2]
    np.tanh(gates, out=gates)
    gates += 1
    gates *= 0.5
    share = from_state[2]
    candidate = gates[1] * share
    candidate += x[2]
    np.tanh(candidate, out=candidate)
    out = candidate - h
    out *= gates[0]
    out += h
    return out, gates, candidate, share


def _biases(b: np.ndarray, batch: int) -> np.ndarray:
    """The bias of each part, for all rows of a batch."""
    return np.repeat(apart(b)[:, None], batch, axis=1)


def step(x: np.ndarray, h: np.ndarray, U: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The next state and, for the way back, the gates (update, reset), the candidate and the state's share of it."""
    return _step(apart(x), h, apart(U), _biases(b, len(h)))


def forward(xs: np.ndarray, h: np.ndarray, U: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The states after each position of (time, batch, 3H) inputs, which may already be set `apart`."""
    xs = apart(xs) if xs.ndim == 3 else xs
    out = np.empty((xs.shape[1], *h.shape), np.float32)
    U, b = apart(U), _biases(b, len(h))
    for t in range(len(out)):
        h = out[t] = _step(xs[:, t], h, U, b)[0]
    return out


def train_forward(xs: np.ndarray, h: np.ndarray, U: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, tuple]:
    """The states, and what the way back needs: states before, gates, candidates and state shares of all positions."""
    xs = apart(xs) if xs.ndim == 3 else xs
    steps, (batch, size) = xs.shape[1], h.shape
    states, gates = np.empty((steps + 1, batch, size), np.float32), np.empty((2, steps, batch, size), np.float32)
    candidates, shares = np.empty((steps, batch, size), np.float32), np.empty((steps, batch, size), np.float32)
    states[0] = h
    U, b = apart(U), _biases(b, batch)
    for t in range(steps):
        states[t + 1], gates[:, t], candidates[t], shares[t] = _step(xs[:, t], states[t], U, b)
    return states[1:], (states[:-1], gates, candidates, shares)


def backward(d_out: np.ndarray, kept: tuple, U: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradients of the inputs (time, batch, 3H), of U and of b from those of the states; what came before the first is a constant."""
    steps, batch, size = d_out.shape
    before, (update, reset), candidates, shares = kept
    # What does not depend on the way back, for all positions at once.
    keep = 1 - update
    to_update = candidates - before
    to_update *= update * keep
    to_candidate = update - update * (candidates * candidates)
    to_reset = shares * (reset - reset * reset)
    d_xs = np.empty((steps, batch, 3 * size), np.float32)
    d_candidates = np.empty((steps, batch, size), np.float32)
    back = np.ascontiguousarray(U.T)
    d_h = np.zeros((batch, size), np.float32)
    for t in range(steps - 1, -1, -1):
        d_h += d_out[t]
        d_state, d_candidate = d_xs[t], d_candidates[t]
        np.multiply(d_h, to_candidate[t], out=d_candidate)
        np.multiply(d_h, to_update[t], out=d_state[:, :size])
        np.multiply(d_candidate, to_reset[t], out=d_state[:, size:2 * size])
        np.multiply(d_candidate, reset[t], out=d_state[:, 2 * size:])
        d_h *= keep[t]
        d_h += d_state @ back
    # Up to here those of the states' part, which has the reset in its candidate.
    flat = d_xs.reshape(-1, 3 * size)
    d_U, d_b = before.reshape(-1, size).T @ flat, flat.sum(0)
    d_xs[:, :, 2 * size:] = d_candidates
    return d_xs, d_U, d_b


class Adam:
    """Adam over named arrays; `rows` updates only some rows of a table."""

    def __init__(self, weights: Weights, rate: float) -> None:
        self.weights, self.rate, self.steps = weights, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in weights.items()}
        self.square = {k: np.zeros_like(v) for k, v in weights.items()}

    def update(self, gradients: Weights, rows: dict[str, np.ndarray] | None = None, scale: float = 1.0) -> None:
        self.steps += 1
        rate = self.rate * scale * (1 - 0.999 ** self.steps) ** 0.5 / (1 - 0.9 ** self.steps)
        for name, gradient in gradients.items():
            at = rows[name] if rows and name in rows else slice(None)
            mean, square = self.mean[name][at], self.square[name][at]
            mean *= 0.9
            mean += 0.1 * gradient
            square *= 0.999
            part = 0.001 * gradient
            part *= gradient
            square += part
            # Chosen rows are copies, whole tables are not.
            if rows and name in rows:
                self.mean[name][at], self.square[name][at] = mean, square
            change = np.sqrt(square)
            change += 1e-8
            np.divide(rate * mean, change, out=change)
            self.weights[name][at] -= change


def packed(weights: Weights) -> bytes:
    import io

    file = io.BytesIO()
    np.savez(file, **weights)
    return file.getvalue()


def unpacked(data: bytes) -> Weights:
    import io

    with np.load(io.BytesIO(data)) as arrays:
        return {name: arrays[name] for name in arrays.files}
