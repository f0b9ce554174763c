"""A gated recurrent language model over output units, in numpy.

Units are words, tail buckets and the end; unit ``u`` belongs to class
``u // size``. The softmax is factored: class given state, then unit given class
and state, so a token costs two short rows instead of one of all units.
Training is truncated back-propagation: states pass from window to window,
gradients stop at a window's start. All parameters are float32 arrays.
"""

from __future__ import annotations

import numpy as np

NAMES = ("embed", "wx", "bx", "u", "wc", "bc", "wo", "bo")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """Overwrites ``x``."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def initial(mass: np.ndarray, size: int, hidden: int, seed: int = 3) -> dict[str, np.ndarray]:
    """Parameters whose output starts close to the given probability mass of the units (a multiple of ``size``)."""
    rng = np.random.default_rng(seed)
    units = len(mass)
    mass = np.maximum(mass, 1e-12)
    by_class = mass.reshape(-1, size).sum(1)
    draw = lambda *shape: rng.normal(0, 0.15, shape).astype(np.float32)
    return {
        "embed": draw(units, hidden), "wx": draw(hidden, 3 * hidden), "bx": np.zeros(3 * hidden, np.float32),
        "u": draw(hidden, 3 * hidden), "wc": draw(hidden, len(by_class)) * 0.3,
        "bc": np.log(by_class).astype(np.float32), "wo": draw(units, hidden) * 0.3,
        "bo": (np.log(mass) - np.repeat(np.log(by_class), size)).astype(np.float32),
    }


def _steps(p, gates, h):
    """(states before the first step and after each, z, r, c, the state's part of c) of all steps; ``gates`` (T, B, 3H) is the input's part."""
    n = h.shape[1]
    states = np.empty((len(gates) + 1, *h.shape), h.dtype)
    z, r, c, own = (np.empty_like(states[1:]) for _ in range(4))
    states[0] = h
    for t, g in enumerate(gates):
        a = states[t] @ p["u"]
        own[t] = a[:, 2 * n:]
        x = _sigmoid(np.add(a[:, :2 * n], g[:, :2 * n]))
        z[t], r[t] = x[:, :n], x[:, n:]
        y = np.multiply(r[t], own[t], out=c[t])
        y += g[:, 2 * n:]
        np.tanh(y, out=y)
        new = np.subtract(states[t], y, out=states[t + 1])
        new *= z[t]
        new += y
    return states, z, r, c, own


def _exps(x: np.ndarray, w: np.ndarray, small: bool) -> np.ndarray:
    """exp of each row of ``x @ w`` up to a factor of its own; ``small`` says that no logit is too large as it is."""
    e = x @ w
    if not small:
        e -= e.max(1, keepdims=True)
    return np.exp(e, out=e)


def _short(units: np.ndarray) -> np.ndarray:
    """Units as 16-bit numbers where they are, which are sorted by their digits."""
    return units.astype(np.uint16) if len(units) and units.max() < 1 << 16 else units


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, starts) of the runs of a sorted array."""
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return values[starts], starts


def _outputs(p, flat: np.ndarray, want: np.ndarray, size: int):
    """(log-likelihood, gradient to the states, gradients of wc, bc, wo, bo) of the two factors of the softmax.

    Rows are put in the order of their unit, so a class is a slice. A softmax's
    gradient is its probabilities less one at what was wanted.
    """
    n = flat.shape[1]
    order = np.argsort(_short(want), kind="stable")
    want = want[order]
    states = np.empty((len(order), n + 1), flat.dtype)
    states[:, :n] = flat.take(order, axis=0)
    states[:, n] = 1
    wc = np.concatenate([p["wc"], p["bc"][None]])
    wo = np.concatenate([p["wo"], p["bo"][:, None]], 1)
    # states lie in (-1, 1), which bounds every logit
    small = max(np.abs(wc).sum(0).max(), (np.abs(wo) @ np.ones(n + 1, wo.dtype)).max()) < 80
    cls = want // size
    within = want - cls * size
    present, first = _runs(cls)
    rows, ones = np.arange(len(want)), np.ones(max(size, wc.shape[1]), flat.dtype)
    got = np.empty((2, len(want)), flat.dtype)

    def error(e, at, own, out):
        """Turns exponentials into probabilities less one where wanted; the wanted probabilities go to ``out``."""
        e *= (1 / (e @ ones[:e.shape[1]]))[:, None]
        hit = e[own, at]
        out[:] = hit
        e[own, at] = hit - 1
        return e

    e = error(_exps(states, wc, small), cls, rows, got[0])
    gc = states.T @ e
    back = e @ np.ascontiguousarray(wc.T)
    go = np.zeros_like(wo)
    for c, s, t in zip(present, first, [*first[1:], len(want)]):
        own, block = states[s:t], wo[c * size:(c + 1) * size]
        e = error(_exps(own, block.T, small), within[s:t], rows[:t - s], got[1, s:t])
        np.matmul(e.T, own, out=go[c * size:(c + 1) * size])
        back[s:t] += e @ block
    out = np.empty((len(want), n), flat.dtype)
    out[order] = back[:, :n]
    return float(np.log(got).sum()), out, {"wc": gc[:n], "bc": gc[n], "wo": go[:, :n], "bo": go[:, n]}


def train_window(p, state, size, inputs, targets, rate, h):
    """One update on a window; ``inputs``, ``targets`` (T, B), target -1 is none. Returns (state, log-likelihood)."""
    length, batch = inputs.shape
    n = h.shape[1]
    x = p["embed"].take(inputs, axis=0)
    states, z, r, c, own = _steps(p, x @ p["wx"] + p["bx"], h)
    hs, befores = states[1:], states[:-1]
    live = targets.ravel() >= 0
    if not live.any():
        return hs[-1], 0.0
    whole = live.all()
    total, back, outer = _outputs(p, hs.reshape(-1, n) if whole else hs.reshape(-1, n)[live], targets.ravel()[live], size)
    into = back
    if not whole:
        into = np.zeros((length * batch, n), hs.dtype)
        into[live] = back
    into = into.reshape(length, batch, 1, n)
    # what a state's gradient is multiplied by on its way to z, r and c, for all steps at once
    ways = np.empty((length, batch, 3, n), hs.dtype)
    to_c = (1 - z) * (1 - c * c)
    np.multiply(befores - c, z * (1 - z), out=ways[:, :, 0])
    np.multiply(to_c, own * r * (1 - r), out=ways[:, :, 1])
    np.multiply(to_c, r, out=ways[:, :, 2])
    carry, turned = np.zeros((batch, n), hs.dtype), np.ascontiguousarray(p["u"].T)
    for t in range(length - 1, -1, -1):
        d = into[t]
        d[:, 0] += carry
        ways[t] *= d
        carry = ways[t].reshape(batch, 3 * n) @ turned
        z[t] *= d[:, 0]
        carry += z[t]
    da = ways.reshape(-1, 3 * n)
    grads = {"wc": outer["wc"], "bc": outer["bc"], "u": befores.reshape(-1, n).T @ da}
    # the input's part of c is not scaled by r
    np.multiply(into[:, :, 0], to_c, out=ways[:, :, 2])
    grads |= {"wx": x.reshape(-1, n).T @ da, "bx": np.ones(len(da), da.dtype) @ da}
    dx = da @ p["wx"].T
    for name in ("wo", "bo"):
        _adapt(p[name], state[name], outer[name] / batch, rate)
    for name, g in grads.items():
        g = g / batch
        norm = float(np.sqrt((g * g).sum()))
        _adapt(p[name], state[name], g if norm < 5 else g * (5 / norm), rate)
    order = np.argsort(_short(inputs.ravel()), kind="stable")
    ids, first = _runs(inputs.ravel()[order])
    g = np.add.reduceat(dx.take(order, axis=0), first) / batch
    sums = state["embed"].take(ids, axis=0)
    sums += g * g
    state["embed"][ids] = sums
    p["embed"][ids] -= rate * g / np.sqrt(sums)
    return hs[-1], total


def _adapt(p: np.ndarray, state: np.ndarray, g: np.ndarray, rate: float) -> None:
    """One step of ``p`` against ``g``, by the sums of squares ``state``; all in place, ``g`` too."""
    root = g * g
    state += root
    np.sqrt(state, out=root)
    g *= rate
    g /= root
    p -= g


def fresh_state(p) -> dict[str, np.ndarray]:
    """Sums of squared gradients for the step sizes, before any."""
    return {k: np.full_like(v, 1e-3) for k, v in p.items()}


def train_segments(p, state, size, segments, rate, window=32, batch=32) -> tuple[float, int]:
    """Train on unit sequences (each begins with what precedes its first target). Returns (log-likelihood, tokens)."""
    total, tokens = 0.0, 0
    hidden = p["u"].shape[0]
    for s in range(0, len(segments), batch):
        part = segments[s:s + batch]
        longest = max(len(x) for x in part) - 1
        grid = np.full((longest + 1, len(part)), -1, np.int64)
        for k, x in enumerate(part):
            grid[:len(x), k] = x
        h = np.zeros((len(part), hidden), p["u"].dtype)
        for t in range(0, longest, window):
            inputs, targets = grid[t:t + window + 1][:-1], grid[t:t + window + 1][1:]
            h, ll = train_window(p, state, size, np.maximum(inputs, 0), targets, rate, h)
            total += ll
            tokens += int((targets >= 0).sum())
    return total, tokens


class Scorer:
    """Natural-log likelihood of whole unit sequences, many at once."""

    def __init__(self, p: dict[str, np.ndarray], size: int, start: int, step_tokens: int = 1 << 16):
        self.p, self.size, self.start, self.step_tokens = p, size, start, step_tokens
        self.gates = p["embed"] @ p["wx"] + p["bx"]
        # states lie in (-1, 1), which bounds every score; float32 holds exp up to 88
        highest = max((np.abs(p["wc"]).sum(0) + p["bc"]).max(), (np.abs(p["wo"]).sum(1) + p["bo"]).max())
        self.small = bool(highest < 80)

    def _outputs(self, states: np.ndarray, want: np.ndarray) -> np.ndarray:
        p, size, n = self.p, self.size, self.p["u"].shape[0]
        cls = want // size
        x = states @ p["wc"]
        x += p["bc"]
        out = x[np.arange(len(want)), cls]
        out -= self._log_sum(x)
        wo, bo = p["wo"].reshape(-1, size, n), p["bo"].reshape(-1, size)
        order = np.argsort(_short(cls), kind="stable")
        present, first = _runs(cls[order])
        states, at = states.take(order, axis=0), (want - cls * size)[order]
        part = np.empty(len(want), np.float32)
        rows = np.arange(len(want))
        for c, s, e in zip(present, first, [*first[1:], len(want)]):
            x = states[s:e] @ wo[c].T
            x += bo[c]
            part[s:e] = x[rows[:e - s], at[s:e]]
            part[s:e] -= self._log_sum(x)
        out[order] += part
        return out

    def _log_sum(self, x: np.ndarray) -> np.ndarray:
        """log of the sum of exp over each row; overwrites ``x``."""
        if self.small:
            np.exp(x, out=x)
            return np.log(x @ np.ones(x.shape[1], np.float32))
        top = x.max(1)
        x -= top[:, None]
        np.exp(x, out=x)
        return np.log(x.sum(1)) + top

    def score(self, sequences: list[np.ndarray]) -> np.ndarray:
        """One sum for each sequence of units; the state passes through its whole length."""
        total = np.zeros(len(sequences))
        lengths = np.array([len(s) for s in sequences], np.int64)
        order = np.argsort(-lengths, kind="stable")
        lengths = lengths[order]
        flat = np.concatenate([sequences[k] for k in order]) if len(order) else np.empty(0, np.int64)
        begin = np.cumsum(lengths) - lengths
        sums = np.zeros(len(order))
        n = self.p["u"].shape[0]
        h = np.zeros((len(order), n), np.float32)
        last = np.full(len(order), self.start, np.int64)
        at, live = 0, int((lengths > 0).sum())
        while live:
            steps = int(min(max(16, self.step_tokens // live), lengths[0] - at))
            rest = lengths[:live] - at
            place = begin[:live] + at + np.arange(steps)[:, None]
            valid = np.arange(steps)[:, None] < rest
            targets = np.where(valid, flat[np.minimum(place, len(flat) - 1)], 0)
            inputs = np.concatenate([last[None, :live], targets[:-1]])
            hs = np.empty((steps, live, n), np.float32)
            state = h[:live]
            for t in range(steps):
                a = state @ self.p["u"]
                g = self.gates.take(inputs[t], axis=0)
                zr = _sigmoid(np.add(a[:, :2 * n], g[:, :2 * n], out=g[:, :2 * n]))
                c = np.tanh(g[:, 2 * n:] + zr[:, n:] * a[:, 2 * n:])
                state = np.subtract(state, c, out=hs[t])
                state *= zr[:, :n]
                state += c
            own = np.nonzero(valid)
            logs = np.empty(len(own[0]))
            states, want = hs[own], targets[own]
            for s in range(0, len(want), 1 << 14):
                logs[s:s + (1 << 14)] = self._outputs(states[s:s + (1 << 14)], want[s:s + (1 << 14)])
            sums[:live] += np.bincount(own[1], logs, live)
            h[:live] = state
            last[:live] = targets[-1]
            at += steps
            live = int(np.searchsorted(-lengths, -at, "left"))
        total[order] = sums
        return total

