"""A gated recurrent language model in numpy: class-factored softmax, truncated backpropagation through time.

A token is one of ``head`` frequent words (in classes of CLASS words each) or one of ``tails`` classes of rarer words, within
which the caller knows the distribution. P(token) = P(class | state) and, for a head word, P(word | class, state).
"""

from __future__ import annotations

import numpy as np

#: state size, words in a class, lanes and steps of a training window, step size of Adagrad
STATE, CLASS, LANES, STEPS, RATE = 16, 32, 512, 16, 0.08
#: weights of the outputs stay within this, so that no logit passes STATE * LIMIT and its exponential fits a float32
LIMIT = 4.0


def initial(head: int, tails: int, log_word: np.ndarray, log_class: np.ndarray, seed: int = 1) -> dict[str, np.ndarray]:
    """Parameters that give the unigram distribution: biases are log frequencies (very low where a class has fewer words)."""
    rnd = np.random.default_rng(seed)
    small = lambda *shape: rnd.normal(0, 0.1, shape).astype(np.float32)
    classes = head // CLASS + tails
    return {"x": small(head + tails, 3 * STATE), "u": small(STATE, 3 * STATE), "c": np.zeros((STATE, classes), np.float32), "cb": log_class.astype(np.float32),
            "w": np.zeros((head // CLASS, STATE, CLASS), np.float32), "wb": log_word.reshape(-1, CLASS).astype(np.float32)}


def class_of(tokens: np.ndarray, head: int) -> np.ndarray:
    return np.where(tokens < head, tokens // CLASS, tokens - head + head // CLASS)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)), overwriting x."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def step(p: dict, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(new state, gates z and r, candidate, the candidate's recurrent part) for inputs ``x`` (rows of p["x"]) and states."""
    u = h @ p["u"]
    un = u[:, 2 * STATE :].copy()
    zr = _sigmoid(x[:, : 2 * STATE] + u[:, : 2 * STATE])
    n = zr[:, STATE:] * un
    n += x[:, 2 * STATE :]
    n += n
    n = _sigmoid(n)  # tanh(a) = 2 sigmoid(2a) - 1
    n += n
    n -= 1
    new = h - n
    new *= zr[:, :STATE]
    new += n
    return new, zr, n, un


def _softmax(z: np.ndarray) -> np.ndarray:
    """Overwrites logits by probabilities."""
    np.exp(z, out=z)
    z *= np.reciprocal(_sums(z))[:, None]
    return z


def _sums(z: np.ndarray) -> np.ndarray:
    return z @ np.ones(z.shape[1], z.dtype)


def _by_class(tokens: np.ndarray, cls: np.ndarray, head: int):
    """(class, rows) of the head words."""
    own = np.flatnonzero(tokens < head)
    own = own[np.argsort(cls[own].astype(np.int16), kind="stable")]
    ends = np.searchsorted(cls[own], np.arange(head // CLASS + 1))
    for k in np.flatnonzero(np.diff(ends)):
        yield int(k), own[ends[k] : ends[k + 1]]


def log_probs(p: dict, states: np.ndarray, tokens: np.ndarray, head: int) -> np.ndarray:
    """Natural log probability of each token (of its class, where the class is a tail)."""
    cls = class_of(tokens, head)
    z = states @ p["c"]
    z += p["cb"]
    out = z[np.arange(len(z)), cls].astype(np.float64)
    np.exp(z, out=z)
    out -= np.log(_sums(z))
    for k, rows in _by_class(tokens, cls, head):
        z = states[rows] @ p["w"][k]
        z += p["wb"][k]
        own = z[np.arange(len(z)), tokens[rows] % CLASS].astype(np.float64)
        np.exp(z, out=z)
        out[rows] += own - np.log(_sums(z))
    return out


def score(p: dict, tokens: np.ndarray, bounds: np.ndarray, head: int, start: int, room: int = 1 << 15) -> np.ndarray:
    """Log probability of each whole sequence tokens[bounds[i]:bounds[i + 1]]; the first token follows ``start``.

    All sequences go step by step together, the longest first, so that those still running are the first rows; states are
    carried from window to window, ``room`` tokens at a time.
    """
    sizes = np.diff(bounds)
    by = np.argsort(-sizes, kind="stable")
    first, sizes = bounds[:-1][by], sizes[by]
    out, h, t = np.zeros(len(by)), np.zeros((len(by), STATE), np.float32), 0
    running = np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0), "left")  # at step t: those longer than t
    while t < len(running):
        states, at, rows, n = [], [], [], 0
        while t < len(running) and n < room:
            k = int(running[t])
            spot = first[:k] + t
            x = p["x"].take(tokens[spot - 1] if t else np.full(k, start), 0)
            states.append(h)
            h = h[:k]
            states[-1] = h = step(p, x, h)[0]
            at.append(spot)
            rows.append(k)
            n += k
            t += 1
        # the state after reading the token before predicts this one
        spot = np.concatenate(at)
        lp = log_probs(p, np.concatenate(states), tokens[spot], head)
        a = 0
        for k in rows:
            out[:k] += lp[a : a + k]
            a += k
    whole = np.zeros(len(by))
    whole[by] = out
    return whole


def gradients(p: dict, h: np.ndarray, before: np.ndarray, tokens: np.ndarray, keep: np.ndarray, head: int) -> tuple[dict, np.ndarray, float]:
    """(mean gradients, last state, mean loss) of one window: ``tokens`` (steps x lanes) after ``before``; a state is forgotten where ``keep`` is 0.

    Input rows are given as (rows, gradients): only words of the window have one.
    """
    steps, lanes = tokens.shape
    kept, cache, states = [], [], np.empty((steps, lanes, STATE), np.float32)
    for t in range(steps):
        h = h * keep[t][:, None]
        kept.append(h)
        h, zr, n, un = step(p, p["x"].take(before[t], 0), h)
        cache.append((zr, n, un))
        states[t] = h
    flat, y = states.reshape(-1, STATE), tokens.ravel()
    cls, count = class_of(y, head), len(y)
    q = flat @ p["c"]
    q += p["cb"]
    q = _softmax(q)
    loss = -np.log(np.maximum(q[np.arange(count), cls], 1e-30)).sum()
    q[np.arange(count), cls] -= 1
    q /= count
    g = {"c": flat.T @ q, "cb": q.sum(0), "w": np.zeros_like(p["w"]), "wb": np.zeros_like(p["wb"])}
    d = q @ p["c"].T
    for k, rows in _by_class(y, cls, head):
        own = flat[rows]
        z = own @ p["w"][k]
        z += p["wb"][k]
        z = _softmax(z)
        pick = np.arange(len(rows)), y[rows] % CLASS
        loss -= np.log(np.maximum(z[pick], 1e-30)).sum()
        z[pick] -= 1
        z /= count
        g["w"][k], g["wb"][k] = own.T @ z, z.sum(0)
        d[rows] += z @ p["w"][k].T
    d = d.reshape(steps, lanes, STATE)
    dx, du = np.empty((steps, lanes, 3 * STATE), np.float32), np.empty((steps, lanes, 3 * STATE), np.float32)
    later = np.zeros((lanes, STATE), np.float32)
    for t in range(steps - 1, -1, -1):
        (zr, n, un), old = cache[t], kept[t]
        z, r = zr[:, :STATE], zr[:, STATE:]
        dh = d[t] + later
        dn = dh * (1 - z) * (1 - n * n)
        dx[t, :, :STATE] = dh * (old - n) * z * (1 - z)
        dx[t, :, STATE : 2 * STATE] = dn * un * r * (1 - r)
        dx[t, :, 2 * STATE :] = dn
        du[t] = dx[t]
        du[t, :, 2 * STATE :] *= r
        later = (dh * z + du[t] @ p["u"].T) * keep[t][:, None]
    g["u"] = np.concatenate(kept).T @ du.reshape(-1, 3 * STATE)
    by = np.argsort(before.ravel().astype(np.int16), kind="stable")
    rows, first = np.unique(before.ravel()[by], return_index=True)
    g["x"] = rows, np.add.reduceat(dx.reshape(-1, 3 * STATE)[by], first, axis=0)
    return g, h, float(loss / count)


def descend(p: dict, squares: dict, g: dict, rate: float = RATE) -> None:
    """A step of Adagrad, in place."""
    for name, d in g.items():
        if name == "x":
            rows, d = d
            squares["x"][rows] += d * d
            p["x"][rows] -= rate * d / (np.sqrt(squares["x"][rows]) + 1e-8)
        else:
            squares[name] += d * d
            p[name] -= rate * d / (np.sqrt(squares[name]) + 1e-8)
    for name in ("c", "w"):
        np.clip(p[name], -LIMIT, LIMIT, out=p[name])


def train(p: dict, squares: dict, tokens: np.ndarray, bounds: np.ndarray, head: int, start: int, lanes: int = LANES, steps: int = STEPS) -> float:
    """One pass over whole sequences, in place; returns the sum of losses.

    Sequences lie end to end in lanes of one length, read window by window with the state carried over; a state is forgotten
    where a sequence begins. Every token is learned from once.
    """
    if not len(tokens):
        return 0.0
    lanes = max(1, min(lanes, len(tokens) // (4 * steps)))
    size = -(-len(tokens) // lanes)
    before = np.empty_like(tokens)
    before[0], before[1:] = start, tokens[:-1]
    before[bounds[:-1][np.diff(bounds) > 0]] = start
    keep = np.ones(len(tokens), np.float32)
    keep[bounds[:-1][np.diff(bounds) > 0]] = 0
    lane = np.arange(lanes) * size
    keep[lane[lane < len(tokens)]] = 0
    h, total = np.zeros((lanes, STATE), np.float32), 0.0
    for t in range(0, size, steps):
        at = lane + np.arange(t, min(t + steps, size))[:, None]
        own = lane + min(t + steps, size) <= len(tokens)  # the last lanes are shorter
        if not own.all():
            rest = [at[:, k][at[:, k] < len(tokens)] for k in np.flatnonzero(~own)]
            for k, r in zip(np.flatnonzero(~own), rest, strict=True):
                if len(r):
                    g, _, loss = gradients(p, h[k : k + 1], before[r][:, None], tokens[r][:, None], keep[r][:, None], head)
                    descend(p, squares, g)
                    total += loss * len(r)
        if own.any():
            a = at[:, own]
            g, h_own, loss = gradients(p, h[own], before[a], tokens[a], keep[a], head)
            h = h.copy()
            h[own] = h_own
            descend(p, squares, g)
            total += loss * a.size
    return total
