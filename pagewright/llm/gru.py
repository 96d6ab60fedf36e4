"""A gated recurrent language model in numpy: truncated backpropagation, class-factored output softmax, carried state.

P(word | past) = P(class | state) P(word | class, state). Words of the model are numbered by falling frequency and cut into classes of
CLASS_WORDS; two more classes hold one symbol each, `other` (any other word) and `end`, which also begins a text.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np

CLASS_WORDS, STATE, EMBED, STEPS = 64, 32, 24, 32
# Numbers of two settings of glibc's allocator.
_MMAP_THRESHOLD, _TRIM_THRESHOLD = -3, -1
_SETTLED = 1 << 15  # states whose probabilities are worked out together
_GROUP = 1024  # texts that are scored side by side
_TOP_LOGIT, _TINY = np.float32(75), np.float32(1e-30)
_CHUNK = 1 << 18  # symbols that are laid out side by side to be learned from
_LONG_RUN = 16  # rows that are added up by a matrix product
_BLOCK = 1 << 11  # states whose probabilities are held at once, few enough for a core's own memory


@dataclass
class Gru:
    """Weights: e (symbol, EMBED) inputs, p (EMBED, 3 STATE) and b what they add to the gates, u (STATE, 3 STATE), c and cb for classes, v and vb within classes."""

    n_words: int
    e: np.ndarray
    p: np.ndarray
    b: np.ndarray
    u: np.ndarray
    c: np.ndarray
    cb: np.ndarray
    v: np.ndarray
    vb: np.ndarray

    @property
    def other(self) -> int:
        return self.n_words

    @property
    def end(self) -> int:
        return self.n_words + 1

    @property
    def n_classes(self) -> int:
        return len(self.v) + 2

    @property
    def w(self) -> np.ndarray:
        """(symbol, 3 STATE): what each input adds to the gates."""
        return self.e @ self.p + self.b

    def weights(self) -> dict[str, np.ndarray]:
        return {k: getattr(self, k) for k in ("e", "p", "b", "u", "c", "cb", "v", "vb")}


def start(counts: np.ndarray, n_other: float, n_end: float, seed: int = 0) -> Gru:
    """A model that knows the counts of its words (by falling frequency), of other words and of ends, and nothing else."""
    n = len(counts)
    n_classes = max(1, -(-n // CLASS_WORDS))
    rng = np.random.default_rng(seed)
    padded = np.zeros(n_classes * CLASS_WORDS)
    padded[:n] = counts
    by_class = padded.reshape(n_classes, CLASS_WORDS)
    vb = np.where(np.arange(n_classes * CLASS_WORDS).reshape(by_class.shape) < n, np.log(by_class + 1e-3), -1e9)
    if not n:
        vb[0, 0] = 0.0
    vb -= np.log(np.maximum(by_class.sum(axis=1, keepdims=True), 1.0))
    mass = np.r_[by_class.sum(axis=1), n_other, n_end]
    mass /= max(1.0, mass.sum())
    f = lambda *shape, s=0.1: rng.normal(0, s, shape).astype(np.float32)
    return Gru(n, f(n + 2, EMBED, s=0.3), f(EMBED, 3 * STATE, s=EMBED**-0.5), np.zeros(3 * STATE, np.float32), f(STATE, 3 * STATE, s=STATE**-0.5), f(STATE, n_classes + 2, s=0.02), np.log(mass + 1e-9).astype(np.float32), f(n_classes, STATE, CLASS_WORDS, s=0.02), vb.astype(np.float32))


def _class_of(model: Gru, symbols: np.ndarray) -> np.ndarray:
    return np.where(symbols < model.n_words, symbols // CLASS_WORDS, len(model.v) + symbols - model.n_words)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)) in place; half the time of a hyperbolic tangent. An exp that overflows gives the right 0."""
    np.negative(x, out=x)
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
    x += x.dtype.type(1)
    return np.reciprocal(x, out=x)


def step(model: Gru, h: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The next state, h and x of as many rows; x: what the inputs add to the gates."""
    u = h @ model.u
    gates = _sigmoid(x[:, : 2 * STATE] + u[:, : 2 * STATE])
    n = gates[:, STATE:] * u[:, 2 * STATE :]
    n += x[:, 2 * STATE :]
    np.tanh(n, out=n)
    h = h - n
    h *= gates[:, :STATE]
    h += n
    return h


def _keep_memory() -> None:
    """Arrays of a window are freed and asked for again at every window: glibc keeps their memory instead of giving it back, which took a fifth of the time."""
    if sys.platform == "linux" and hasattr(libc := ctypes.CDLL(None), "mallopt"):
        for kind in _MMAP_THRESHOLD, _TRIM_THRESHOLD:
            libc.mallopt(kind, 1 << 30)


def _by_class(model: Gru, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class of each symbol, their order by class, where each class of words begins in it)."""
    cls = _class_of(model, symbols).astype(np.int32)
    order = np.argsort(cls.astype(np.uint16), kind="stable")
    return cls, order, np.searchsorted(cls[order], np.arange(len(model.v) + 1))


def _may_exceed(model: Gru) -> tuple[bool, np.ndarray]:
    """Whether a logit can pass _TOP_LOGIT, of classes and within each class: states lie in [-1, 1], so the weights bound it."""
    return bool((np.abs(model.c).sum(axis=0) + model.cb).max() > _TOP_LOGIT), (np.abs(model.v).sum(axis=1) + model.vb).max(axis=1) > _TOP_LOGIT


def _exp(logits: np.ndarray, bias: np.ndarray, bounded: bool) -> np.ndarray:
    """exp(logits + bias) in place; the bound only keeps a sum from overflowing."""
    logits += bias
    if bounded:
        np.minimum(logits, _TOP_LOGIT, out=logits)
    return np.exp(logits, out=logits)


def _sums(rows: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The sums of rows from each begin to the next. Long runs, most of the rows, are matrix products, ten times as fast."""
    lengths = np.diff(begins, append=len(rows))
    out, long = np.empty((len(begins), rows.shape[1]), rows.dtype), lengths >= _LONG_RUN
    for k in np.flatnonzero(long):
        out[k] = np.ones(lengths[k], rows.dtype) @ rows[begins[k] : begins[k] + lengths[k]]
    if not long.all():
        short = ~long
        rest = np.cumsum(lengths[short]) - lengths[short]
        out[short] = np.add.reduceat(rows[np.repeat(short, lengths)], rest)
    return out


def _blocks(begin: int, end: int) -> list[slice]:
    return [slice(k, min(k + _BLOCK, end)) for k in range(begin, end, _BLOCK)]


def _row_sums(p: np.ndarray) -> np.ndarray:
    return p @ np.ones(p.shape[1], p.dtype)  # a matrix product, several times as fast as a sum of short rows


def log_probs(model: Gru, h: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Natural logs of P(symbol | state)."""
    cls, order, edges = _by_class(model, symbols)
    any_large, large = _may_exceed(model)
    share, within = np.empty(len(cls), h.dtype), np.ones(len(cls), h.dtype)
    for at in _blocks(0, len(cls)):
        p = _exp(h[at] @ model.c, model.cb, any_large)
        share[at] = p[np.arange(len(p)), cls[at]] / _row_sums(p)
    h, own = h.take(order, axis=0), symbols[order]
    for k in np.flatnonzero(np.diff(edges)):
        for at in _blocks(edges[k], edges[k + 1]):
            p = _exp(h[at] @ model.v[k], model.vb[k], large[k])
            within[order[at]] = p[np.arange(len(p)), own[at] - k * CLASS_WORDS] / _row_sums(p)
    return np.log(share + _TINY) + np.log(within + _TINY)


def score(model: Gru, texts: list[np.ndarray]) -> np.ndarray:
    """Natural log probability of each text, a sequence of symbols that ends with `end`; states go from window to window to its end."""
    _keep_memory()
    total, inputs = np.zeros(len(texts)), model.w
    states, who, what, held = [], [], [], 0

    def settle() -> None:
        """Adds up the probabilities of all states so far: long texts, of which there are few, are put together over windows."""
        nonlocal held
        if held:
            total[:] += np.bincount(np.concatenate(who), log_probs(model, np.concatenate(states), np.concatenate(what)), len(texts))
        for x in (states, who, what):
            x.clear()
        held = 0

    by_length = np.argsort([-len(t) for t in texts], kind="stable")
    for g in range(0, len(texts), _GROUP):
        group = by_length[g : g + _GROUP]
        lengths = np.array([len(texts[k]) for k in group])
        h = np.zeros((len(group), STATE), np.float32)
        last = np.full(len(group), model.end)
        for at in range(0, int(lengths[0]), STEPS):
            n = int((lengths > at).sum())
            width = min(STEPS, int(lengths[0]) - at)
            target = np.full((n, width), -1)
            for k in range(n):
                piece = texts[group[k]][at : at + width]
                target[k, : len(piece)] = piece
            source = np.concatenate([last[:n, None], target[:, :-1]], axis=1)
            h = h[:n]
            for t in range(width):
                m = int((lengths > at + t).sum()) if lengths[n - 1] <= at + t else n
                h[:m] = step(model, h[:m], inputs[source[:m, t]])
                states.append(h[:m].copy())
                who.append(group[:m])
                what.append(target[:m, t])
                held += m
            if held >= _SETTLED:
                settle()
            last = target[:, -1]
    settle()
    return total


def _backward(model: Gru, h0: np.ndarray, source: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray], float]:
    """One window (rows, steps) of truncated backpropagation: the last state, the gradients of the mean loss, the loss."""
    rows, steps = source.shape
    size, kind, inputs, symbols = rows * steps, model.u.dtype, source.T.ravel(), target.T.ravel()
    goes_on = (source.T != model.end).astype(kind)[:, :, None]  # a text begins with no state
    by_symbol, source = model.w, inputs.reshape(steps, rows)
    before, states = np.empty((steps, rows, STATE), kind), np.empty((steps, rows, STATE), kind)
    gates, news, ups = np.empty((steps, rows, 2 * STATE), kind), np.empty((steps, rows, STATE), kind), np.empty((steps, rows, STATE), kind)
    h, u, x = h0, np.empty((rows, 3 * STATE), kind), np.empty((rows, 3 * STATE), kind)
    for t in range(steps):
        np.multiply(h, goes_on[t], out=before[t])
        np.matmul(before[t], model.u, out=u)
        by_symbol.take(source[t], axis=0, out=x, mode="clip")
        g, n = gates[t], news[t]
        np.add(x[:, : 2 * STATE], u[:, : 2 * STATE], out=g)
        _sigmoid(g)
        ups[t] = u[:, 2 * STATE :]
        np.multiply(g[:, STATE:], ups[t], out=n)
        n += x[:, 2 * STATE :]
        np.tanh(n, out=n)
        h = states[t]
        np.subtract(before[t], n, out=h)
        h *= g[:, :STATE]
        h += n
    last, flat = h.copy(), states.reshape(size, STATE)

    grads = {k: np.zeros_like(getattr(model, k)) for k in ("e", "c", "cb", "v", "vb")}
    cls, order, edges = _by_class(model, symbols)
    any_large, large = _may_exceed(model)
    loss, d_states, d_own = 0.0, np.empty((size, STATE), kind), np.zeros((size, STATE), kind)
    by_class, own = flat.take(order, axis=0), symbols[order]

    def learn(x: np.ndarray, weights: np.ndarray, bias: np.ndarray, bounded: bool, aim: np.ndarray, d_weights: np.ndarray, d_bias: np.ndarray) -> np.ndarray:
        """Adds up what a block of states gives for a softmax over aims; what goes back to the states."""
        nonlocal loss
        p, at = _exp(x @ weights, bias, bounded), np.arange(len(x))
        p *= (1 / _row_sums(p))[:, None]
        loss -= float(np.log(p[at, aim] + _TINY).sum())
        p[at, aim] -= 1
        d_weights += x.T @ p
        d_bias += np.ones(len(x), kind) @ p
        return p @ weights.T

    for at in _blocks(0, size):
        d_states[at] = learn(flat[at], model.c, model.cb, any_large, cls[at], grads["c"], grads["cb"])
    for k in np.flatnonzero(np.diff(edges)):
        for at in _blocks(edges[k], edges[k + 1]):
            d_own[at] = learn(by_class[at], model.v[k], model.vb[k], large[k], own[at] - k * CLASS_WORDS, grads["v"][k], grads["vb"][k])
    place = np.empty_like(order)
    place[order] = np.arange(size)
    d_states += d_own.take(place, axis=0)
    d_states = d_states.reshape(steps, rows, STATE)

    # Step by step, each array of a step small enough for a core's own memory.
    for k in ("u", "p", "b"):
        grads[k] = np.zeros_like(getattr(model, k))
    d_e, u_t, p_t, ones = np.empty((steps, rows, EMBED), kind), np.ascontiguousarray(model.u.T), np.ascontiguousarray(model.p.T), np.ones(rows, kind)
    d_x, d, d_h = np.empty((rows, 3 * STATE), kind), np.empty((rows, 3 * STATE), kind), np.zeros((rows, STATE), kind)
    one, d_n, rest, back, by_input = kind.type(1), np.empty((rows, STATE), kind), np.empty((rows, STATE), kind), np.empty((rows, STATE), kind), np.empty((rows, EMBED), kind)
    for t in reversed(range(steps)):
        d_h += d_states[t]
        n, z, r = news[t], gates[t, :, :STATE], gates[t, :, STATE:]
        np.subtract(one, z, out=rest)
        np.multiply(n, n, out=d_n)
        np.subtract(one, d_n, out=d_n)
        d_n *= rest
        d_n *= d_h
        np.subtract(before[t], n, out=back)
        back *= z
        back *= rest
        np.multiply(back, d_h, out=d[:, :STATE])
        np.multiply(ups[t], r, out=back)
        np.subtract(one, r, out=rest)
        back *= rest
        np.multiply(back, d_n, out=d[:, STATE : 2 * STATE])
        np.multiply(d_n, r, out=d[:, 2 * STATE :])
        d_x[:, : 2 * STATE], d_x[:, 2 * STATE :] = d[:, : 2 * STATE], d_n
        model.e.take(source[t], axis=0, out=by_input, mode="clip")
        grads["u"] += before[t].T @ d
        grads["p"] += by_input.T @ d_x
        grads["b"] += ones @ d_x
        np.matmul(d_x, p_t, out=d_e[t])
        d_h *= z
        np.matmul(d, u_t, out=back)
        d_h += back
        d_h *= goes_on[t]
    order = np.argsort(inputs.astype(np.uint16), kind="stable")
    begins = np.flatnonzero(np.diff(inputs[order], prepend=-1))
    grads["e"][inputs[order[begins]]] = _sums(d_e.reshape(size, EMBED).take(order, axis=0), begins)
    for g in grads.values():
        g *= kind.type(1 / size)
    return last, grads, loss / size


def fit(model: Gru, texts: Iterable[np.ndarray], rows: int = 512, rate: float = 0.01, clip: float = 1.0) -> tuple[int, float]:
    """One pass of Adam over windows of STEPS symbols of `rows` parallel streams of texts: (symbols, mean loss). Same texts, same model.

    Texts are taken as they come, _CHUNK symbols at a time, so there can be any number of them; every symbol is a target once.
    """
    _keep_memory()
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.weights().items()}
    n, seen, loss, full = 0, 0, 0.0, 1

    def train(stream: np.ndarray) -> np.ndarray:
        """Trains on the stream's symbols after the first; what is left of it, under a symbol for each row."""
        nonlocal n, seen, loss, full
        across = max(1, min(rows, (len(stream) - 1) // (16 * STEPS)))
        length = (len(stream) - 1) // across
        source, target = (stream[k : across * length + k].reshape(across, length) for k in (0, 1))
        h = np.zeros((across, STATE), np.float32)
        for at in range(0, length, STEPS):
            h, grads, mean = _backward(model, h, source[:, at : at + STEPS], target[:, at : at + STEPS])
            size = across * min(STEPS, length - at)
            n, seen, loss, full = n + 1, seen + size, loss + mean * size, max(full, size)
            norm = float(np.sqrt(sum(float(np.vdot(g, g)) for g in grads.values())))
            scale = np.float32(size / full * min(1.0, clip / (norm + 1e-12)))  # a short window counts by its symbols
            for k, g in grads.items():
                g *= scale
                m, s = moments[k]
                m *= np.float32(0.9)
                m += np.float32(0.1) * g
                s *= np.float32(0.99)
                g *= g
                g *= np.float32(0.01)
                s += g
                np.sqrt(s, out=g)
                g *= np.float32((1 - 0.99**n) ** -0.5)
                g += np.float32(1e-8)
                np.divide(m, g, out=g)
                g *= np.float32(rate / (1 - 0.9**n))
                getattr(model, k)[...] -= g
        return stream[across * length :]

    held, size = [np.array([model.end])], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= _CHUNK:
            rest = train(np.concatenate(held))
            held, size = [rest], len(rest) - 1
    rest = np.concatenate(held)
    while len(rest) > 1:
        rest = train(rest)
    return seen, loss / max(1, seen)


def to_vector(model: Gru) -> np.ndarray:
    return np.concatenate([v.ravel() for v in model.weights().values()])


def from_vector(model: Gru, vector: np.ndarray) -> Gru:
    """A model of the same form with these weights."""
    parts, at = {}, 0
    for k, v in model.weights().items():
        parts[k], at = vector[at : at + v.size].reshape(v.shape).astype(np.float32), at + v.size
    return Gru(model.n_words, **parts)
