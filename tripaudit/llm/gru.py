"""A small gated recurrent language model in numpy: class-factored softmax, truncated backpropagation.

The vocabulary has two parts. Frequent words (the head) are members of
equal-sized classes: P(word) = P(class) * P(word | class), both by softmax of
the state. All other words (the tail) fall into classes by spelling, also
predicted by the class softmax; within such a class a word has its smoothed
share of the class's training tokens, which the caller adds.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

HIDDEN = 16
CLASS_SIZE = 32
HEAD_CLASSES = 32
HEAD = CLASS_SIZE * HEAD_CLASSES  # the end of a text included
TAIL_CLASSES = 64
CLASSES = HEAD_CLASSES + TAIL_CLASSES
INPUTS = HEAD + TAIL_CLASSES
WINDOW = 16  # steps of truncated backpropagation
FLAT = 60.0  # exponentials of numbers within plus and minus this are taken as they are

SHAPES = {
    "wx": (INPUTS, 3 * HIDDEN),
    "u_rz": (HIDDEN, 2 * HIDDEN),
    "u_c": (HIDDEN, HIDDEN),
    "w_class": (HIDDEN, CLASSES),
    "b_class": (CLASSES,),
    "w_word": (HEAD_CLASSES, HIDDEN, CLASS_SIZE),
    "b_word": (HEAD_CLASSES, CLASS_SIZE),
}

# Bytes that end clauses, and bytes that are neither letters nor digits.
_CLAUSE = set(b".,;:!?")
_DIGITS = set(b"0123456789")
_SIGNS = {b for b in range(33, 127) if not chr(b).isalnum()}


def tail_class(word: bytes) -> int:
    """Class of a word by its spelling: accents, closing mark, signs inside, digits, hashed first letters."""
    own = set(word)
    stem = set(word.rstrip(b".,;:!?"))
    kind = (max(own) >= 128) + 2 * (word[-1] in _CLAUSE) + 4 * bool(stem & _SIGNS) + 8 * bool(own & _DIGITS)
    return 4 * kind + zlib.crc32(word[:2]) % 4


@lru_cache(maxsize=1)
def _byte_tables() -> tuple[np.ndarray, ...]:
    """Per byte: bits of accents and digits, ends of clauses, signs; per two first bytes (256 and up: one byte) their hash."""
    bits = np.array([(b >= 128) + 8 * (b in _DIGITS) for b in range(256)], np.uint8)
    clause, sign = (np.array([b in own for b in range(256)]) for own in (_CLAUSE, _SIGNS))
    hashes = np.array([zlib.crc32(bytes([a, b])) % 4 for a in range(256) for b in range(256)] + [zlib.crc32(bytes([a])) % 4 for a in range(256)], np.uint8)
    return bits, clause, sign, hashes


def tail_classes(text: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``tail_class`` of many words: word i is the bytes ``text[offsets[i] : offsets[i + 1]]``, none is empty."""
    bits, clause, sign, hashes = _byte_tables()
    starts, ends = offsets[:-1], offsets[1:]
    if not len(starts):
        return np.zeros(0, np.int64)
    at = np.arange(len(text), dtype=np.int32)
    closing = clause[text]
    last_of_stem = np.maximum.reduceat(np.where(closing, np.int32(-1), at), starts)
    first_sign = np.minimum.reduceat(np.where(sign[text], at, np.int32(len(text))), starts)
    first = text[starts].astype(np.int64)
    second = np.where(ends - starts > 1, first * 256 + text[np.minimum(starts + 1, len(text) - 1)], 65536 + first)
    kind = np.bitwise_or.reduceat(bits[text], starts) + 2 * closing[ends - 1] + 4 * (first_sign <= last_of_stem)
    return 4 * kind.astype(np.int64) + hashes[second]


def initial(head_counts: np.ndarray, tail_counts: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """Weights at the start; biases make the model the smoothed unigram distribution."""
    rng = np.random.default_rng(seed)
    p = {k: (rng.standard_normal(s) * 0.1).astype(np.float32) for k, s in SHAPES.items()}
    words = np.zeros(HEAD)
    words[: len(head_counts)] = head_counts
    grid = words.reshape(HEAD_CLASSES, CLASS_SIZE) + 0.1
    p["b_word"] = np.log(grid / grid.sum(1, keepdims=True)).astype(np.float32)
    p["b_word"].reshape(-1)[len(head_counts) :] = -30  # unused places
    mass = np.concatenate([grid.sum(1), np.asarray(tail_counts) + 0.1])
    p["b_class"] = np.log(mass / mass.sum()).astype(np.float32)
    return p


def flatten(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in SHAPES])


def unflatten(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[k] = np.ascontiguousarray(flat[at : at + n], dtype=np.float32).reshape(shape)
        at += n
    return out


def _softmax(x: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-probabilities of one column a row, at ``places`` of the raveled ``x``; exponentials (in place of ``x``) and their sums."""
    out = x.take(places)
    if len(out) and (x.max() > FLAT or out.min() < -FLAT):  # else no exponential overflows and no sum vanishes
        x -= x.max(axis=1, keepdims=True)
        out = x.take(places)
    np.exp(x, out=x)
    total = x @ np.ones(x.shape[1], x.dtype)
    return out - np.log(total), x, total


def windows(docs: list[np.ndarray], steps: int = WINDOW) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Token grids ``[steps, active]`` of documents sorted by falling length, with the active count per step."""
    lengths = np.array([len(d) for d in docs], np.int64)
    flat = np.concatenate([*docs, np.zeros(steps, np.int32)])
    starts = np.cumsum(lengths) - lengths
    for start in range(0, int(lengths[0]) if len(docs) else 0, steps):
        times = np.arange(start, min(start + steps, int(lengths[0])))[:, None]
        active = int(np.searchsorted(-lengths, -start))
        live = lengths[:active] > times
        yield np.where(live, flat[starts[:active] + times], np.int32(0)), live.sum(1)


def run_states(p, grid, counts, h, save=False):
    """Advance the states ``h`` (in place) over a window; the state before each step, and what backpropagation needs."""
    steps, active = grid.shape
    before = np.zeros((steps, active, HIDDEN), np.float32)
    gates, found = np.zeros((steps, active, 2 * HIDDEN), np.float32), np.zeros((steps, active, HIDDEN), np.float32)
    driven = p["wx"].take(grid, axis=0)
    u_rz, u_c = p["u_rz"].astype(np.float32), p["u_c"].astype(np.float32)
    for t in range(steps):
        n = counts[t]
        old, rz, c = h[:n], gates[t, :n], found[t, :n]
        before[t, :n] = old
        np.matmul(old, u_rz, out=rz, casting="same_kind")
        rz += driven[t, :n, : 2 * HIDDEN]
        np.negative(rz, out=rz)
        np.exp(rz, out=rz)
        rz += 1
        np.reciprocal(rz, out=rz)
        np.matmul(rz[:, :HIDDEN] * old, u_c, out=c, casting="same_kind")
        c += driven[t, :n, 2 * HIDDEN :]
        np.tanh(c, out=c)
        step = c - old
        step *= rz[:, HIDDEN:]
        old += step
    return before, (gates, found) if save else None


def _with_bias(weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    return np.concatenate([weights, np.expand_dims(bias, -2)], axis=-2)


def token_scores(p, states, tokens, gradient=False):
    """Natural log-probability of each token (a tail token: of its class), optionally with gradients."""
    classes = np.where(tokens < HEAD, tokens // CLASS_SIZE, tokens - HEAD + HEAD_CLASSES).astype(np.int16)  # 16 bits: sorted by radix
    order = np.argsort(classes, kind="stable")  # all below is in the order of classes
    classes = classes.take(order)
    w_class, w_word = _with_bias(p["w_class"], p["b_class"]), _with_bias(p["w_word"], p["b_word"])
    inputs = np.ones((len(tokens), HIDDEN + 1), w_class.dtype)  # a one at the end for the biases
    inputs[:, :HIDDEN] = states.take(order, axis=0)
    bounds = np.searchsorted(classes, np.arange(HEAD_CLASSES + 1, dtype=np.int16)).tolist()
    parts = [(k, slice(a, b)) for k, (a, b) in enumerate(zip(bounds, bounds[1:])) if a < b]
    heads, rows = slice(0, bounds[-1]), np.arange(len(tokens))
    places, places_word = rows * CLASSES + classes, rows[heads] * CLASS_SIZE + tokens.take(order[heads]) % CLASS_SIZE
    found, d, total = _softmax(inputs @ w_class, places)
    x = np.empty((bounds[-1], CLASS_SIZE), w_class.dtype)
    for k, own in parts:
        np.matmul(inputs[own], w_word[k], out=x[own])
    log_word, d_word, total_word = _softmax(x, places_word)
    found[heads] += log_word
    out = np.empty_like(found)
    out[order] = found
    if not gradient:
        return out
    # Probabilities less a one at the token, times the sums; the narrow sides are divided by them.
    d.reshape(-1)[places] -= total
    d_word.reshape(-1)[places_word] -= total_word
    share, share_word = 1 / total[:, None], 1 / total_word[:, None]
    g_class, g_word = (inputs * share).T @ d, np.zeros(w_word.shape, w_word.dtype)
    back = d @ w_class[:HIDDEN].T
    back *= share
    scaled = inputs[heads] * share_word
    for k, own in parts:
        np.matmul(scaled[own].T, d_word[own], out=g_word[k])
        part = d_word[own] @ w_word[k, :HIDDEN].T
        part *= share_word[own]
        back[own] += part
    grads = {"w_class": g_class[:HIDDEN], "b_class": g_class[HIDDEN], "w_word": g_word[:, :HIDDEN], "b_word": g_word[:, HIDDEN]}
    d_states = np.empty_like(back)
    d_states[order] = back
    return out, grads, d_states


def backward(p, grid, counts, before, saved, d_before, grads):
    """Backpropagation through one window; adds the recurrent gradients to ``grads``."""
    steps, active = grid.shape
    d_driven = np.zeros((steps, active, 3 * HIDDEN), np.float32)
    dh = np.zeros((active, HIDDEN), np.float32)
    gates, c = saved
    r, z = gates[:, :, :HIDDEN].copy(), gates[:, :, HIDDEN:].copy()
    left, reset = 1 - z, r * before
    by_c, by_z, by_r = c * c, c - before, 1 - r
    np.subtract(1, by_c, out=by_c)
    by_c *= z
    by_z *= z
    by_z *= left
    by_r *= reset
    u_c, u_rz = p["u_c"].T, p["u_rz"].T
    for t in range(steps - 1, -1, -1):
        n = counts[t]
        up, own = dh[:n], d_driven[t, :n]
        d_c = up * by_c[t, :n]
        back = d_c @ u_c
        own[:, 2 * HIDDEN :] = d_c
        np.multiply(back, by_r[t, :n], out=own[:, :HIDDEN])
        np.multiply(up, by_z[t, :n], out=own[:, HIDDEN : 2 * HIDDEN])
        up *= left[t, :n]
        back *= r[t, :n]
        up += back
        up += own[:, : 2 * HIDDEN] @ u_rz
        up += d_before[t, :n]
    flat_before, flat = before.reshape(-1, HIDDEN), d_driven.reshape(-1, 3 * HIDDEN)
    grads["u_rz"] = flat_before.T @ flat[:, : 2 * HIDDEN]
    grads["u_c"] = reset.reshape(-1, HIDDEN).T @ flat[:, 2 * HIDDEN :]
    tokens = grid.ravel()
    order = np.argsort(tokens.astype(np.int16), kind="stable")  # 16 bits: sorted by radix
    tokens = tokens.take(order)
    first = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
    grads["wx"] = np.zeros(SHAPES["wx"], np.float32)
    grads["wx"][tokens[first]] = np.add.reduceat(flat.take(order, axis=0), first, axis=0)
    return grads


class Trainer:
    """Adam on truncated windows; every window of every document gives an update."""

    def __init__(self, p, rate: float = 0.01):
        self.flat, self.rate, self.step, self.tokens = flatten(p), rate, 0, 0
        self.p = unflatten(self.flat)  # views: an update of ``flat`` is one of the weights
        self.m, self.v = np.zeros_like(self.flat), np.zeros_like(self.flat)

    def learn(self, docs: list[np.ndarray], batch: int = 128) -> None:
        docs = sorted(docs, key=len, reverse=True)
        for at in range(0, len(docs), batch):
            own = docs[at : at + batch]
            h = np.zeros((len(own), HIDDEN), np.float32)
            for grid, counts in windows(own):
                h = h[: grid.shape[1]]
                before, saved = run_states(self.p, grid, counts, h, save=True)
                self._update(grid, counts, before, saved)
            self.tokens += sum(map(len, own))

    def _update(self, grid, counts, before, saved):
        live = np.arange(grid.shape[1])[None, :] < counts[:, None]
        _, grads, d_states = token_scores(self.p, before[live], grid[live], gradient=True)
        d_before = np.zeros_like(before)
        d_before[live] = d_states
        grads = backward(self.p, grid, counts, before, saved, d_before, grads)
        self.step += 1
        n = max(1, int(counts.sum()))
        g = flatten(grads)
        g /= n
        np.clip(g, -1, 1, out=g)
        self.m *= 0.9
        self.m += 0.1 * g
        g *= g
        self.v *= 0.99
        self.v += 0.01 * g
        np.divide(self.v, 1 - 0.99**self.step, out=g)
        np.sqrt(g, out=g)
        g += 1e-6
        np.divide(self.m, g, out=g)
        g *= self.rate / (1 - 0.9**self.step)
        self.flat -= g


def log_likelihoods(p, docs: list[np.ndarray], batch: int = 1024) -> np.ndarray:
    """Natural log-probability of whole documents, the state carried from window to window."""
    out = np.zeros(len(docs))
    order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
    for at in range(0, len(order), batch):
        picked = order[at : at + batch]
        own = [docs[i] for i in picked]
        h, total = np.zeros((len(own), HIDDEN), np.float32), np.zeros(len(own))
        for grid, counts in windows(own):
            active = grid.shape[1]
            before, _ = run_states(p, grid, counts, h[:active])
            live = np.arange(active)[None, :] < counts[:, None]
            scores = token_scores(p, before[live], grid[live])
            total[:active] += np.bincount(np.nonzero(live)[1], weights=scores, minlength=active)
        out[picked] = total
    return out
