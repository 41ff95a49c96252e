"""Simple-8b: 64-bit words, the top 4 bits select how many values of how many bits follow.

Selectors 0-13 pack 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1 values of 60 // count bits; 15 is the escape: the
next word is one raw 64-bit value. Blocks of ``BLOCK`` values begin at a word of their own, so that blocks are
encoded and decoded side by side.
"""

from __future__ import annotations

import numpy as np

#: fixed values of the format
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = 60 // COUNTS
ESCAPE, BLOCK = 15, 4096


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, first word of each block and the end)."""
    values = np.ascontiguousarray(values, np.uint64)
    n_blocks = -(-len(values) // BLOCK)
    if not n_blocks:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    stride = BLOCK + 60  # zeros behind each block, for its last word
    v = np.zeros((n_blocks, stride), np.uint64)
    flat = np.zeros(n_blocks * BLOCK, np.uint64)
    flat[: len(values)] = values
    v[:, :BLOCK] = flat.reshape(n_blocks, BLOCK)
    v = v.reshape(-1)
    # bits of each value (a value near 2^60 may count as one bit more, which only costs an escape), then the most over
    # the next 2, 3, ... values from maxima over fewer
    most = {1: np.frexp(v.astype(np.float64))[1].astype(np.uint8)}
    choice = np.full(len(v), ESCAPE, np.uint8)
    for s in range(len(COUNTS) - 1, -1, -1):
        n = int(COUNTS[s])
        if n > 1:
            k = max(x for x in most if x < n and n - x in most)
            m = most[k].copy()
            np.maximum(m[:-k], most[n - k][k:], out=m[:-k])
            most[n] = m
        choice[most[n] <= WIDTHS[s]] = s
    step = np.ones(16, np.int64)
    step[:14] = COUNTS
    size = np.full(n_blocks, BLOCK)
    size[-1] = len(values) - (n_blocks - 1) * BLOCK
    base = np.arange(n_blocks) * stride
    pos, live, got = np.zeros(n_blocks, np.int64), np.arange(n_blocks), []
    while len(live):
        p = base[live] + pos[live]
        got.append((live, p))
        pos[live] += step[choice[p]]
        live = live[pos[live] < size[live]]
    block = np.concatenate([g[0] for g in got])
    p = np.concatenate([g[1] for g in got])
    p = p[np.argsort(p)]
    block = p // stride
    sel = choice[p]
    need = np.where(sel == ESCAPE, 2, 1)
    at = np.cumsum(need) - need
    words = np.zeros(int(need.sum()), np.uint64)
    for s in range(14):
        own = sel == s
        if own.any():
            g = v[p[own][:, None] + np.arange(COUNTS[s])] << (np.arange(COUNTS[s]) * WIDTHS[s]).astype(np.uint64)
            words[at[own]] = np.bitwise_or.reduce(g, 1) | np.uint64(s) << np.uint64(60)
    own = sel == ESCAPE
    words[at[own]] = np.uint64(ESCAPE) << np.uint64(60)
    words[at[own] + 1] = v[p[own]]
    first = np.concatenate([[0], np.cumsum(np.bincount(block, need, n_blocks).astype(np.int64))])
    return words, first


def decode(words: np.ndarray, first: np.ndarray, total: int) -> np.ndarray:
    """The ``total`` values of whole blocks."""
    if not total:
        return np.zeros(0, np.uint64)
    sel = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    for i in np.flatnonzero(sel == ESCAPE):  # a raw word may look like an escape
        if not raw[i]:
            raw[i + 1] = True
    counts = np.zeros(16, np.int64)
    counts[:14] = COUNTS
    n = np.where(raw, 1, counts[sel])
    out = np.zeros(int(n.sum()), np.uint64)
    at = np.cumsum(n) - n
    for s in range(14):
        own = np.flatnonzero((sel == s) & ~raw)
        if len(own):
            g = words[own][:, None] >> (np.arange(COUNTS[s]) * WIDTHS[s]).astype(np.uint64) & ((np.uint64(1) << np.uint64(WIDTHS[s])) - np.uint64(1))
            out[at[own][:, None] + np.arange(COUNTS[s])] = g
    out[at[raw]] = words[raw]
    n_blocks = len(first) - 1
    begin = np.concatenate([at, [len(out)]])[first[:-1]]
    size = np.full(n_blocks, BLOCK)
    size[-1] = total - (n_blocks - 1) * BLOCK
    return out[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(total)]
