"""Texts of an Arrow batch as one array of letter codes, for vectorised character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SPACE, BREAK = 32, 1
_TABLE: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters."""
    if not _TABLE:
        _TABLE.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _TABLE[0]


def groups(texts: list, limit: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` characters; a longer text is alone."""
    start, n = 0, 0
    for i, t in enumerate(texts):
        n += len(t or "")
        if n >= limit:
            yield start, i + 1
            start, n = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def stream(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(codes, bounds): lower-cased letters, every other run one space, texts parted by BREAK.

    Text i lies in codes[bounds[i]:bounds[i + 1] - 1] and begins and ends with a space.
    """
    low = [(t or "").lower() for t in texts]
    lens = np.fromiter(map(len, low), np.int64, len(low))
    cp = np.frombuffer((" " + " \x01 ".join(low) + " \x01").encode("utf-32-le", "surrogatepass"), "<u4").copy()
    at = 1 + np.cumsum(lens + 3) - 2  # of the breaks
    cp[~letters()[np.minimum(cp, 0x10FFFF)]] = SPACE
    cp[at] = BREAK
    keep = np.ones(len(cp), bool)
    keep[1:] = (cp[1:] != SPACE) | (cp[:-1] != SPACE)
    cp = cp[keep]
    return cp, np.concatenate([[0], np.flatnonzero(cp == BREAK) + 1])


def packed(codes: np.ndarray, n: int, bits: int) -> np.ndarray:
    """The n-gram that begins at each position, ``bits`` bits a character; the last n - 1 positions have none."""
    c = codes.astype(np.int64)
    if bits < 21:
        c &= (1 << bits) - 1
    g = c[: len(c) - n + 1].copy()
    for k in range(1, n):
        g <<= bits
        g |= c[k : len(c) - n + 1 + k]
    return g
