"""Words of an Arrow column of texts, cut out of the UTF-8 bytes by numpy without decoding."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from factloom.llm.common import span_hashes, utf8

#: bytes with A-Z as a-z, all others as they are
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def all_but(*seps: int) -> np.ndarray:
    """Which bytes belong to a word, if ``seps`` do not."""
    own = np.ones(256, bool)
    own[list(seps)] = False
    return own


#: words of the language model: whatever is between blanks
BETWEEN_BLANKS = all_but(0x20, *range(0x09, 0x0E))


def slices(texts: pa.Array, limit: int = 1 << 24) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes of text; a longer text is alone."""
    ends = utf8(texts)[1][1:]
    i = 0
    while i < len(ends):
        before = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield i, j
        i = j


def words(texts: pa.Array, own: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, bounds, begin): maximal runs of the bytes ``own``, A-Z lower-cased, of all texts one after the other.

    Words of text i are words[bounds[i]:bounds[i + 1]]; ``begin`` is where each begins in the bytes of the texts. A null
    text has none.
    """
    data, offs = utf8(texts)
    if not len(data):
        return pa.array([], pa.string()), np.zeros(len(offs), np.int64), np.zeros(0, np.int64)
    inside = own[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    at = offs[:-1][offs[:-1] < len(data)]
    first[at] = inside[at]  # the end of a text ends its word
    begin = np.flatnonzero(first)
    kept = LOWER[data[inside]]
    ends = np.append(np.flatnonzero(first[inside]), len(kept)).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(begin), [None, pa.py_buffer(ends), pa.py_buffer(kept)]), np.searchsorted(begin, offs), begin


def coded(w: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(codes, distinct words): each word's place among the distinct ones."""
    d = w.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary


def hashes(w: pa.Array) -> np.ndarray:
    """64-bit hashes of words; equal words have equal hashes in every task."""
    data, offs = utf8(w)
    return span_hashes(data, offs[:-1], offs[1:])
