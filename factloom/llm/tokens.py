"""Whole texts to ids with a public tokenizer, encoding each distinct word once.

Texts are cut into pieces at spaces and line feeds, and plain pieces into a word and a run of marks, in numpy. Distinct
words of a group of texts are looked up in a sorted table; only new ones go to the library's BPE model, many in one
call. All other pieces are encoded by the library as they are.
"""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
import pyarrow as pa

from factloom.llm.common import K1, K3, KEPT_TABLES, mix, utf8

_LOADED: dict[str, Encoder] = {}
KEPT_TABLES.append(_LOADED)
#: distinct words kept in a worker (some 60 bytes each); the table starts anew beyond it
KEPT = 2_000_000
#: other pieces kept in a worker (some 300 bytes each)
OTHERS = 100_000
#: bytes of text that are cut and looked up together; a longer text is alone
GROUP = 2 << 20
#: bytes of the longest word or run of marks that the table takes
LONGEST = 16
_SPACE, _FEED, _LETTER, _MARK, _OTHER = range(5)
#: class of each byte. Marks are ASCII (no apostrophe). Letters beyond ASCII are those of two bytes that begin with
#: C3 to C5 (Latin), but the signs U+00D7 and U+00F7
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[*b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"]] = _MARK
_CLASS[[*range(65, 91), *range(97, 123), 0xC3, 0xC4, 0xC5]] = _LETTER
_CLASS[32], _CLASS[10] = _SPACE, _FEED


def encoder(path: str, kept: int = KEPT) -> Encoder:
    """One encoder per tokenizer file and Python worker; ``kept`` bounds its table from now on."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    _LOADED[path].kept = kept
    return _LOADED[path]


def groups(texts: pa.Array, limit: int = GROUP):
    """Ranges of texts of at most ``limit`` bytes; a longer text is alone."""
    _, offs = utf8(texts)
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, j
        i = j


def spans(values: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """values[start:start + n] of all spans, one after the other."""
    ends = np.cumsum(n)
    return values[np.repeat(start - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)]


def _classes(data: np.ndarray) -> np.ndarray:
    c = _CLASS[data]
    lead = np.flatnonzero((data >= 0xC3) & (data <= 0xC5))
    if len(lead):
        follow = data[np.minimum(lead + 1, len(data) - 1)]
        sign = (data[lead] == 0xC3) & ((follow == 0x97) | (follow == 0xB7))
        c[lead[sign]] = _OTHER
        c[lead[~sign] + 1] = _LETTER
    return c


class _Table:
    """Words of up to 16 bytes, exactly: their first and last 8 bytes and their length, sorted by a hash of these."""

    def __init__(self):
        self.key, self.a, self.b, self.n = (np.zeros(0, np.uint64) for _ in range(4))
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def find(self, key, a, b, n):
        """(place in the table, which are there) of distinct words."""
        if not len(self.key):
            return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return at, (self.key[at] == key) & (self.a[at] == a) & (self.b[at] == b) & (self.n[at] == n)

    def add(self, *cols):
        both = [np.concatenate(x) for x in zip((self.key, self.a, self.b, self.n, self.start, self.size), cols, strict=True)]
        order = np.argsort(both[0], kind="stable")
        self.key, self.a, self.b, self.n, self.start, self.size = (x[order] for x in both)


class Encoder:
    """Byte-level BPE of the tokenizers library with its usual splitting pattern.

    That pattern never joins characters across a space or a line feed, except white space with white space: a piece
    cut just before one has the ids that it has within the text unless white space stands on both sides of that cut
    and is followed by more. Texts with such a cut are encoded as a whole. A piece of letters and then marks is two
    matches of the pattern, the first with the space before it; a line feed before it is one of its own.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.lib = Tokenizer.from_file(path)
        self.lib.encode_special_tokens = True  # their strings in a text are ordinary text
        self.kept = KEPT
        # the same model over words parted by line feeds; it takes bytes as printable characters
        self.bare = Tokenizer(self.lib.model)
        self.bare.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        self.chars = np.zeros(257, np.uint32)
        self.chars[own] = own
        rest = [b for b in range(256) if b not in set(own)]
        self.chars[rest] = 256 + np.arange(len(rest))
        self.chars[256] = 10
        vocab = self.lib.get_vocab()
        self.length = np.zeros(max(vocab.values()) + 1, np.int64)  # bytes of each id: characters stand for bytes
        self.length[list(vocab.values())] = [len(t) for t in vocab]
        self.feed = np.array(self.lib.encode("\n", add_special_tokens=False).ids, np.uint32)
        self._reset()

    def _reset(self):
        self.table, self.ids, self.others = _Table(), np.zeros(0, np.uint32), {}

    def _model(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the words one after the other, number of ids of each): by the library's model, a chunk in one call."""
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for i in range(0, len(words), 8192):
            own = words[i : i + 8192]
            data = np.frombuffer(b"\n".join(own), np.uint8).astype(np.int64)
            data[data == 10] = 256
            got = self.bare.encode_batch_fast([self.chars[data].tobytes().decode("utf-32-le")], add_special_tokens=False)[0]
            got = np.array(got.ids, np.uint32)
            ends = np.cumsum([len(w) for w in own])
            cut = np.searchsorted(np.cumsum(self.length[got]), ends) + 1
            ids.append(got)
            sizes.append(np.diff(cut, prepend=0))
        return np.concatenate(ids), np.concatenate(sizes)

    def _words(self, data, s, n, space):
        """(start, size) in ``ids`` of the words data[s:s + n], with a space before them where ``space``."""
        if not len(s):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        padded = np.concatenate([np.zeros(8, np.uint8), data, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(padded) - 7,), "<u8", padded.tobytes(), 0, (1,))
        full = np.minimum(n, 8).astype(np.uint64)
        few = (np.uint64(8) - full) * np.uint64(8)
        a = eight[s + 8] << few  # the first 8 bytes; shorter words without what follows them
        b = np.where(n > 8, eight[s + n], np.uint64(0))  # and the last 8
        kind = (n * 2 + space).astype(np.uint64)
        key = mix(mix(a * K1 + kind) ^ b * K3)
        codes, found = pd.factorize(key)
        first = np.full(len(found), len(key), np.int64)
        first[codes[::-1]] = np.arange(len(key) - 1, -1, -1)
        if not ((a == a[first][codes]) & (b == b[first][codes]) & (kind == kind[first][codes])).all():
            raise _Clash
        ua, ub, un = a[first], b[first], kind[first]
        at, known = self.table.find(found, ua, ub, un)
        if not known.all():
            if (self.table.key[at[~known]] == found[~known]).any() if len(self.table.key) else False:
                raise _Clash
            new = first[~known]
            raw, ends = data.tobytes(), (s + n)[new].tolist()
            words = [b" " + raw[x:y] if z else raw[x:y] for x, y, z in zip(s[new].tolist(), ends, space[new].tolist(), strict=True)]
            ids, size = self._model(words)
            start = len(self.ids) + np.cumsum(size) - size
            self.ids = np.concatenate([self.ids, ids])
            self.table.add(found[~known], ua[~known], ub[~known], un[~known], start, size.astype(np.int32))
            at, _ = self.table.find(found, ua, ub, un)
        return self.table.start[at][codes], self.table.size[at][codes].astype(np.int64)

    def encode(self, texts, end: int | None = 0) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, bounds): text i has ids[bounds[i]:bounds[i + 1]], with ``end`` appended if given; null is empty."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        if len(self.table.key) > self.kept or len(self.others) > OTHERS:
            self._reset()
        data, offs = utf8(texts)
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        try:
            ids, bounds = self._encode(data, offs)
        except _Clash:  # two words with one 64-bit hash: the library alone
            parts = [np.array(e.ids, np.uint32) for e in self.lib.encode_batch_fast([data[a:b].tobytes().decode() for a, b in zip(offs[:-1], offs[1:], strict=True)], add_special_tokens=False)]
            ids, bounds = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])
        if end is not None:
            ids = np.insert(ids, bounds[1:], np.uint32(end))
            bounds = bounds + np.arange(len(bounds))
        return ids, bounds

    def _encode(self, data, offs):
        c = _classes(data)
        # pieces: one from the begin of each text and one from each space and line feed on
        cut = np.flatnonzero(c <= _FEED)
        s = np.concatenate([offs[:-1], cut])
        kind = np.concatenate([np.full(len(offs) - 1, 2), c[cut]])  # 0 space, 1 line feed, 2 begin of a text
        order = np.lexsort((kind != 2, s))  # a text's begin before the space that it begins with
        s, kind = s[order], kind[order]
        doc = np.cumsum(kind == 2) - 1
        lead = kind != 2
        e = np.minimum(np.append(s[1:], len(data)), offs[doc + 1])
        body = s + lead
        # plain: letters, then marks; no letter after a mark and nothing else
        before = np.concatenate([[_OTHER], c[:-1]]) if len(c) else c
        odd = np.concatenate([[0], np.cumsum((c == _OTHER) | (c == _LETTER) & (before == _MARK), dtype=np.int32)])
        letters = np.concatenate([[0], np.cumsum(c == _LETTER, dtype=np.int32)])
        n_word = (letters[e] - letters[body]).astype(np.int64)
        n_mark = e - body - n_word
        # the first byte of a piece follows a space, a line feed or another text: never a mark of its own piece
        begins = np.zeros(len(body), np.int32)
        inside = body < e
        begins[inside] = (before[body[inside]] == _MARK) & (c[body[inside]] == _LETTER)
        plain = (odd[e] - odd[body] - begins == 0) & (n_word > 0) & (n_word <= LONGEST) & (n_mark <= LONGEST)
        at, marked = np.flatnonzero(plain), np.flatnonzero(plain & (n_mark > 0))
        start, size = self._words(data, np.concatenate([body[at], body[marked] + n_word[marked]]), np.concatenate([n_word[at], n_mark[marked]]), np.concatenate([kind[at] == 0, np.zeros(len(marked), bool)]))
        # every piece is up to three spans of ids: a line feed, a word or another piece, marks
        starts, sizes = np.zeros((len(s), 3), np.int64), np.zeros((len(s), 3), np.int64)
        starts[at, 1], sizes[at, 1] = start[: len(at)], size[: len(at)]
        starts[marked, 2], sizes[marked, 2] = start[len(at) :], size[len(at) :]
        flags = np.zeros(len(s), np.int8)
        rest = np.flatnonzero(~plain & (lead | inside))
        extra, more = [], len(self.ids)
        if len(rest):
            raw, others = data.tobytes(), self.others
            pieces = [raw[x:y] for x, y in zip(s[rest].tolist(), e[rest].tolist(), strict=True)]
            new = list({p: 0 for p in pieces if p not in others})
            for p, g in zip(new, self.lib.encode_batch_fast([p.decode() for p in new], add_special_tokens=False), strict=True):
                t = p.decode()
                # 1: white space (or the end) follows leading white space; 2: it ends in white space
                others[p] = (np.array(g.ids, np.uint32), (t[0].isspace() and (len(t) == 1 or t[1].isspace())) + 2 * t[-1].isspace())
            got = [others[p] for p in pieces]
            extra = [x[0] for x in got]
            n = np.array([len(x) for x in extra], np.int64)
            starts[rest, 1], sizes[rest, 1] = more + np.cumsum(n) - n, n
            flags[rest] = [x[1] for x in got]
        feed = np.flatnonzero(plain & (kind == 1))
        starts[feed, 0], sizes[feed, 0] = more + sum(map(len, extra)), len(self.feed)
        ids = spans(np.concatenate([self.ids, *extra, self.feed]), starts.ravel(), sizes.ravel())
        ends = np.cumsum(sizes.sum(1))
        last = np.append(np.flatnonzero(kind == 2)[1:], len(s)) - 1
        bounds = np.concatenate([[0], ends[last]])
        bad = np.flatnonzero(lead & (flags & 1 > 0) & (np.concatenate([[0], flags[:-1]]) & 2 > 0))
        if len(bad):
            whole = set(doc[bad].tolist())
            parts = [np.array(self.lib.encode(data[offs[i] : offs[i + 1]].tobytes().decode(), add_special_tokens=False).ids, np.uint32) if i in whole else ids[bounds[i] : bounds[i + 1]] for i in range(len(offs) - 1)]
            bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])
            ids = np.concatenate(parts)
        return ids, bounds


class _Clash(Exception):
    """Two different words have one hash."""
