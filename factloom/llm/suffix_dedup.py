"""Suffix-array dedup: every byte covered by a ``length``-byte string that also starts earlier is removed.

The suffixes that are sorted are sparse but sufficient. In each window of ``length`` bytes the ``KMER``-byte string
of the least hash is its anchor; equal windows have the anchor at the same place, so equal windows can only be found
among the windows of equal anchors. Consecutive windows with one anchor form a run, stored as the suffix from the
anchor on (R) and the bytes before it (L, reversed).

1. Anchors' hashes are exchanged in blobs; anchors that occur once in the whole corpus cannot repeat and are dropped.
2. Per map task the remaining suffixes R+L are made unique (the earliest stays, later equal runs are removed),
   sorted, front-coded and exchanged by anchor.
3. Loser trees merge the front-coded runs: each head carries the length of its common prefix with the last output,
   so bytes known to agree are not compared again. The merged common prefixes part the anchors; within an anchor,
   equal suffixes are removed but for the earliest, and windows of different suffixes are matched one by one.
4. Removed spans go back to their documents.

Anchors with more than ``HOT`` occurrences are exchanged as single windows (made unique per task) by the window's own
hash, so that no anchor gathers an unbounded group in one task.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import K1, mix, ship, span_hashes, utf8

LENGTH, KMER, HOT = 100, 32, 5000
#: bytes that are hashed at once; windows of a longer document are dealt with piece by piece
PIECE = 1 << 19
#: suffixes of a task that make one sorted run
RUN = 200_000
#: bytes of text for each part of the anchor space: groups stay of this size as the corpus grows
PART = 8 << 20
#: stands for a null id, after all others (and is taken for one)
NULL_ID = (1 << 63) - 1


def anchors(data: np.ndarray, offs: np.ndarray, length: int = LENGTH, k: int = KMER) -> tuple[np.ndarray, ...]:
    """(document, anchor, first window, last window, hash of the anchor) of every run; positions in ``data``."""
    out = []
    for lo, hi, bounds, docs in _pieces(offs, length):
        d = data[lo:hi]
        if len(d) < length:
            continue
        h = d.astype(np.uint64) + np.uint64(1)
        n, power = 1, int(K1)
        while n < k:  # hashes of n bytes, doubled
            h = h[: len(h) - n] * np.uint64(power) + h[n:]
            n, power = 2 * n, power * power % (1 << 64)
        h = mix(h)
        order = (h & ~np.uint64(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64)  # equal hashes: the leftmost
        least, n, width = order, 1, length - k + 1
        while 2 * n <= width:
            least = np.minimum(least[: len(least) - n], least[n:])
            n *= 2
        if n < width:
            least = np.minimum(least[: len(least) - (width - n)], least[width - n :])
        size = np.diff(bounds)
        own = size >= length
        mark = np.zeros(len(d) + 1, np.int32)
        np.add.at(mark, bounds[:-1][own], 1)
        np.add.at(mark, bounds[1:][own] - length + 1, -1)
        win = np.flatnonzero(np.cumsum(mark[:-1]))
        at = (least[win] & np.uint64(0xFFFFFF)).astype(np.int64)
        if not len(win):
            continue
        new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        p = at[new]
        out.append((docs[np.searchsorted(bounds, p, "right") - 1], p + lo, win[new] + lo, win[np.concatenate([new[1:] - 1, [len(win) - 1]])] + lo, h[p]))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z, z, np.zeros(0, np.uint64)
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _pieces(offs, length) -> Iterator[tuple]:
    """(from, to, bounds within, document numbers): documents up to PIECE bytes together, longer ones in overlapping parts."""
    i, n = 0, len(offs) - 1
    while i < n:
        if offs[i + 1] - offs[i] > PIECE:
            a = offs[i]
            while a + length <= offs[i + 1]:
                b = min(a + PIECE + length - 1, offs[i + 1])
                yield a, b, np.array([0, b - a]), np.array([i])
                a += PIECE
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + PIECE, "right")) - 1)
        yield offs[i], offs[j], offs[i : j + 1] - offs[i], np.arange(i, j)
        i = j


def common_prefix(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of a and b, of which the first ``at`` bytes are known to agree."""
    n = min(len(a), len(b))
    if a[at:n] == b[at:n]:
        return n
    x = int.from_bytes(a[at:n], "big") ^ int.from_bytes(b[at:n], "big")
    return n - (x.bit_length() + 7) // 8


def front_code(keys: list[bytes]) -> tuple[bytes, bytes, bytes]:
    """(common prefix lengths, key lengths, the remaining bytes) of sorted keys; lengths are 16-bit."""
    lcp, rest, last = [], [], b""
    for k in keys:
        h = common_prefix(last, k, 0)
        lcp.append(h)
        rest.append(k[h:])
        last = k
    return struct.pack(f"<{len(keys)}H", *lcp), struct.pack(f"<{len(keys)}H", *map(len, keys)), b"".join(rest)


def decode_run(lcps: bytes, lens: bytes, rest: bytes) -> Iterator[tuple[int, bytes]]:
    """(common prefix with the key before, key), one after the other."""
    last, at = b"", 0
    for (h,), (n,) in zip(struct.iter_unpack("<H", lcps), struct.iter_unpack("<H", lens), strict=True):
        last = last[:h] + rest[at : at + n - h]
        at += n - h
        yield h, last


def merge(runs: list[Iterator[tuple[int, bytes]]]) -> Iterator[tuple[int, bytes, int]]:
    """A loser tree over sorted runs: (common prefix with the output before, key, run), in order.

    A node keeps the loser and its common prefix with the last output. A contender with the longer prefix is
    smaller; only at equal prefixes are bytes compared, from there on.
    """
    size = 1
    while size < len(runs):
        size *= 2
    heads: list = [next(r, None) for r in runs] + [None] * (size - len(runs))
    keys = [h and h[1] for h in heads]
    loser, known = [-1] * size, [0] * size

    def play(node: int) -> int:
        """The winner below ``node`` before any output; all common prefixes are 0."""
        if node >= size:
            return node - size
        a, b = play(2 * node), play(2 * node + 1)
        if keys[a] is None or keys[b] is not None and keys[b] < keys[a]:
            a, b = b, a
        loser[node] = b
        known[node] = 0 if keys[b] is None else common_prefix(keys[a], keys[b], 0)
        return a

    w, h = play(1), 0
    while keys[w] is not None:
        yield h, keys[w], w
        got = next(runs[w], None)
        keys[w], h, node = (None, -1, (w + size) // 2) if got is None else (got[1], got[0], (w + size) // 2)
        while node:
            n = loser[node]
            if keys[n] is not None:
                hn = known[node]
                if keys[w] is None or h < hn:
                    loser[node], known[node], w, h = w, h, n, hn
                elif h == hn:
                    c = common_prefix(keys[w], keys[n], h)
                    if keys[w][c : c + 1] > keys[n][c : c + 1]:
                        loser[node], w = w, n
                    known[node] = c
            node //= 2


def _where(id_col: str, text_col: str) -> list[Column]:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("d"), F.xxhash64(text).alias("th"), text.alias("text")]


def _by_document(docs: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of equal values in a sorted array."""
    if not len(docs):
        return iter(())
    new = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
    return zip(new.tolist(), np.append(new[1:], len(docs)).tolist(), strict=True)


class _Spans:
    """Removed spans by document, as rows."""

    def __init__(self):
        self.by: dict[tuple[int, int], list[int]] = {}

    def add(self, d, th, a, b):
        own = self.by.setdefault((d, th), [])
        if own and own[-2] <= a <= own[-1]:
            own[-1] = max(own[-1], b)
        else:
            own += [a, b]

    def columns(self):
        return pa.array([k[0] for k in self.by], pa.int64()), pa.array([k[1] for k in self.by], pa.int64()), pa.array(list(self.by.values()), pa.list_(pa.int32()))


def _dealt(rows: DataFrame, parts: int) -> DataFrame:
    """``rows`` (part, ...) over as many tasks as there are parts, where the session's setting would make fewer."""
    return rows.repartition(parts, "part") if parts > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else rows


def repeated_anchors(t: DataFrame, parts: int, length: int, hot: int) -> DataFrame:
    """(d, at): positions of a document's anchors that occur again somewhere; those of hot anchors as -1 - position."""
    def hashes(batches):
        got, n = [], 0

        def flush():
            d, p, h = (np.concatenate(c) for c in zip(*got, strict=True))
            order = np.lexsort((h, h % np.uint64(parts)))
            d, p, h = d[order], p[order], h[order]
            ends = np.searchsorted(h % np.uint64(parts), np.arange(parts + 1, dtype=np.uint64))
            rows = [(k, h[a:b].tobytes(), d[a:b].tobytes(), p[a:b].tobytes()) for k, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if a < b]
            got.clear()
            return pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], ["part", "h", "d", "p"])

        for b in batches:
            data, offs = utf8(b.column("text"))
            ids = np.asarray(b.column("d"))
            doc, p, _, _, h = anchors(data, offs, length)
            if len(doc):
                got.append((ids[doc], (p - offs[doc]).astype(np.int32), h))
                n += len(doc)
            if n >= 1_000_000:
                yield flush()
                n = 0
        if got:
            yield flush()

    def again(key, tab):
        h, d, p = (np.concatenate([np.frombuffer(x, kind) for x in tab.column(c).to_pylist()]) for c, kind in (("h", np.uint64), ("d", np.int64), ("p", np.int32)))
        order = np.argsort(h, kind="stable")
        h, d, p = h[order], d[order], p[order]
        new = np.concatenate([[True], h[1:] != h[:-1]])
        count = np.diff(np.append(np.flatnonzero(new), len(h)))[np.cumsum(new) - 1]
        at = np.where(count > hot, -1 - p, p)
        d, at = d[count > 1], at[count > 1]
        order = np.argsort(d, kind="stable")
        d, at = d[order], at[order]
        ends = list(_by_document(d))
        return pa.table({"d": d[[a for a, _ in ends]] if ends else d, "at": pa.array([at[a:b] for a, b in ends], pa.list_(pa.int32()))})

    blobs = t.select("d", "text").mapInArrow(hashes, "part int, h binary, d binary, p binary")
    return _dealt(blobs, parts).groupBy("part").applyInArrow(again, "d long, at array<int>").groupBy("d").agg(F.flatten(F.collect_list("at")).alias("at"))


def suffix_runs(t: DataFrame, parts: int, length: int) -> DataFrame:
    """Rows of two kinds: front-coded sorted runs, and spans removed already within the task (doc set)."""
    schema = "part int, hot boolean, lcp binary, len binary, rest binary, right binary, d binary, th binary, p binary, doc long, doc_th long, spans array<int>"
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int32(), pa.bool_(), *[pa.binary()] * 7, pa.int64(), pa.int64(), pa.list_(pa.int32())]

    def make(batches):
        cold: dict[tuple[bytes, int], tuple] = {}
        hot: dict[bytes, tuple] = {}
        spans = _Spans()

        def keep(table, key, loc, extent):
            """The earliest holder of a key stays; ``extent`` is what a later one loses, relative to its position."""
            old = table.get(key)
            if old is None:
                table[key] = loc
            elif loc[:3] < old[:3]:
                table[key] = loc
                spans.add(old[0], old[1], old[2] - extent[0], old[2] + extent[1])
            elif loc[:3] > old[:3]:
                spans.add(loc[0], loc[1], loc[2] - extent[0], loc[2] + extent[1])

        def flush():
            by: dict[tuple[int, bool], list] = {}
            for (key, right), loc in cold.items():
                by.setdefault((loc[3], False), []).append((key, right, loc))
            for key, loc in hot.items():
                by.setdefault((loc[3], True), []).append((key, length, loc))
            rows = []
            for (part, is_hot), own in by.items():
                own.sort()
                n = len(own)
                rows.append((part, is_hot, *front_code([x[0] for x in own]), struct.pack(f"<{n}H", *[x[1] for x in own]), *[np.array([x[2][c] for x in own], np.int64).tobytes() for c in range(3)], None, None, None))
            cold.clear()
            hot.clear()
            d, th, s = spans.columns()
            n = len(d)
            spans.by = {}
            if rows:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
            if n:
                yield pa.record_batch([pa.array(np.asarray(d) % parts, pa.int32()), *[pa.nulls(n, k) for k in kinds[1:9]], d, th, s], names)

        for b in batches:
            data, offs = utf8(b.column("text"))
            text, ids, ths = data.tobytes(), np.asarray(b.column("d")).tolist(), np.asarray(b.column("th")).tolist()
            want = b.column("at")
            flat, n = np.asarray(want.flatten()).astype(np.int64), np.diff(np.asarray(want.offsets))
            base = np.repeat(offs[:-1], n)
            is_hot = np.sort(base[flat < 0] - 1 - flat[flat < 0])
            doc, p, s, e, h = anchors(data, offs, length)
            use = np.isin(p, np.where(flat < 0, base - 1 - flat, base + flat))
            doc, p, s, e, h = doc[use], p[use], s[use], e[use], h[use]
            part = (h % np.uint64(parts)).astype(np.int64)
            first: dict[tuple[bytes, int], tuple] = {}
            rows = zip(doc.tolist(), p.tolist(), s.tolist(), e.tolist(), part.tolist(), np.isin(p, is_hot).tolist(), offs[doc].tolist(), strict=True)
            for i, x, a, z, k, heat, o in rows:
                key, right = text[x : z + length] + text[a:x][::-1], z + length - x
                # runs of hot anchors are made unique first, then cut into windows
                keep(first if heat else cold, (key, right), (ids[i], ths[i], x - o, k, o), (x - a, right))
            for (key, right), loc in first.items():
                own = key[right:][::-1] + key[:right]
                left = len(key) - right
                at = np.arange(len(own) - length + 1)
                route = (span_hashes(np.frombuffer(own, np.uint8), at, at + length) % np.uint64(parts)).tolist()
                for j, k in enumerate(route):
                    keep(hot, own[j : j + length], (loc[0], loc[1], loc[2] - left + j, k), (0, length))
            if len(cold) + len(hot) >= RUN:
                yield from flush()
        yield from flush()

    return t.mapInArrow(make, schema)


def merged_spans(runs: DataFrame, parts: int, length: int, k: int = KMER) -> DataFrame:
    """(d, th, spans): those that the tasks found, and those that equal suffixes and windows of different tasks remove."""
    def work(key, tab):
        spans = _Spans()
        found = tab.filter(pa.compute.is_valid(tab.column("doc"))).select(["doc", "doc_th", "spans"]).rename_columns(["d", "th", "spans"])
        for is_hot in (False, True):
            own = tab.filter(pa.compute.equal(tab.column("hot"), is_hot))
            if not own.num_rows:
                continue
            col = {c: own.column(c).to_pylist() for c in ("lcp", "len", "rest", "right", "d", "th", "p")}
            right = [np.frombuffer(x, np.uint16).tolist() for x in col["right"]]
            d, th, p = ([np.frombuffer(x, np.int64).tolist() for x in col[c]] for c in ("d", "th", "p"))
            at = [0] * len(d)
            group: dict[tuple[bytes, int], list] = {}
            edge = length if is_hot else k
            for h, suffix, r in merge([decode_run(*x) for x in zip(col["lcp"], col["len"], col["rest"], strict=True)]):
                if h < edge and group:  # another anchor (or window) begins
                    _resolve(group, spans, length)
                    group = {}
                i = at[r]
                at[r] = i + 1
                group.setdefault((suffix, right[r][i]), []).append((d[r][i], th[r][i], p[r][i]))
            _resolve(group, spans, length)
        return pa.concat_tables([found, pa.table(dict(zip(("d", "th", "spans"), spans.columns(), strict=True)))], promote_options="permissive")

    return _dealt(runs, parts).groupBy("part").applyInArrow(work, "d long, th long, spans array<int>")


def _resolve(group: dict, spans: _Spans, length: int) -> None:
    """Spans of one anchor: equal suffixes but for the earliest, then windows that different suffixes share."""
    firsts = []
    for (suffix, right), locs in group.items():
        first = min(locs) if len(locs) > 1 else locs[0]
        left = len(suffix) - right
        for loc in locs:
            if loc > first:
                spans.add(loc[0], loc[1], loc[2] - left, loc[2] + right)
        firsts.append((first, left, suffix, right))
    if len(firsts) < 2:
        return
    firsts.sort()
    seen: set[bytes] = set()
    for (d, th, p), left, suffix, right in firsts:
        own = suffix[right:][::-1] + suffix[:right]
        for j in range(len(own) - length + 1):
            w = own[j : j + length]
            if w in seen:
                spans.add(d, th, p - left + j, p - left + j + length)
            else:
                seen.add(w)


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, hot: int = HOT, parts: int | None = None, with_text: bool = False) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the remaining bytes, if asked).

    Earlier means: smaller id (null after all others); rows that share an id count in the order of their text's
    hash, and rows that repeat id and text are one document, each given its result. Null texts are empty. ``length``
    must be over KMER. Extra columns are ignored. ``parts``: groups of anchors that are sorted and merged as one, by
    default one for each ``PART`` bytes of text, at least 64 and as many as the session's shuffle partitions.
    """
    ship(docs.sparkSession)
    if not parts:
        size = docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
        parts = max(64, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // PART)
    t = docs.select(*_where(id_col, text_col))
    cand = repeated_anchors(t, parts, length, hot)
    # both joins need the texts by d with the same columns: their exchange is made once and used again
    spans = merged_spans(suffix_runs(t.join(cand, "d"), parts, length), parts, length)
    spans = spans.groupBy("d").agg(F.collect_list(F.struct("th", "spans")).alias("spans"))

    def cut(batches):
        for b in batches:
            data, offs = utf8(b.column("text"))
            text, rows = data.tobytes(), []
            ths = b.column("th").to_pylist()
            for i, found in enumerate(b.column("spans").to_pylist()):
                own = [v for f in found or () if f["th"] == ths[i] for v in f["spans"]]
                x = text[offs[i] : offs[i + 1]]
                kept, last, n, removed = [], 0, 0, 0
                for a, z in sorted(zip(own[::2], own[1::2], strict=True)) if own else ():
                    if a > last or n == 0:
                        kept.append(x[last:a])
                        n += 1
                        last = a
                    removed += max(0, z - last)
                    last = max(last, z)
                kept = b"".join([*kept, x[last:]])
                rows.append((len(x), removed, n, hashlib.sha256(kept).hexdigest(), kept if with_text else None))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            ids = b.column("d").to_pylist()
            out = [pa.array([None if v == NULL_ID else v for v in ids], kind), *[pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True)]]
            yield pa.record_batch(out[: 6 if with_text else 5], names[: 6 if with_text else 5])

    names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    kind = pa.int32() if dict(docs.dtypes)[id_col] == "int" else pa.int64()
    schema = f"`{id_col}` {'int' if kind == pa.int32() else 'long'}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return t.join(spans, "d", "left").mapInArrow(cut, schema)
