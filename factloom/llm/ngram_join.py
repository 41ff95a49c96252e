"""N-gram Jaccard join in the metric space of shingle sets, exact, with connected components as its result.

Pivots over the whole corpus do not part it: the distance of two unrelated documents to any pivot is almost 1 for
both, so triangle-inequality windows would copy every document into every region. Documents that cannot have a link are
therefore put aside first, and the rest falls into blocks; pivots part these, and all links come from there.

1. Filter, without loss. Linked sets differ in at most E elements (E follows from their sizes and the threshold). The
   shingle space is parted into m > E parts by a hash; each non-empty part of a set, hashed, is a key. E differing
   elements spoil at most E parts, so a document with a link shares at least (its keys - E) of them with others. Those
   that share fewer have no link: a common passage leaves most keys of its documents alone. Sets meet per pair of
   neighbouring size classes; very frequent shingles, found in a bounded sample, are left out of the keys (any fixed
   parting is exact); a set that has too few keys then takes a parting with all its shingles, or at last each shingle.
2. Blocks: documents that are connected by shared keys, among those that are left.
3. In each block, pivots (farthest first) create Voronoi regions; a set belongs to its nearest pivot's region and is
   copied into every region whose pivot is within 2t of its nearest distance (triangle inequality, t = 1 - threshold);
   regions join recursively. A pivot is linked with every set within t, and what is connected is not compared again.
   Regions of up to ``CHUNK`` documents and ``MASS`` shingles go on in one task; larger ones are parted by all tasks,
   round by round, and if their windows cover too much of them, the pairs of their chunks are tasks of their own.

Links are exact integer comparisons of set sizes; documents with one set are represented by one of them per task.
"""

from __future__ import annotations

import math
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.llm.common import K1, K2, filesystem, if_small, mix, shared_dir, ship, span_hashes, tidy, utf8
from factloom.operators.graph import connected_components
from factloom.session import discard, written

#: bytes, shingles and keys that a task holds as arrays at once
GROUP, TOKENS, KEYS = 1 << 19, 300_000, 600_000
#: documents and shingles of a region that are joined in one task; members of a region that are compared directly;
#: pivots; rounds in which all tasks part large regions
CHUNK, MASS, LEAF, PIVOTS, ROUNDS = 3000, 2_000_000, 1, 8, 12
#: a part of the key space for every 2^24 bytes of text; sets that a task remembers; large regions that are broadcast
PART_BITS, SEEN, BROADCAST_REGIONS = 24, 50_000, 10_000
#: documents (expected) that frequent shingles are looked for in, and in how many of them they must be
SAMPLE, FREQUENT = 4000, 5
#: ids to drop up to this count are broadcast
BROADCAST_IDS = 500_000
_BLOB = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
_LINK = [pa.int64(), pa.int64(), pa.string()]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, bounds by document): words are runs without white space, A-Z lower-cased."""
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    before, after = np.concatenate([[False], word[:-1]]), np.concatenate([word[1:], [False]])
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return span_hashes(_LOWER[data], starts, ends), np.searchsorted(starts, offs)


def byte_groups(offs: np.ndarray, limit: int):
    """Ranges of documents of about ``limit`` bytes; a longer one is alone."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, j
        i = j


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int) -> list[np.ndarray]:
    """The sorted distinct k-word shingle hashes of each document; fewer words are one shingle, no word none."""
    out: list[np.ndarray] = []
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + GROUP, "right")) - 1)
        if offs[j] - offs[i] > 2 * GROUP:  # one long document: words piece by piece, cut at white space
            d, parts, a = data[offs[i] : offs[j]], [], 0
            while a < len(d):
                b = min(a + GROUP, len(d))
                if b < len(d):
                    gap = np.flatnonzero(_SPACE[d[a:b]])
                    if not len(gap):
                        more = np.flatnonzero(_SPACE[d[b:]])
                        b = b + int(more[0]) + 1 if len(more) else len(d)
                    else:
                        b = a + int(gap[-1]) + 1
                parts.append(word_hashes(d[a:b], np.array([0, b - a]))[0])
                a = b
            h = np.concatenate(parts)
            bounds = np.array([0, len(h)])
        else:
            h, bounds = word_hashes(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
        s = h[: max(0, len(h) - k + 1)].copy()
        for x in range(1, k):
            s = s * K1 + h[x : len(h) - k + 1 + x]
        s = mix(s) if len(s) else s
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if b - a >= k:
                out.append(np.unique(s[a : b - k + 1]))
            elif b > a:
                few = np.full(1, b - a, np.uint64)
                for x in h[a:b]:
                    few = few * K2 + x
                out.append(mix(few))
            else:
                out.append(np.zeros(0, np.uint64))
        i = j
    return out


@lru_cache
def classes(num: int, den: int, largest: int = 1 << 31) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size classes for the threshold num/den: (lower ends, parts m, differing elements E), up to ``largest`` shingles.

    Linked sets lie in one class c or in c and c + 1; entry c is for these pairs. There are 1.6 E parts or more, and so
    many that a random set of the least size nearly always has more than E that are not empty.
    """
    low = [1]
    while low[-1] <= largest:
        low.append(max(low[-1] + 1, -(-low[-1] * den // num)))
    m, differ = [], []
    for c in range(len(low) - 2):
        e = (low[c + 1] + low[c + 2] - 2) * (den - num) // (den + num)
        parts, n = max(e + 1, -(-8 * e // 5)), low[c]
        while e and parts < 4 * n:
            lam = n / parts
            used = parts * (1 - math.exp(-lam))
            spread = parts * math.exp(-lam) * (1 - (1 + lam) * math.exp(-lam))
            if used - 3.5 * math.sqrt(max(0.0, spread)) >= e + 1:
                break
            parts += max(1, parts // 16)
        m.append(parts)
        differ.append(e)
    return np.array(low[: len(m)], np.int64), np.array(m, np.int64), np.array(differ, np.int64)


def signatures(sets: list[np.ndarray], hot: np.ndarray, num: int, den: int) -> tuple[np.ndarray, ...]:
    """(keys, number of the set of each; number of the set, lowest bit of its keys, and how many it must share at least).

    A set has two families of keys, one for each pair of classes that it may meet another set in; the families differ
    in the keys' lowest bit. A linked pair shares, in one family, at least as many as either set must.
    """
    low, ms, es = classes(num, den)
    sizes = np.array([len(s) for s in sets], np.int64)
    who = np.flatnonzero(sizes)
    if not len(who):
        z = np.zeros(0, np.int64)
        return z.view(np.uint64), z, z, z, z
    u = np.concatenate([sets[i] for i in who])
    doc = np.repeat(np.arange(len(who)), sizes[who])
    spread, value = mix(u ^ K2) >> np.uint64(32), mix(u + K1)
    plain = ~np.isin(u, hot) if len(hot) else np.ones(len(u), bool)
    cls = np.searchsorted(low, sizes[who], "right") - 1
    keys, docs, needs = [], [], []

    def family(win, tokens, take, level):
        """Emits the keys of the documents ``take``; returns how many each has."""
        m = np.where(take, ms[win], 0)
        base = np.cumsum(m) - m
        t = tokens & take[doc]
        slot = base[doc[t]] + (spread[t] * ms[win][doc[t]].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(slot, kind="stable")
        slot, v = slot[order], value[t][order]
        begin = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]])) if len(slot) else np.zeros(0, np.int64)
        acc, slot = np.add.reduceat(v, begin) if len(begin) else np.zeros(0, np.uint64), slot[begin]
        own = doc[t][order][begin]
        emit(acc, own, slot - base[own], win, level)
        return np.bincount(own, minlength=len(who))

    def emit(acc, own, part, win, level):
        w = win[own].astype(np.uint64)
        tag = (w << np.uint64(34)) + (part.astype(np.uint64) << np.uint64(2)) + np.uint64(level)
        keys.append((mix(acc + mix(tag)) & ~np.uint64(1)) | (w & np.uint64(1)))
        docs.append(own)

    for win in (cls, cls - 1):
        ok = win >= 0
        win = np.where(ok, win, 0)
        need = family(win, plain, ok, 0) - es[win]
        lacking = ok & (need < 1)
        if lacking.any():  # too few keys without the frequent shingles
            more = family(win, np.ones(len(u), bool), lacking, 1) - es[win]
            bare = lacking & (more < 1)
            if bare.any():  # too few parts that are not empty: each shingle by itself, of which linked sets share some
                t = bare[doc]
                emit(value[t], doc[t], np.zeros(int(t.sum()), np.int64), win, 2)
        at = np.flatnonzero(ok)
        needs.append((at, win[at] & 1, np.where(lacking, 1, need)[at]))
    at, bit, need = (np.concatenate(c) for c in zip(*needs, strict=True))
    return np.concatenate(keys), who[np.concatenate(docs)], who[at], bit, need


def set_id(s: np.ndarray) -> tuple[int, int, int]:
    """A 128-bit hash of a set, and its size."""
    return int(mix(s + K2).sum(dtype=np.uint64)), int(mix(s ^ K1).sum(dtype=np.uint64)), len(s)


class Block:
    """Exact links among the sets of one region, as a spanning forest: (one, other, whether one was a pivot)."""

    def __init__(self, sets: list[np.ndarray], num: int, den: int):
        self.num, self.den, self.t = num, den, 1 - num / den
        self.n = np.array([len(s) for s in sets], np.int64)
        _, self.idx = np.unique(np.concatenate(sets), return_inverse=True)
        self.ptr = np.concatenate([[0], np.cumsum(self.n)])
        self.mark = np.zeros(int(self.idx.max()) + 1, bool)
        self.root = np.arange(len(sets))
        self.links: list[tuple[int, int, bool]] = []

    def _shared(self, x: int, members: np.ndarray) -> np.ndarray:
        """Elements that x shares with each member."""
        own = self.idx[self.ptr[x] : self.ptr[x + 1]]
        self.mark[own] = True
        n = self.n[members]
        ends = np.cumsum(n)
        at = np.repeat(self.ptr[members] - (ends - n), n) + np.arange(int(ends[-1]))
        hits = np.add.reduceat(self.mark[self.idx[at]].astype(np.int64), ends - n)
        self.mark[own] = False
        return hits

    def _link(self, x: int, members: np.ndarray, pivot: bool) -> np.ndarray:
        """Links x with every member within the threshold; returns the distances."""
        both = self._shared(x, members)
        union = self.n[x] + self.n[members] - both
        for y in members[(self.den * both >= self.num * union) & (self.root[members] != self.root[x])].tolist():
            a, b = self.root[x], self.root[y]
            if a != b:
                self.root[self.root == max(a, b)] = min(a, b)
                self.links.append((x, y, pivot))
        return 1 - both / union

    def join(self) -> list[tuple[int, int, bool]]:
        stack = [np.arange(len(self.n))]
        while stack:
            own = stack.pop()
            if self._connected(own):
                continue
            if len(own) <= LEAF:
                self._direct(own)
                continue
            pivots, far = [], []
            while len(pivots) < min(PIVOTS, len(own)) and not self._connected(own):
                pivots.append(int(own[0 if not far else np.min(far, 0).argmax()]))
                far.append(self._link(pivots[-1], own, True))
            if len(pivots) == len(own) or self._connected(own):
                continue
            far = np.array(far)
            regions = [own[d <= far.min(0) + 2 * self.t + 1e-9] for d in far]
            if max(map(len, regions)) > 0.7 * len(own):  # the windows cover most of it: no use to go on parting
                self._direct(own)
            else:
                stack += regions
        return self.links

    def _connected(self, own: np.ndarray) -> bool:
        return bool((self.root[own] == self.root[own[0]]).all())

    def _direct(self, own: np.ndarray) -> None:
        """All pairs but those within the largest component so far, which are connected already."""
        roots, count = np.unique(self.root[own], return_counts=True)
        for x in own[self.root[own] != roots[count.argmax()]].tolist():
            rest = own[self.root[own] != self.root[x]]
            rest = rest[(self.den * np.minimum(self.n[rest], self.n[x]) >= self.num * np.maximum(self.n[rest], self.n[x]))]
            if len(rest):
                self._link(x, rest, False)


def frequent_shingles(t: DataFrame, n: int, k: int, sample: int = SAMPLE, least: int = FREQUENT, most: int = 200_000) -> np.ndarray:
    """The ``most`` most frequent shingles that are in at least ``least`` documents of a sample of ``sample`` (expected)
    of the ``n`` documents; which they are steers cost, never results."""
    if not n:
        return np.zeros(0, np.uint64)
    t = t.filter(F.pmod(F.xxhash64("d", F.lit(3)), F.lit(1_000_000)) < int(min(1.0, sample / n) * 1_000_000))

    def count(batches):
        for b in batches:
            # the sample is bounded, and so is a batch of it
            u, c = np.unique(np.concatenate([np.zeros(0, np.uint64), *shingle_sets(*utf8(b.column("text")), k)]), return_counts=True)
            yield pa.record_batch([pa.array(u.view(np.int64)), pa.array(c)], ["h", "n"])

    rows = t.mapInArrow(tidy(count, release=True), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).orderBy(F.desc("n"), "h").limit(most).select("h").collect()
    return np.sort(np.array([r["h"] for r in rows], np.int64).view(np.uint64))


def jaccard_components(docs: DataFrame, k: int, num: int, den: int, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (the smallest id reachable by links, itself included).

    Two documents link if den * |both| >= num * |either|. Null and empty texts, and texts of white space, have no
    shingle and no link. A null id has no link and a null component. Rows that share an id are one document with the
    links of all of them. Extra columns are ignored; an empty table gives none.
    """
    component = linked_components(docs, k, num, den, id_col, text_col, parts)

    def count(batches):
        for b in batches:
            data, offs = utf8(b.column("text"))
            n = [len(s) for x, y in byte_groups(offs, TOKENS * 16) for s in shingle_sets(data[offs[x] : offs[y]], offs[x : y + 1] - offs[x], k)]
            yield pa.record_batch([b.column("d"), pa.array(n, pa.int64())], ["d", "n_shingles"])

    t = docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).alias("text"))
    return t.mapInArrow(tidy(count, release=True), "d long, n_shingles long").join(component.withColumnRenamed("node", "d"), "d", "left") \
        .select(F.col("d").alias(id_col), "n_shingles", F.coalesce("component", "d").alias("component_id"))


def one_of_each(docs: DataFrame, k: int, num: int, den: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, but of linked documents only that with the smallest id."""
    drop = written(linked_components(docs, k, num, den, id_col, text_col).filter("node <> component").select(F.col("node").alias("_node")), "linked")
    return docs.join(if_small(drop, drop.count(), BROADCAST_IDS), docs[id_col] == drop["_node"], "left_anti")


def linked_components(docs: DataFrame, k: int, num: int, den: int, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """(node, component) of every document that has a link; nulls, ties and odd tables as in ``jaccard_components``."""
    return connected_components(jaccard_links(docs, k, num, den, id_col, text_col, parts), "a", "b")


def jaccard_links(docs: DataFrame, k: int, num: int, den: int, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """(a, b, via): links that connect all linked documents. ``via`` is ``pivot`` for those that a pivot's distances
    gave, ``pair`` for those of a region that windows do not part, ``copy`` for documents of one set in one task."""
    ship(docs.sparkSession)
    t = docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).alias("text"))
    known = t.filter("d is not null and text is not null")
    shape = known.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text").cast("long")).alias("bytes")).first()
    parts = parts or max(64, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), (shape["bytes"] or 0) >> PART_BITS)
    hot = frequent_shingles(known, shape["n"], k)

    # 1. documents that share enough keys with others, with their sets
    met = written(_by_key(known, parts, _from_texts(k), hot, num, den, score=True), "met")
    able = met.filter("kind = 0").groupBy("a", "bit").agg(F.sum("b").alias("n")).filter("n >= 0").select(F.col("a").alias("d")).distinct()

    def to_sets(batches):
        for b in batches:
            _, offs = utf8(b.column("text"))
            for x, y in byte_groups(offs, TOKENS * 16):
                own = b.slice(x, y - x)
                sets = shingle_sets(*utf8(own.column("text")), k)
                yield pa.record_batch([own.column("d"), pa.array([len(v) for v in sets], pa.int64()), pa.array([v.tobytes() for v in sets], pa.binary())], ["d", "size", "s"]).filter(pa.array([len(v) > 0 for v in sets], pa.bool_()))

    # the same plan at every size: not a broadcast of the ids as long as they happen to be few
    sets = written(known.join(able.hint("merge"), "d").mapInArrow(tidy(to_sets, release=True), "d long, size long, s binary"), "sets")

    # 2. blocks of those that are connected by shared keys
    blocks = connected_components(_by_key(sets, parts, _from_sets, hot, num, den, score=False).select("a", "b").distinct(), "a", "b")
    rows = sets.join(blocks.select(F.col("node").alias("d"), F.col("component").alias("region")).hint("merge"), "d").select("region", "d", "size", "s")

    # 3. regions
    links = [met.filter("kind = 1").select("a", "b", F.lit("copy").alias("via"))]
    rows = written(rows, "regions")
    discard(sets)
    links += _region_links(rows, num, den)
    return reduce(DataFrame.unionByName, links)


def _from_texts(k: int):
    def read(batches):
        for b in batches:
            ids, (data, offs) = b.column("d").to_pylist(), utf8(b.column("text"))
            for x, y in byte_groups(offs, TOKENS * 4):
                yield ids[x:y], shingle_sets(data[offs[x] : offs[y]], offs[x : y + 1] - offs[x], k)

    return read


def _from_sets(batches):
    for b in batches:
        ids, sizes = b.column("d").to_pylist(), np.cumsum(np.asarray(b.column("size")))
        i = 0
        while i < len(ids):
            j = max(i + 1, int(np.searchsorted(sizes, (sizes[i - 1] if i else 0) + TOKENS, "right")))
            yield ids[i:j], [np.frombuffer(s, np.uint64) for s in b.column("s").slice(i, j - i).to_pylist()]
            i = j


def key_blobs(h: np.ndarray, d: np.ndarray, parts: int, score: bool) -> list[tuple[int, int, bytes, bytes]]:
    """Rows (part, kind 2 or 3, keys, documents) of the keys h of documents d, by part of the key space.

    Documents take four bytes a key, as distances from the least id (kind 3), unless the ids of a part are too far apart.
    With ``score`` a key takes four bytes, too, its lowest bit kept: unequal keys that meet by that only let a document
    through the filter that has no link, and there are few.
    """
    rest, part = np.divmod(h >> np.uint64(1), np.uint64(parts))
    order = np.argsort(part, kind="stable")
    if score:
        h = ((rest << np.uint64(1)) | (h & np.uint64(1))).astype(np.uint32)
    h, d = h[order], d[order]
    ends = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
    rows = []
    for p, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
        if a < b:
            least, most = int(d[a:b].min()), int(d[a:b].max())
            near = most - least < 1 << 32
            rows.append((p, 3, h[a:b].tobytes(), np.int64(least).tobytes() + (d[a:b] - least).astype(np.uint32).tobytes()) if near else (p, 2, h[a:b].tobytes(), d[a:b].tobytes()))
    return rows


def key_documents(kind: int, d: bytes) -> np.ndarray:
    """The documents of a row of ``key_blobs``."""
    return np.frombuffer(d, np.int64, 1) + np.frombuffer(d, np.uint32, offset=8) if kind == 3 else np.frombuffer(d, np.int64)


def _by_key(t: DataFrame, parts: int, read, hot: np.ndarray, num: int, den: int, score: bool) -> DataFrame:
    """(kind, a, bit, b): exchanges keys in blobs by part of the key space.

    With ``score``: kind 0 rows add up, for each document a and family, to the keys that it shares less those that it
    must; kind 1 rows are copies b of a. Without: kind 2 rows are documents b and, for each of their shared keys, the
    smallest document a that has it.
    """
    def keys(batches):
        seen: dict[tuple, int] = {}
        got, needs, copies, n = [], [], [], 0

        def flush():
            rows = []
            if got:
                rows = key_blobs(*(np.concatenate(c) for c in zip(*got, strict=True)), parts, score)
            for kind, own in ((0, needs), (1, copies)):
                if own:
                    v = np.concatenate(own)
                    rows += [(p, kind, b"", v[v[:, 0] % parts == p].tobytes()) for p in np.unique(v[:, 0] % parts).tolist()]
                own.clear()
            got.clear()
            return pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), _BLOB, strict=True)] if rows else [pa.array([], kind) for kind in _BLOB], ["part", "kind", "h", "d"])

        for ids, sets in read(batches):
            new, who = [], []
            for i, s in zip(ids, sets, strict=True):
                if not len(s):
                    continue
                first = seen.setdefault(set_id(s), i) if score else i
                if first == i:
                    new.append(s)
                    who.append(i)
                else:
                    copies.append(np.array([[first, i, 0]], np.int64))
            if len(seen) > SEEN:  # sets that come again are then represented twice
                seen.clear()
            h, at, owner, bit, need = signatures(new, hot, num, den)
            ids = np.array(who, np.int64)
            got.append((h, ids[at]))
            if score:
                needs.append(np.stack([ids[owner], -need, bit], 1))
            n += len(h)
            if n >= KEYS:
                yield flush()
                n = 0
        yield flush()

    def meet(key, tab):
        kinds, raw_h, raw_d = np.asarray(tab.column("kind")), tab.column("h").to_pylist(), tab.column("d").to_pylist()
        of = lambda kind: np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(x, np.int64) for x, y in zip(raw_d, kinds, strict=True) if y == kind]])
        kept = np.uint32 if score else np.uint64
        h = np.concatenate([np.zeros(0, kept), *[np.frombuffer(x, kept) for x in raw_h if x]])
        d = np.concatenate([np.zeros(0, np.int64), *[key_documents(y, x) for x, y in zip(raw_d, kinds, strict=True) if y > 1]])
        order = np.lexsort((d, h))
        h, d = h[order], d[order]
        new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
        run = np.diff(np.append(new, len(h)))
        hub = np.repeat(d[new], run)
        if not score:
            e = np.unique(np.stack([hub, d], 1)[hub != d], axis=0)
            return pa.table({"kind": np.full(len(e), 2, np.int32), "a": e[:, 0], "bit": np.zeros(len(e), np.int32), "b": e[:, 1]})
        last = np.repeat(d[new + run - 1], run) if len(h) else hub
        shared = hub != last  # by at least two documents
        pair, count = np.unique(np.stack([d[shared], (h[shared] & kept(1)).astype(np.int64)], 1), axis=0, return_counts=True)
        need, copies = of(0).reshape(-1, 3), of(1).reshape(-1, 3)
        return pa.table({"kind": np.repeat(np.array([0, 0, 1], np.int32), [len(pair), len(need), len(copies)]), "a": np.concatenate([pair[:, 0], need[:, 0], copies[:, 0]]),
                         "bit": np.concatenate([pair[:, 1], need[:, 2], copies[:, 2]]).astype(np.int32), "b": np.concatenate([count, need[:, 1], copies[:, 1]])})

    blobs = t.mapInArrow(tidy(keys, release=True), "part int, kind int, h binary, d binary")
    return blobs.groupBy("part").applyInArrow(tidy(meet, release=True), "kind int, a long, bit int, b long")


def _region_links(rows: DataFrame, num: int, den: int) -> list[DataFrame]:
    """Links of the regions of ``rows`` (region, d, size, s): tables (a, b, via)."""
    found, small = [], []
    for _ in range(ROUNDS):
        sizes = rows.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("mass"))
        large = written(sizes.filter((F.col("n") > CHUNK) | (F.col("mass") > MASS) & (F.col("n") > 1)), "large")
        count = large.count()
        if not count:
            small.append(rows)
            break
        big = if_small(large, count, BROADCAST_REGIONS)
        small.append(rows.join(big.select("region"), "region", "left_anti"))
        got = written(_part(rows.join(big, "region"), num, den), "parted")
        found.append(got.filter("region is null").select("a", "b", F.lit("pivot").alias("via")))
        got = got.filter("region is not null")
        # what is linked with its pivot is connected: it is needed only within t of something that is not
        state = got.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.min(F.when(~F.col("linked"), F.col("far"))).alias("near"), F.max("of").alias("of"))
        state = state.filter("near is not null").select("region", "near", (F.col("n") > 0.7 * F.col("of")).alias("stuck"))
        got = got.join(state, "region").filter(~F.col("linked") | (F.col("far") >= F.col("near") - (1 - num / den) - 1e-9))
        small.append(got.filter("stuck").select("region", "d", "size", "s"))
        rows = written(got.filter("not stuck").select("region", "d", "size", "s"), "regions")
    else:
        small.append(rows)
    return [*found, _joined(reduce(DataFrame.unionByName, small), num, den)]


def _part(rows: DataFrame, num: int, den: int) -> DataFrame:
    """One round on large regions (columns n and mass besides): rows of the regions of their pivots (region, d, size, s,
    far: the distance to the pivot, linked: whether it is a link, of: documents in the region that was parted), and
    links (a, b) with the region null. Pivots are ``PIVOTS`` documents of each, written and read where they are used."""
    spark = rows.sparkSession
    folder = shared_dir(spark, "pivots")
    order = Window.partitionBy("region").orderBy(F.xxhash64("d"), "d")
    rows.select("region", "d", "s").withColumn("k", F.row_number().over(order)).filter(F.col("k") <= PIVOTS).write.parquet(folder)
    # slices of a region: each is read by one task, whatever the region's size
    slices = F.greatest(F.ceil(F.col("n") / CHUNK), F.ceil(F.col("mass") / MASS))
    cut = rows.withColumn("slice", F.pmod(F.xxhash64("d", F.lit(5)), slices)).repartition("region", "slice").sortWithinPartitions("region", "slice", "d").select("region", "d", "size", "s", "n")
    names = ["region", "d", "size", "s", "far", "linked", "of", "a", "b"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.float64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]
    t = 1 - num / den

    def measure(batches):
        import pyarrow.dataset as ds

        fs, path = filesystem(folder)
        region, pivots = None, []
        for b in batches:
            key = np.asarray(b.column("region"))
            edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
            for x, y in zip(edges.tolist(), [*edges[1:].tolist(), len(key)], strict=True):
                if region != int(key[x]):
                    region = int(key[x])
                    tab = ds.dataset(path, filesystem=fs, format="parquet").to_table(["d", "s"], filter=ds.field("region") == region)
                    pivots = sorted(zip(tab.column("d").to_pylist(), [np.frombuffer(v, np.uint64) for v in tab.column("s").to_pylist()], strict=True), key=lambda p: p[0])
                own = b.slice(x, y - x)
                n, ids = np.asarray(own.column("size")), np.asarray(own.column("d"))
                el = np.frombuffer(b"".join(own.column("s").to_pylist()), np.uint64)
                begin = np.cumsum(n) - n
                far, linked, links = [], [], []
                for d, p in pivots:
                    both = np.add.reduceat((p[np.minimum(np.searchsorted(p, el), len(p) - 1)] == el).astype(np.int64), begin)
                    union = n + len(p) - both
                    far.append(1 - both / union)
                    linked.append(den * both >= num * union)
                    links.append(np.stack([np.full(int(linked[-1].sum()), d), ids[linked[-1]]], 1))
                far = np.array(far)
                q, i = np.nonzero(far <= far.min(0) + 2 * t + 1e-9)
                to = mix(np.array([d for d, _ in pivots], np.int64).view(np.uint64) * K1 + np.array([region], np.int64).view(np.uint64)).view(np.int64)
                out = own.select(["d", "size", "s"]).take(pa.array(i))
                yield pa.record_batch([pa.array(to[q]), *out.columns, pa.array(far[q, i]), pa.array(np.array(linked)[q, i]), own.column("n").take(pa.array(i)), *[pa.nulls(len(q), k) for k in kinds[7:]]], names)
                a, z = np.concatenate(links).T
                ok = a != z
                yield pa.record_batch([*[pa.nulls(int(ok.sum()), k) for k in kinds[:7]], pa.array(a[ok]), pa.array(z[ok])], names)

    return cut.mapInArrow(tidy(measure, release=True), "region long, d long, size long, s binary, far double, linked boolean, of long, a long, b long")


def _joined(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Links within regions, each in one task; in those beyond the bounds, of the pairs of their chunks."""
    sizes = rows.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("mass"))
    large = written(sizes.filter((F.col("n") > CHUNK) | (F.col("mass") > MASS) & (F.col("n") > 1)).select("region", F.greatest(F.ceil(F.col("n") / CHUNK), F.ceil(F.col("mass") / MASS)).cast("int").alias("chunks")), "stuck")
    placed = rows.join(if_small(large, large.count(), BROADCAST_REGIONS), "region", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("d", F.lit(5)), F.col("chunks")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda x: F.struct(F.least(x, F.col("own")).alias("i"), F.greatest(x, F.col("own")).alias("j")))
    cut = placed.select("region", F.explode(pairs).alias("c"), "d", "s").select("region", "c.i", "c.j", "d", "s").repartition("region", "i", "j").sortWithinPartitions("region", "i", "j", "d")

    def join(batches):
        key, ids, own = None, [], []

        def links():
            first: dict[bytes, int] = {}
            out = []
            for i, s in zip(ids, own, strict=True):
                if first.setdefault(s, i) != i:
                    out.append((first[s], i, "copy"))
            if len(first) > 1:
                reps = list(first.values())
                out += [(reps[x], reps[y], "pivot" if pivot else "pair") for x, y, pivot in Block([np.frombuffer(s, np.uint64) for s in first], num, den).join()]
            return out

        for b in batches:
            found = []
            cols = [b.column(c).to_pylist() for c in ("region", "i", "j", "d", "s")]
            for region, i, j, d, s in zip(*cols, strict=True):
                if (region, i, j) != key:
                    found += links()
                    key, ids, own = (region, i, j), [], []
                ids.append(d)
                own.append(s)
            yield pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*found, strict=True), _LINK, strict=True)] if found else [pa.array([], kind) for kind in _LINK], ["a", "b", "via"])
        found = links()
        if found:
            yield pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*found, strict=True), _LINK, strict=True)], ["a", "b", "via"])

    return cut.mapInArrow(tidy(join, release=True), "a long, b long, via string")
