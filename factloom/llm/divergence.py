"""Source divergence audit: how far the word use of each source of a language is from every other source's, and by which terms.

Document frequencies go into count-min sketches first, one per task, merged cell by cell; a merged count never
underestimates, so terms whose least cell is below ``min_docs`` are in too few documents for certain and are discarded
before anything is shuffled by term. The survivors are counted exactly. Counts travel as packed arrays, dealt by
(language, part of the terms): a part has all of a term's counts, so sources are joined on the terms that they share within
the part; terms that one or both lack enter by sums over the counts that occur.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.llm import words
from factloom.llm.common import K2, if_small, mix, ship, trim, written

#: letters, and whatever is not ASCII
TERM = words.all_but(*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80))
#: rows and cells a row of the sketch (8 MB in a task, 1 MB as the broadcast bits); cells that are merged as one row
DEPTH, WIDTH, BLOCK = 2, 1 << 22, 1 << 16
#: groups (language, source) up to this count are broadcast; bytes of text for each part of a language's terms
BROADCAST_GROUPS, PART_BYTES = 50_000, 32 << 20
#: pairs of sources that a task sums up before it passes them on
PAIRS = 1 << 21
SCALE = 1_000_000_000
COUNTS = "lang string, part int, sources array<string>, terms array<string>, s binary, t binary, n binary, docs binary"


def _codes(column: pa.Array) -> tuple[np.ndarray, list]:
    d = column.fill_null("").dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary.to_pylist()


def _parts(batches):
    """For slices of text: (lang of each text, langs, source of each text, sources, term of each occurrence, terms, its text)."""
    for b in batches:
        for i, j in words.slices(b.column(0), 1 << 23):
            own = b.slice(i, j - i)
            w, bounds, _ = words.words(own.column(0), TERM)
            codes, terms = words.coded(w)
            yield *_codes(own.column(1)), *_codes(own.column(2)), codes, terms, np.repeat(np.arange(j - i), np.diff(bounds))
        trim()


def _tally(codes: np.ndarray, text: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code, group, occurrences, texts) of each code and group that occur; ``group`` goes by text. One sort of the occurrences."""
    by = np.argsort(group, kind="stable")  # texts of a group get neighbouring places
    place = np.empty(len(group), np.int64)
    place[by] = np.arange(len(group))
    key = codes * len(group) + place[text]
    key.sort()
    new_text = np.append(True, key[1:] != key[:-1])
    at = np.flatnonzero(new_text)
    code, own = np.divmod(key[at], len(group))
    own = group[by][own]
    first = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (own[1:] != own[:-1])))
    return code[first], own[first], np.diff(np.append(at[first], len(key))), np.diff(np.append(first, len(at)))


def _cells(lang: str, terms: np.ndarray, width: int) -> list[np.ndarray]:
    """The cell of each row of the sketch for terms (hashes) of a language."""
    h = mix(terms ^ mix(np.array([zlib.crc32(lang.encode()) + 1], np.uint64)))
    return [(h >> np.uint64(20)).astype(np.int64) % width, (mix(h * K2) >> np.uint64(20)).astype(np.int64) % width]


def _add(cells: np.ndarray, at: np.ndarray, n: np.ndarray, cap: int) -> None:
    u, inverse = np.unique(at, return_inverse=True)
    cells[u] = np.minimum(cap, cells[u] + np.bincount(inverse, n).astype(np.int64))


def _merged(keys: tuple[str, ...]):
    """Adds up the blocks of sketches that agree in ``keys``; a task holds one block for each."""

    def merge(batches):
        sums: dict[tuple, np.ndarray] = {}
        for b in batches:
            for key, x in zip(zip(*(b.column(k).to_pylist() for k in (*keys, "cap")), strict=True), b.column("cells"), strict=True):
                x = np.frombuffer(x.as_buffer(), np.uint8)
                sums[key] = np.minimum(key[-1], sums[key].astype(np.uint16) + x).astype(np.uint8) if key in sums else x.copy()
        for key, x in sums.items():
            yield pa.record_batch([*(pa.array([k], pa.int32()) for k in key), pa.array([x.tobytes()], pa.binary())], [*keys, "cap", "cells"])

    return merge


def possible_terms(t: DataFrame, min_docs: int, width: int = WIDTH) -> np.ndarray:
    """The merged sketch of document frequencies as bits, DEPTH x ``width``: whether a cell has ``min_docs`` or more."""
    cap = min(min_docs, 255)

    def sketch(batches):
        from pyspark import TaskContext

        cells = np.zeros((DEPTH, width), np.uint8)
        for lang, langs, _, _, codes, terms, text in _parts(batches):
            if not len(codes):
                continue
            h = words.hashes(terms)
            code, group, _, n = _tally(codes, text, lang)  # each term once a document
            for k, name in enumerate(langs):
                own = group == k
                for row, at in zip(cells, _cells(name, h[code[own]], width), strict=True):
                    _add(row, at, n[own], cap)
        task, flat = TaskContext.get().partitionId(), cells.ravel()
        for k in range(0, len(flat), BLOCK):
            part = flat[k : k + BLOCK]
            if part.any():
                yield pa.record_batch([pa.array([k // BLOCK], pa.int32()), pa.array([task % 64], pa.int32()), pa.array([cap], pa.int32()), pa.array([part.tobytes()])], ["block", "salt", "cap", "cells"])

    s = t.mapInArrow(sketch, "block int, salt int, cap int, cells binary")
    for keys in (("block", "salt"), ("block",)):  # first within a salt, then across salts
        s = s.repartition(*keys).mapInArrow(_merged(keys), ", ".join(f"{k} int" for k in keys) + ", cap int, cells binary")
    bits = np.zeros(-(-DEPTH * width // 8), np.uint8)

    def enough(batches):
        for b in batches:
            x = [np.packbits(np.frombuffer(c.as_buffer(), np.uint8) >= cap).tobytes() for c in b.column("cells")]
            yield pa.record_batch([b.column("block"), pa.array(x, pa.binary())], ["block", "bits"])

    for r in s.mapInArrow(enough, "block int, bits binary").collect():
        x = np.frombuffer(bytes(r["bits"]), np.uint8)
        bits[r["block"] * BLOCK // 8 : r["block"] * BLOCK // 8 + len(x)] = x
    return bits


def _listed(part: np.ndarray, idx: np.ndarray, names: pa.Array, parts: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(for each of ``parts`` the list of its names, each row's place in the list of its part); rows are sorted by part."""
    pair, inverse = np.unique(part * max(1, len(names)) + idx, return_inverse=True)
    ends = np.searchsorted(pair, np.append(parts, parts[-1:] + 1) * max(1, len(names)))
    lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), names.take(pa.array(pair % max(1, len(names)))))
    return lists, inverse - np.repeat(ends[:-1], np.diff(np.searchsorted(part, np.append(parts, parts[-1:] + 1))))


def _packed(lang: str, part: np.ndarray, source: np.ndarray, sources: pa.Array, term: np.ndarray, terms: pa.Array, n: np.ndarray, docs: np.ndarray, salt: int | None = None) -> pa.RecordBatch:
    """Counts as one row for each part."""
    by = np.argsort(part, kind="stable")
    part, source, term, n, docs = part[by], source[by], term[by], n[by], docs[by]
    parts = np.unique(part)
    ends = np.searchsorted(part, np.append(parts, parts[-1:] + 1))
    s_lists, s = _listed(part, source, sources, parts)
    t_lists, t = _listed(part, term, terms, parts)
    blob = lambda x, kind: pa.Array.from_buffers(pa.binary(), len(parts), [None, pa.py_buffer((ends * np.dtype(kind).itemsize).astype(np.int32)), pa.py_buffer(x.astype(kind))])
    columns = {"lang": pa.array([lang] * len(parts), pa.string()), "part": pa.array(parts.astype(np.int32)), "sources": s_lists, "terms": t_lists,
               "s": blob(s, np.int32), "t": blob(t, np.int32), "n": blob(n, np.int64), "docs": blob(docs, np.int64)}
    if salt is not None:
        columns["salt"] = pa.array(np.full(len(parts), salt, np.int32))
    return pa.RecordBatch.from_pydict(columns)


def _unpacked(tab: pa.Table) -> tuple[np.ndarray, pa.Array, np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """(source, sources, term, terms, n, docs) of rows in one language and part, sorted by term and source, each pair once."""
    def values(c, kind):
        x = [np.frombuffer(v.as_buffer(), kind) for chunk in tab.column(c).chunks for v in chunk]
        return x, np.concatenate(x) if x else np.zeros(0, kind)

    out = []
    rows, n = values("n", np.int64)
    sizes = np.array([len(x) for x in rows])
    for lists, places in (("sources", "s"), ("terms", "t")):
        chunks = tab.column(lists).chunks
        codes, names = words.coded(pa.concat_arrays([c.flatten() for c in chunks]).cast(pa.string()))
        lens = np.concatenate([np.diff(c.offsets.to_numpy()) for c in chunks])
        out += [codes[values(places, np.int32)[1] + np.repeat(np.cumsum(lens) - lens, sizes)], names.cast(pa.string())]
    source, sources, term, terms = out
    key = term * len(sources) + source
    by = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.append(True, key[by][1:] != key[by][:-1]))
    total = lambda x: np.add.reduceat(x[by], first)
    return source[by][first], sources, term[by][first], terms, total(n), total(values("docs", np.int64)[1])


def _counts(t: DataFrame, bits: np.ndarray, width: int, parts: dict[str, int], salts: int) -> DataFrame:
    """Packed counts, with a ``salt``, of the terms that the sketch leaves, summed up within slices of text only."""
    sent = t.sparkSession.sparkContext.broadcast(bits)

    def count(batches):
        from pyspark import TaskContext

        bits, salt = sent.value, TaskContext.get().partitionId() % salts
        for lang, langs, source, sources, codes, terms, text in _parts(batches):
            if not len(codes):
                continue
            h, names = words.hashes(terms), pa.array(sources, pa.string())
            may = np.zeros((len(langs), len(terms)), bool)
            for k, name in enumerate(langs):
                may[k] = True
                for row, at in enumerate(_cells(name, h, width)):
                    at = at + row * width
                    may[k] &= (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
            left = may[lang[text], codes]
            if not left.any():
                continue
            code, g, n, docs = _tally(codes[left], text[left], lang * len(sources) + source)
            of = g // len(sources)
            for k in np.unique(of):
                own = of == k
                part = (h[code[own]] >> np.uint64(8)).astype(np.int64) % parts[langs[k]]
                yield _packed(langs[k], part, g[own] % len(sources), names, code[own], terms, n[own], docs[own], salt)

    return t.mapInArrow(count, COUNTS + ", salt int")


def _exact(t: DataFrame, min_docs: int, width: int, part_bytes: int) -> DataFrame:
    """Packed exact counts of the terms in at least ``min_docs`` documents of their language, one row for each language and part."""
    sizes = t.groupBy("lang").agg(F.sum(F.octet_length("text").cast("long")).alias("n")).collect()
    parts = {r["lang"]: 1 + r["n"] // part_bytes for r in sizes}
    rows = _counts(t, possible_terms(t, min_docs, width), width, parts, max(1, round(t.rdd.getNumPartitions() ** 0.5)))

    def merge(least):
        def of(key, tab):
            source, sources, term, terms, n, docs = _unpacked(tab)
            if least:
                kept = (np.bincount(term, docs, len(terms)) >= least)[term]
                source, term, n, docs = source[kept], term[kept], n[kept], docs[kept]
            out = [_packed(key[0].as_py(), np.full(len(term), key[1].as_py()), source, sources, term, terms, n, docs)] if len(term) else []
            trim()
            return pa.Table.from_batches(out, out[0].schema if out else EMPTY)
        return of

    # a term's counts meet within a salt first: a frequent term has counts in every task
    rows = rows.groupBy("lang", "part", "salt").applyInArrow(merge(0), COUNTS)
    return rows.groupBy("lang", "part").applyInArrow(merge(min_docs), COUNTS)


EMPTY = pa.schema([("lang", pa.string()), ("part", pa.int32()), ("sources", pa.list_(pa.string())), ("terms", pa.list_(pa.string())), *((c, pa.binary()) for c in ("s", "t", "n", "docs"))])


def _sums(batches):
    """Rows (lang, source, total, terms) of each part; source null: the whole language."""
    for b in batches:
        for k in range(b.num_rows):
            row = pa.Table.from_batches([b.slice(k, 1)])
            source, sources, term, terms, n, _ = _unpacked(row)
            total = np.append(np.bincount(source, n, len(sources)), n.sum()).astype(np.int64)  # sums of a part stay far below 2^53
            has = np.append(np.bincount(source, minlength=len(sources)), len(terms))
            yield pa.record_batch([pa.array(row.column("lang").to_pylist() * len(total), pa.string()), pa.array([*sources.to_pylist(), None], pa.string()), pa.array(total), pa.array(has)], ["lang", "source", "total", "terms"])


def _shares(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (n + 1) / total), in Python's integers, once for each pair that occurs."""
    pair, inverse = np.unique(np.stack([n, total]), axis=1, return_inverse=True)
    return np.array([1 + SCALE * (int(a) + 1) // int(b) for a, b in pair.T], np.int64)[inverse.ravel()]


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // q


def _compared(ranks: int):
    """Rows of a part: ``both`` (a, b: sources, value: what shared terms change), ``once`` (a, value: a share, m: terms that have it), ``term``."""

    def rows(kind, lang, a, b, item, value, m):
        n = len(value)
        ints = lambda x: pa.array(x if x is not None else np.zeros(n, np.int64))
        return pa.record_batch([pa.array([kind] * n, pa.string()), pa.array([lang] * n, pa.string()), ints(a), ints(b), pa.nulls(n, pa.string()) if item is None else item, ints(value), ints(m)], ["kind", "lang", "a", "b", "item", "value", "m"])

    def summed(key, value):
        by = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.append(True, key[by][1:] != key[by][:-1]))
        return key[by][first], np.add.reduceat(value[by], first)

    def compare(batches):
        for b in batches:
            for k in range(b.num_rows):
                row = pa.Table.from_batches([b.slice(k, 1)])
                lang = row.column("lang")[0].as_py()
                source, sources, term, terms, n, _ = _unpacked(row)
                stats = {x["source"]: x for x in row.column("stats")[0].as_py()}
                stat = lambda c: np.array([stats[x][c] for x in sources.to_pylist()], np.int64)  # noqa: B023, E731
                g, p0, total, v, lang_total = stat("g"), stat("p0"), stat("total"), stat("v")[0], stat("lang_total")[0]
                p = _shares(n, total[source] + v)
                first = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
                q = np.repeat(_shares(np.add.reduceat(n, first), np.full(len(first), lang_total + v)), np.diff(np.append(first, len(n))))
                # marks: the first of each source by value, then by the term's bytes
                marks = np.flatnonzero(p > q)
                value = _apart(p[marks], q[marks])
                place = np.empty(len(terms), np.int64)
                place[pc.sort_indices(terms.cast(pa.binary())).to_numpy()] = np.arange(len(terms))
                by = np.lexsort((place[term[marks]], -value, source[marks]))
                ends = np.searchsorted(source[marks][by], np.arange(len(sources) + 1))
                by = by[np.arange(len(by)) - np.repeat(ends[:-1], np.diff(ends)) < ranks]
                yield rows("term", lang, g[source[marks[by]]], None, terms.take(pa.array(term[marks[by]])), value[by], None)
                pair, m = np.unique(np.stack([source, p]), axis=1, return_counts=True)
                yield rows("once", lang, g[pair[0]], None, None, pair[1], m)
                # sources that share a term lie next to each other: first neighbours, then those two apart, and so on
                keys, values, held, at, d = [], [], 0, np.arange(len(term)), 0
                while True:
                    d += 1
                    at = at[at + d < len(term)]
                    at = at[term[at + d] == term[at]]
                    if len(at):
                        x, y = source[at], source[at + d]
                        px, py, p0x, p0y = p[at], p[at + d], p0[x], p0[y]
                        for s, t, ps, pt, p0s, p0t in ((x, y, px, py, p0x, p0y), (y, x, py, px, p0y, p0x)):
                            key, value = summed(s * len(sources) + t, _apart(ps, pt) - _apart(ps, p0t) - _apart(p0s, pt) + _apart(p0s, p0t))
                            keys.append(key)
                            values.append(value)
                            held += len(key)
                    if keys and (not len(at) or held > PAIRS):
                        key, value = summed(np.concatenate(keys), np.concatenate(values))
                        yield rows("both", lang, g[key // len(sources)], g[key % len(sources)], None, value, None)
                        keys, values, held = [], [], 0
                    if not len(at):
                        break
            trim()

    return compare


def _far(p: str, q: str) -> Column:
    """floor((p - q)^2 / q); both are at most 10^9 + 1, so the square fits a long."""
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})")


def _share(n: str, total: str, kept: str) -> Column:
    """1 + floor(10^9 (n + 1) / (total + kept)), in decimals: the product may pass 64 bits."""
    return F.expr(f"1 + (cast({SCALE} as decimal(10,0)) * cast({n} + 1 as decimal(20,0))) div cast({total} + {kept} as decimal(20,0))")


def divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = 3, ranks: int = 200, width: int = WIDTH, part_bytes: int = PART_BYTES) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): part ``pair`` against every other source of the language, part ``term``
    the terms that mark the source against its whole language, the first ``ranks`` of each source.

    Every row is a document, repeated rows and rows without or with equal ids too. A null text, language or source is ''.
    A term is a run of ASCII letters and of characters beyond ASCII; a language keeps those in at least ``min_docs``
    documents. A source without any term still has pairs; a language with one source has none; an empty table gives no
    row. Ties in value are ranked by the item's bytes. Other columns, whatever their names, are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    t = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))))
    kept = written(_exact(t, min_docs, width, part_bytes), "divergence-counts")
    sums = kept.mapInArrow(_sums, "lang string, source string, total long, terms long").groupBy("lang", "source").agg(F.sum("total").alias("total"), F.sum("terms").alias("terms"))
    by_lang = sums.filter("source is null").select("lang", F.col("total").alias("lang_total"), F.col("terms").alias("v"))
    groups = t.select("lang", "source").distinct().join(sums.filter("source is not null").drop("terms"), ["lang", "source"], "left").join(by_lang, "lang", "left").na.fill(0, ["total", "lang_total", "v"])
    groups = groups.withColumn("p0", F.when(F.col("v") > 0, _share("0", "total", "greatest(v, 1)")).otherwise(F.lit(1)))
    groups = written(groups.withColumn("g", F.monotonically_increasing_id()), "divergence-groups")
    sized = lambda df, n=groups.count(): if_small(df, n, BROADCAST_GROUPS)

    stats = kept.select("lang", "part", F.explode("sources").alias("source")).join(sized(groups), ["lang", "source"]) \
        .groupBy("lang", "part").agg(F.collect_list(F.struct("source", "g", "p0", "total", "v", "lang_total")).alias("stats"))
    found = written(kept.join(stats, ["lang", "part"]).mapInArrow(_compared(ranks), "kind string, lang string, a long, b long, item string, value long, m long"), "divergence-found")

    marks = found.filter("kind = 'term'").select(F.col("a").alias("g"), "item", "value").join(sized(groups.select("g", "lang", "source")), "g")
    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    marks = marks.select("lang", "source", F.lit("term").alias("part"), "item", "value").withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= ranks)

    a, b = (groups.select("lang", *(F.col(c).alias(f"{c}_{x}") for c in ("source", "g", "p0", "v"))) for x in "ab")
    pairs = a.join(sized(b), "lang").filter("g_a <> g_b")
    # what terms of one source add if the other had none of them, over the counts that occur
    hist = found.filter("kind = 'once'").groupBy("lang", F.col("a").alias("g"), F.col("value").alias("p")).agg(F.sum("m").alias("m"))
    x, y = hist.select("lang", F.col("g").alias("g_a"), "p", "m"), hist.select("lang", F.col("g").alias("g_b"), "p", "m")
    x = x.join(sized(groups.select(F.col("g").alias("g_a"), F.col("p0").alias("p0_a"))), "g_a").join(sized(b.select("lang", "g_b", "p0_b")), "lang").filter("g_a <> g_b") \
        .select("g_a", "g_b", (F.col("m") * (_far("p", "p0_b") - _far("p0_a", "p0_b"))).alias("value"))
    y = y.join(sized(groups.select(F.col("g").alias("g_b"), F.col("p0").alias("p0_b"))), "g_b").join(sized(a.select("lang", "g_a", "p0_a")), "lang").filter("g_a <> g_b") \
        .select("g_a", "g_b", (F.col("m") * (_far("p0_a", "p") - _far("p0_a", "p0_b"))).alias("value"))
    both = found.filter("kind = 'both'").select(F.col("a").alias("g_a"), F.col("b").alias("g_b"), "value")
    parts = x.unionByName(y).unionByName(both).groupBy("g_a", "g_b").agg(F.sum("value").alias("value"))
    far = pairs.join(parts, ["g_a", "g_b"], "left").select(
        "lang", F.col("source_a").alias("source"), F.lit("pair").alias("part"), F.col("source_b").alias("item"),
        F.when(F.col("v_a") > 0, F.col("v_a") * _far("p0_a", "p0_b") + F.coalesce("value", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("value"))
    return far.withColumn("rank", F.row_number().over(first)).unionByName(marks)
