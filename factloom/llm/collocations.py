"""Phrase collocation mining by pivot partitioning (MG-FSM): frequent contiguous phrases, scored by their weakest cut.

Words are ordered by frequency, the most frequent first. Every occurrence of a phrase belongs to its pivot, the leftmost
occurrence of its last word in that order (its rarest word). The text around a pivot is rewritten to the run of
words before it in the order, at most ``longest`` - 1 on either side, and routed to the pivot's part; parts are mined one by
one and give only the phrases that their pivots own, so that no occurrence is counted twice. Pivots with very many
occurrences are dealt over several parts, whose counts are added up.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.llm import words
from factloom.llm.common import K1, mix, ship, trim, written

BREAKS = [*b".,;:!?", *range(0x0A, 0x0E)]
WORD = words.all_but(0x20, 0x09, *BREAKS)
IS_BREAK = np.zeros(256, bool)
IS_BREAK[BREAKS] = True
#: words whose ranks every task holds, and bytes of such a word; occurrences in a part; occurrences of a pivot in a part
RANKED, RANKED_BYTES, PART, PIVOT_PART = 1 << 18, 64, 2_000_000, 250_000
#: places of words that are not ranked, but may be frequent: their string follows in the column ``rest``
OTHER = -2


def _slices(batches):
    """For slices of text and each language in them: (lang, texts)."""
    for b in batches:
        for i, j in words.slices(b.column(0)):
            own = b.slice(i, j - i)
            d = own.column(1).dictionary_encode()
            codes = d.indices.to_numpy(zero_copy_only=False)
            for k, lang in enumerate(d.dictionary.to_pylist()):
                yield lang, own.column(0).filter(pa.array(codes == k))
        trim()


def _word_counts(t: DataFrame) -> DataFrame:
    def count(batches):
        for lang, texts in _slices(batches):
            codes, distinct = words.coded(words.words(texts, WORD)[0])
            n = np.bincount(codes, minlength=len(distinct))
            yield pa.record_batch([pa.array([lang] * len(distinct), pa.string()), distinct, pa.array(n.astype(np.int64))], ["lang", "word", "n"])

    return t.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _ranked(frequent: DataFrame, ranked: int) -> tuple[dict, bool]:
    """(lang -> its most frequent words, their ranks over all languages and counts), and whether these are all of ``frequent``.

    At most ``ranked`` words of at most RANKED_BYTES: from the least power of two that leaves so few.
    """
    levels = {r["level"]: r["n"] for r in frequent.groupBy(F.expr("int(log2(n))").alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total, least = sum(levels.values()), 0
    while sum(n for level, n in levels.items() if level >= least) > ranked:
        least += 1
    got = frequent.filter(F.expr("int(log2(n))") >= least).filter(F.octet_length("word") <= RANKED_BYTES).toArrow()
    got = got.sort_by([("n", "descending"), ("lang", "ascending"), ("word", "ascending")]).append_column("rank", pa.array(np.arange(len(got), dtype=np.int64)))
    out = {}
    for lang in got.column("lang").unique().to_pylist():
        own = got.filter(pc.equal(got.column("lang"), lang))
        out[lang] = own.column("word").combine_chunks().cast(pa.string()), own.column("rank").to_numpy(), own.column("n").to_numpy()
    return out, len(got) == total


def fragments(texts: pa.Array, table: tuple, complete: bool, longest: int):
    """Rewritten fragments of texts in one language: (pivot's key, pivot's count or 0, before, after, places in the words, ranks, words).

    ``ranks``: each word's rank, OTHER, or -1 for a word that is certainly infrequent; a fragment is the words from
    ``place - before`` to ``place + after``.
    """
    w, bounds, begin = words.words(texts, WORD)
    codes, distinct = words.coded(w)
    known, rank_of, count_of = table
    at = pc.index_in(distinct, value_set=known).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    rank = np.where(at >= 0, np.append(rank_of, 0)[at], -1 if complete else OTHER)
    # a total order of the words: ranks, then hashes; words beyond the ranks are all rarer than these
    order = rank if complete else np.where(at >= 0, rank, RANKED + (words.hashes(distinct) >> np.uint64(4)).astype(np.int64) % (1 << 60))
    count = np.where(at >= 0, np.append(count_of, 0)[at], 0)
    rank, order, count = rank[codes], order[codes], count[codes]
    data = words.utf8(texts)[0]
    piece = np.searchsorted(np.flatnonzero(IS_BREAK[data]), begin) + np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))  # rises at either border
    n = len(rank)
    before, after = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for side, out in ((-1, before), (1, after)):
        going = order >= 0
        for d in range(1, longest):
            here, there = (slice(d, n), slice(0, n - d)) if side < 0 else (slice(0, max(0, n - d)), slice(min(n, d), n))
            ok = np.zeros(n, bool)
            less = order[there] < order[here] if side < 0 else order[there] <= order[here]
            ok[here] = going[here] & (piece[there] == piece[here]) & less & (order[there] >= 0)
            out += ok
            going = ok
    place = np.flatnonzero(before + after > 0)
    return order[place], count[place], before[place], after[place], place, rank, w


def _routed(t: DataFrame, sent, complete: bool, parts: dict, longest: int, pivot_part: int) -> DataFrame:
    """(lang, part, shapes, codes, rest): for each slice of text and part its fragments, one after the other."""

    def route(batches):
        tables = sent.value
        nothing = pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for lang, texts in _slices(batches):
            pivot, count, before, after, place, rank, w = fragments(texts, tables.get(lang, nothing), complete, longest)
            if not len(place):
                continue
            salt = place % (1 + count // pivot_part)
            part = (mix(mix(pivot.astype(np.uint64)) + salt.astype(np.uint64) * K1) % np.uint64(parts[lang])).astype(np.int64)
            by = np.argsort(part, kind="stable")
            part, before, after, place = part[by], before[by], after[by], place[by]
            size = before + after + 1
            first = np.cumsum(size) - size
            spot = np.repeat(place - before - first, size) + np.arange(size.sum())
            codes = rank[spot].astype(np.int32)
            edge = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            ends = np.append(edge, len(part))
            code_ends = np.append(first, size.sum())[ends]
            other = codes == OTHER
            rest_ends = np.append(0, np.cumsum(other))[code_ends].astype(np.int32)
            blob = lambda x, e: pa.Array.from_buffers(pa.binary(), len(e) - 1, [None, pa.py_buffer(e.astype(np.int32)), pa.py_buffer(x)])
            shapes = (before * longest + after).astype(np.uint8)
            yield pa.record_batch([
                pa.array([lang] * len(edge), pa.string()), pa.array(part[edge].astype(np.int32)), blob(shapes, ends), blob(codes, code_ends * 4),
                pa.ListArray.from_arrays(pa.array(rest_ends), w.take(pa.array(spot[other])))], ["lang", "part", "shapes", "codes", "rest"])

    return t.mapInArrow(route, "lang string, part int, shapes binary, codes binary, rest array<string>")


def _ids(columns: list[np.ndarray], base: int) -> tuple[np.ndarray, np.ndarray]:
    """(first row of each distinct row, how often), comparing exactly: columns are folded into ids two at a time."""
    ids = columns[0]
    for c in columns[1:-1]:
        ids = np.unique(ids * base + c, return_inverse=True)[1]
    _, first, n = np.unique(ids * base + columns[-1], return_index=True, return_counts=True)
    return first, n


def _mined(sent, min_count: int, longest: int, pivot_part: int):
    """The phrases that the pivots of a part own, with their counts there; where a pivot is in this part alone, frequent ones only."""

    def mine(key, tab):
        lang = key[0].as_py()
        known, rank_of, count_of = sent.value.get(lang, (pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, np.int64)))
        blob = lambda c, kind: np.frombuffer(b"".join(x.as_buffer() for chunk in tab.column(c).chunks for x in chunk), kind)
        shapes, codes = blob("shapes", np.uint8), blob("codes", np.int32).astype(np.int64)
        rest, others = words.coded(pa.concat_arrays([c.flatten() for c in tab.column("rest").chunks]).cast(pa.string()))
        # from here on a word is its place in ``known``, then in ``others``
        place = np.zeros(int(rank_of.max(initial=-1)) + 1, np.int64)
        place[rank_of] = np.arange(len(rank_of))
        is_other = codes == OTHER
        codes[~is_other] = place[codes[~is_other]]
        codes[is_other] = len(known) + rest
        names = pa.concat_arrays([known, others.cast(pa.string())])
        counts = np.concatenate([count_of, np.zeros(len(others), np.int64)])
        before, after = shapes // longest, shapes % longest
        at = np.cumsum(before.astype(np.int64) + after + 1) - after - 1  # of the pivots
        out = []
        for size in range(2, longest + 1):
            found = [np.zeros((0, size + 1), np.int64)]
            for i in range(size):  # words before the pivot
                own = at[(before >= i) & (after >= size - 1 - i)]
                found.append(np.stack([codes[own - i + k] for k in range(size)] + [codes[own]], axis=1))
            rows = np.concatenate(found)
            if not len(rows):
                continue
            first, n = _ids([rows[:, k] for k in range(size)], len(names))
            # the pivot is a function of the phrase, as the order of the words is one
            left = (n >= min_count) | (counts[rows[first, size]] >= pivot_part)
            rows, n = rows[first[left]], n[left]
            phrase = pc.binary_join_element_wise(*(names.take(pa.array(rows[:, k])) for k in range(size)), " ")
            out.append(pa.table({"lang": pa.array([lang] * len(rows), pa.string()), "phrase": phrase, "size": pa.array(np.full(len(rows), size, np.int32)), "n": pa.array(n.astype(np.int64))}))
        trim()
        return pa.concat_tables(out) if out else pa.table({"lang": pa.array([], pa.string()), "phrase": pa.array([], pa.string()), "size": pa.array([], pa.int32()), "n": pa.array([], pa.int64())})

    return mine


def frequent_phrases(t: DataFrame, counts: DataFrame, min_count: int, longest: int, ranked: int = RANKED, part: int = PART, pivot_part: int = PIVOT_PART) -> DataFrame:
    """(lang, phrase, size, a) of all phrases of 2 to ``longest`` words with ``min_count`` occurrences in their language."""
    tables, complete = _ranked(counts.filter(F.col("n") >= min_count), min(ranked, RANKED))
    parts = {r["lang"]: max(1, -(-r["n"] // part)) for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    sent = t.sparkSession.sparkContext.broadcast(tables)
    routed = _routed(t, sent, complete, parts, longest, pivot_part).repartition(max(1, min(100_000, sum(parts.values()))), "lang", "part")
    found = routed.groupBy("lang", "part").applyInArrow(_mined(sent, min_count, longest, pivot_part), "lang string, phrase string, size int, n long")
    return found.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("a")).filter(F.col("a") >= min_count)


def _whole(c: str) -> Column:
    return F.col(c).cast("decimal(20,0)")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 30, longest: int = 4, first: int = 2000, ranked: int = RANKED, part: int = PART, pivot_part: int = PIVOT_PART) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): each language's ``first`` phrases by score, a, and the phrase's bytes.

    Every row counts, repeated ones and rows without id too. A null language is ``und``, a null text is empty; phrases never
    cross the end of a text or a piece. A phrase goes if a longer one that holds it has 80 % of its occurrences. A
    language without a frequent phrase has no row; an empty table gives none. Other columns are ignored, whatever their names.
    """
    ship(docs.sparkSession)
    t = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    counts = written(_word_counts(t), "phrase-words")
    found = written(frequent_phrases(t, counts, min_count, longest, ranked, part, pivot_part), "phrases")
    f = found.select("lang", "phrase", "a").unionByName(counts.filter(F.col("n") >= min_count).select("lang", F.col("word").alias("phrase"), F.col("n").alias("a")))
    left, right = (f.select("lang", F.col("phrase").alias(x), F.col("a").alias(y)) for x, y in (("head", "l"), ("tail", "r")))
    cut = lambda x, a, n: F.array_join(F.slice(x, a, n), " ")
    cuts = found.withColumn("w", F.split("phrase", " ")).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "phrase", "size", "a", "k", cut("w", F.lit(1), F.col("k")).alias("head"), cut("w", F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"))
    cuts = cuts.join(left, ["lang", "head"]).join(right, ["lang", "tail"])
    cuts = cuts.withColumn("product", F.lit(2_000_000).cast("decimal(7,0)") * _whole("a")).withColumn("parts", _whole("l") + _whole("r")).withColumn("score", F.expr("product div parts"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("s")).select("lang", "phrase", "a", "s.score", "s.l", "s.r")

    inner = found.filter("size > 2").withColumn("w", F.split("phrase", " ")).withColumn("n", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    inner = inner.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("n") + 1))).select("lang", cut("w", F.col("i"), F.col("n")).alias("phrase"), "a")
    inner = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(inner, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (F.lit(100) * _whole("longer") < F.lit(80) * _whole("a")))
    total = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    top = kept.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= first)
    return top.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
