"""Mentions of names in running text, and the place that a headline is about."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.text import normal_name
from factloom.operators import places
from factloom.operators.names import unused
from factloom.session import ship

#: names up to this count are looked up where the texts lie, more are joined; bytes of text that a task holds as arrays at once
HELD, GROUP = 100_000, 1 << 20
_NAMES = pa.schema([("name", pa.string()), ("kind", pa.string()), ("state", pa.string()), ("weak", pa.bool_())])


def names_table(states: DataFrame, gazetteer: DataFrame, aliases: DataFrame, generic: list[str], given: list[str], small: int = 100_000) -> DataFrame:
    """(name, kind, state, weak) for ``mentions`` from states (alias, code), gazetteer (name, state, population, kind) and aliases (alias, name).

    A name of a state is no place. A place of one word is weak if it is a given name, too, or no district and smaller than
    ``small`` in every state. Generic words are no names.
    """
    p = gazetteer.groupBy("name").agg(F.max("population").alias("most"), F.bool_or(F.col("kind") == "district").alias("district"))
    p = p.unionByName(aliases.join(p, "name").select(F.col("alias").alias("name"), "most", "district")).groupBy("name").agg(F.max("most").alias("most"), F.bool_or("district").alias("district"))
    s = states.groupBy(normal_name(F.col("alias")).alias("name")).agg(F.min("code").alias("state"))
    weak = ~F.col("name").contains(" ") & (F.col("name").isin(given) | ((F.col("most") < small) & ~F.col("district")))
    p = p.filter(~F.col("name").isin(generic)).join(s, "name", "left_anti").select("name", F.lit("place").alias("kind"), F.lit(None).cast("string").alias("state"), weak.alias("weak"))
    return s.select("name", F.lit("state").alias("kind"), "state", F.lit(False).alias("weak")).unionByName(p)


def _tokens(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, loose, i, word, gap, start): words of ASCII letters with the gap before each and where each begins."""
    word, c = "[A-Za-z]+", F.col(text)
    loose = (c == F.lower(c)) | ((c == F.upper(c)) & (c != F.lower(c)))
    words = F.regexp_extract_all(c, F.lit(f"({word})"), 1)
    # texts are dealt by their keys before they fall into words: the windows over words then need no shuffle
    t = texts.filter(c.isNotNull()).repartition(*keys).select(*keys, loose.alias("loose"), F.posexplode(F.arrays_zip(words.alias("word"), F.slice(F.split(c, word, -1), 1, F.size(words)).alias("gap"))).alias("i", "x"))
    t = t.select(*keys, "loose", "i", "x.word", "x.gap")
    upto = Window.partitionBy(*keys).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    return t.withColumn("start", F.sum(F.length("gap") + F.length("word")).over(upto) - F.length("word"))


def _letters(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, text) of the words of ASCII letters in ``data`` by byte; texts end at ``offs``."""
    letter = ((data | 32) - 97).astype(np.uint8) < 26
    first = np.zeros(len(data) + 1, bool)
    first[offs] = True
    begin = np.flatnonzero(letter & (~np.concatenate([[False], letter[:-1]]) | first[:-1]))
    end = np.flatnonzero(letter & (~np.concatenate([letter[1:], [False]]) | first[1:])) + 1
    return begin, end, np.searchsorted(offs, begin, "right") - 1


def _hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, most: int) -> np.ndarray:
    """64-bit hashes of words in lower case; of words with more than ``most`` letters only these count."""
    h = np.minimum(end - begin, most + 1).astype(np.uint64)
    low, own = (data | 32).astype(np.uint64), np.arange(len(begin))
    for k in range(most):
        own = own[begin[own] + k < end[own]]
        if not len(own):
            break
        x = (h[own] + low[begin[own] + k]) * np.uint64(0x9E3779B97F4A7C15)
        h[own] = x ^ (x >> np.uint64(29))
    return h


def _grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` words with the hashes ``h``, by the first word."""
    g = h[: max(0, len(h) - n + 1)].copy()
    for k in range(1, n):
        g = (g ^ (g >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + h[k : len(h) - n + 1 + k]
    return g ^ (g >> np.uint64(32))


def _cut(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """The bytes data[begin:end] as strings."""
    n = end - begin
    offs = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(int(offs[-1])) + np.repeat(begin - offs[:-1], n)
    return pa.LargeStringArray.from_buffers(len(n), pa.py_buffer(offs.astype(np.int64)), pa.py_buffer(data[at])).cast(pa.string())


class _Names:
    """Names by the hashes of their words. ``table``: name (words of a-z parted by one space) and what comes with it."""

    def __init__(self, table: pa.Table, longest: int):
        self.table = table = table.combine_chunks()
        data, offs = _utf8(table.column("name"))
        begin, end, text = _letters(data, offs)
        self.most = int((end - begin).max(initial=0))
        h, n = _hashes(data, begin, end, self.most), np.bincount(text, minlength=len(table))
        at = np.cumsum(n) - n
        self.by_n = []
        for k in range(1, longest + 1):
            own = np.flatnonzero(n == k)
            g = _grams(h, k)[at[own]]
            order = np.argsort(g)
            g, own = g[order], own[order]
            bits = np.zeros(1 << 20, bool)
            bits[g >> np.uint64(44)] = True
            self.by_n.append((g, own, bits))

    def find(self, g: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(places in ``g``, rows of the table with that hash), a place again for each further name of one hash."""
        known, own, bits = self.by_n[n - 1]
        at = np.flatnonzero(bits[g >> np.uint64(44)])
        low, high = np.searchsorted(known, g[at]), np.searchsorted(known, g[at], "right")
        n = high - low
        return np.repeat(at, n), own[np.arange(int(n.sum())) + np.repeat(low - np.cumsum(n) + n, n)]


def _utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of strings; a null is empty."""
    arr = arr.combine_chunks() if isinstance(arr, pa.ChunkedArray) else arr
    arr = pc.fill_null(arr.cast(pa.large_string()), "")
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = arr.buffers()
    offs = np.frombuffer(offs, np.int64)[arr.offset : arr.offset + len(arr) + 1]
    return (np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if offs[-1] > offs[0] else np.zeros(0, np.uint8)), offs - offs[0]


def _scan(data: np.ndarray, offs: np.ndarray, loose: np.ndarray, names: _Names, longest: int) -> tuple[np.ndarray, ...]:
    """(text, first byte, byte behind, row of the names) of the mentions in texts: longest first, left to right, without overlaps."""
    begin, end, text = _letters(data, offs)
    h = _hashes(data, begin, end, names.most)
    capital = loose[text] | (data[begin] < 97)
    best, size = np.full(len(begin), -1), np.zeros(len(begin), np.int64)
    for n in range(1, longest + 1):
        at, row = names.find(_grams(h, n), n)
        ok = text[at] == text[at + n - 1]
        for k in range(n):
            ok &= capital[at + k]
        at, row = at[ok], row[ok]
        # the hash says where to look, the words themselves decide
        low, first, last = data | 32, begin[at], end[at + n - 1]
        if n > 1:
            words = [_cut(low, begin[at + k], end[at + k]) for k in range(n)]
            said = pc.binary_join_element_wise(*words, " ")
        else:
            said = _cut(low, first, last)
        same = pc.equal(said, names.table.column("name").take(pa.array(row)).combine_chunks()).to_numpy(zero_copy_only=False) if len(at) else np.zeros(0, bool)
        best[at[same]], size[at[same]] = row[same], n
    hits = np.flatnonzero(size)
    free = hits + size[hits]
    reach = np.maximum.accumulate(free) if len(hits) else free
    opens = np.concatenate([[True], hits[1:] >= reach[:-1]]) if len(hits) else np.zeros(0, bool)
    taken = opens.copy()
    # a match that touches earlier ones: one by one within its island
    after, until = np.flatnonzero(~opens).tolist(), -1
    for x in after:
        if opens[x - 1]:
            until = free[x - 1]
        if hits[x] >= until:
            taken[x], until = True, free[x]
    hits = hits[taken]
    return text[hits], begin[hits], end[hits + size[hits] - 1], best[hits]


def _looked_up(texts: DataFrame, keys: list[str], text: str, names: pa.Table, longest: int) -> DataFrame:
    """The mentions of names that every task holds; texts are dealt by their keys and stay whole."""
    spark, c = texts.sparkSession, F.col(text)
    ship(spark)
    held, more = spark.sparkContext.broadcast(names), names.column_names[1:]
    all_loose, body, found_in, i_in, m_in = unused(keys, "loose", "text", "found", "i", "m")

    def work(batches):
        index = _Names(held.value, longest)
        for b in batches:
            _, all_offs = _utf8(b.column(body))
            i = 0
            while i < b.num_rows:
                j = max(i + 1, int(np.searchsorted(all_offs, all_offs[i] + GROUP, "right")) - 1)
                part = b.slice(i, j - i)
                data, offs = _utf8(part.column(body))
                at, first, last, row = _scan(data, offs, np.asarray(part.column(all_loose).fill_null(False)), index, longest)
                # places count letters, not bytes
                letters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                base = letters[offs[at]]
                with_them = [index.table.column(x).take(pa.array(row)).combine_chunks() for x in more]
                found = pa.StructArray.from_arrays([pa.array((letters[first] - base).astype(np.int32)), pa.array((letters[last] - base).astype(np.int32)), _cut(data, first, last), *with_them], names=["start", "end", "mention", *more])
                ends = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=j - i))]).astype(np.int32)
                yield pa.record_batch([*[part.column(k) for k in keys], pa.ListArray.from_arrays(pa.array(ends), found)], [*keys, found_in])
                i = j

    loose = (c == F.lower(c)) | ((c == F.upper(c)) & (c != F.lower(c)))
    t = texts.filter(c.isNotNull()).repartition(*keys).select(*keys, loose.alias(all_loose), c.alias(body))
    types = dict(texts.dtypes)
    out = ", ".join([*[f"`{k}` {types[k]}" for k in keys], f"`{found_in}` array<struct<start: int, end: int, mention: string, kind: string, state: string, weak: boolean>>"])
    return t.mapInArrow(work, out).select(*keys, F.posexplode(found_in).alias(i_in, m_in)).select(*keys, f"{m_in}.*")


def mentions(texts: DataFrame, keys: list[str], text: str, names: DataFrame, abbreviations: dict[str, str] | None = None, longest: int = 4, held: int = HELD) -> DataFrame:
    """(keys, start, end, mention, kind, state, weak) of the names (name, kind, state, weak) that each text mentions.

    Names are looked up word by word, left to right, the longest first, without overlaps; all their words must be capitalised
    unless the whole text is in one case. ``abbreviations`` are looked up as written, as "A" or "A&B", beside the names.
    ``names`` is a table of any size with one row a name, in lower case, words parted by one space. ``keys`` tell texts
    apart. Up to ``held`` names are in every task, which scans whole texts; more are joined on n-grams, where overlaps are
    settled within islands of matches that touch, never over a whole text. A null or empty text has none.
    """
    names = names.select("name", "kind", "state", "weak")
    known = names.filter(F.col("name").rlike("^[a-z]+( [a-z]+)*$")).limit(held + 1).toArrow().cast(_NAMES)
    if len(known) <= held:
        m = _looked_up(texts, keys, text, known, longest)
        return m.unionByName(_abbreviated(_words(texts, keys, text, longest), keys, abbreviations)) if abbreviations else m
    t = _words(texts, keys, text, longest)
    m = _joined(t, keys, names, longest)
    return m.unionByName(_abbreviated(t, keys, abbreviations)) if abbreviations else m


def _words(texts: DataFrame, keys: list[str], text: str, longest: int) -> DataFrame:
    """The words of texts with the n-grams and the pair that each begins."""
    t = _tokens(texts, keys, text)
    w = Window.partitionBy(*keys).orderBy("i")
    ahead = lambda c, k: F.lead(c, k).over(w) if k else F.col(c)
    t = t.withColumn("capital", F.col("word").rlike("^[A-Z]"))
    grams, raw, low, capital = [], None, None, None
    for k in range(longest):
        word = ahead("word", k)
        raw = word if raw is None else F.concat(raw, ahead("gap", k), word)
        low = F.lower(word) if low is None else F.concat_ws(" ", low, F.lower(word))
        capital = ahead("capital", k) if capital is None else capital & ahead("capital", k)
        ok = word.isNotNull() & (F.col("loose") | capital)
        grams.append((F.when(ok, low).alias(f"name{k}"), F.when(ok, raw).alias(f"mention{k}")))
    after = F.coalesce(ahead("gap", 1), F.lit(""))
    edges = (~F.col("gap").rlike("[0-9_]$"), ~after.rlike("^[0-9_]"))
    pair = F.when(ahead("gap", 1).rlike("^ ?& ?$"), F.concat("word", F.lit("&"), ahead("word", 1)))
    return t.select(*keys, "i", "start", *[c for gram in grams for c in gram], "word", F.concat("word", after, ahead("word", 1)).alias("two"), pair.alias("pair"), edges[0].alias("open"), edges[1].alias("shut"))


def _joined(t: DataFrame, keys: list[str], names: DataFrame, longest: int) -> DataFrame:
    """The mentions in the words ``t`` by a join of their n-grams with the names."""
    w = Window.partitionBy(*keys).orderBy("i")
    rows = F.stack(F.lit(longest), *[c for k in range(longest) for c in (F.lit(k + 1), F.col(f"name{k}"), F.col(f"mention{k}"))]).alias("n", "name", "mention")
    m = t.select(*keys, "i", "start", rows).join(names, "name")
    m = m.groupBy(*keys, "i").agg(F.max_by(F.struct("n", "start", (F.col("start") + F.length("mention")).alias("end"), "mention", "kind", "state", "weak"), "n").alias("m")).select(*keys, "i", "m.*")
    before = F.max(F.col("i") + F.col("n")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    m = m.withColumn("opens", F.coalesce(F.col("i") >= before, F.lit(True)).cast("int")).withColumn("island", F.sum("opens").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = ["start", "end", "mention", "kind", "state", "weak"]
    m = m.groupBy(*keys, "island").agg(F.array_sort(F.collect_list(F.struct("i", "n", *out))).alias("all"))
    step = lambda acc, x: F.when(x["i"] >= acc["free"], F.struct((x["i"] + x["n"]).alias("free"), F.array_append(acc["taken"], x).alias("taken"))).otherwise(acc)
    return m.select(*keys, F.inline(F.aggregate("all", F.struct(F.lit(0).alias("free"), F.filter("all", lambda x: F.lit(False)).alias("taken")), step)["taken"])).select(*keys, *out)


def _abbreviated(t: DataFrame, keys: list[str], abbreviations: dict[str, str]) -> DataFrame:
    """The mentions of ``abbreviations`` in the words ``t``, as written."""
    codes = F.create_map(*[F.lit(x) for kv in abbreviations.items() for x in kv])
    one = F.struct(F.col("word").alias("mention"), F.try_element_at(codes, F.col("word")).alias("state"))
    two = F.struct(F.col("two").alias("mention"), F.try_element_at(codes, F.coalesce("pair", F.lit(""))).alias("state"))
    a = t.select(*keys, "start", "open", F.explode(F.array(F.when(F.col("shut"), one), F.when(F.col("pair").isNotNull(), two))).alias("x")).filter("open and x.state is not null")
    return a.select(*keys, "start", (F.col("start") + F.length("x.mention")).alias("end"), "x.mention", F.lit("state").alias("kind"), "x.state", F.lit(False).alias("weak"))


def _votes(found: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, top, top_n, votes): how often a text names each state."""
    n = found.filter("kind = 'state'").groupBy(*keys, "state").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("n"), "state")).alias("t"), F.sum("n").alias("votes")).select(*keys, F.col("t.state").alias("top"), (-F.col("t.n")).alias("top_n"), "votes")


def _resolved(named: DataFrame, found: DataFrame, votes: DataFrame, keys: list[str]) -> DataFrame:
    """``named`` (keys, name) with ``place_state`` and ``kinds`` (state -> kind), by candidates and the states of the same text."""
    t = named.join(places.gathered(found), "name", "left").join(votes, keys, "left")
    strong = F.when(F.col("top_n") >= 0.8 * F.col("votes"), F.col("top"))
    return t.withColumn("place_state", places.pick(strong, F.lit(False), veto=False))


def feed_states(feeds: DataFrame, states: DataFrame, candidates, generic: list[str], longest: int = 3) -> DataFrame:
    """(feed, feed_state) for the feeds (feed, a url) whose path names a state or a place of one state: longer spans of its words first.

    ``candidates`` maps names (name) to (name, state, population, kind).
    """
    path = F.lower(F.regexp_extract("feed", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1))
    f = feeds.select("feed").filter("feed is not null").distinct().withColumn("w", F.filter(F.regexp_extract_all(path, F.lit("([a-z]+)"), 1), lambda x: ~x.isin(generic)))
    spans = lambda w, n, out: F.explode(F.transform(F.filter(F.sequence(F.lit(1), F.greatest(F.size(w), F.lit(1))), lambda i: i + n - 1 <= F.size(w)), lambda i: F.struct(i.alias("k"), F.slice(w, i, n).alias("s")))).alias(out)
    f = reduce(DataFrame.unionByName, [f.select("feed", F.lit(-n).alias("n"), spans(F.col("w"), n, "x")).select("feed", "n", "x.k", F.col("x.s").alias("w")) for n in range(1, longest + 1)])
    inner = reduce(DataFrame.unionByName, [f.select("feed", "n", "k", F.lit(-m).alias("m"), spans(F.col("w"), m, "x")).select("feed", "n", "k", "m", F.col("x.k").alias("j"), F.array_join("x.s", " ").alias("name")) for m in range(1, longest + 1)])
    s = states.groupBy(normal_name(F.col("alias")).alias("name")).agg(F.min("code").alias("state"))
    by_state = inner.join(s, "name").groupBy("feed", "n", "k").agg(F.min_by("state", F.struct("j", "m")).alias("named"))
    f = f.withColumn("name", F.array_join("w", " "))
    t = f.join(places.gathered(candidates(f.select("name"))), "name", "left").join(by_state, ["feed", "n", "k"], "left")
    t = t.withColumn("state", F.coalesce("named", places.pick(F.lit(None).cast("string"), F.lit(False), veto=False))).filter("state is not null")
    return t.groupBy("feed").agg(F.min_by("state", F.struct("n", "k")).alias("feed_state"))


def locate(titles: DataFrame, keys: list[str], title: str, found: DataFrame, states: DataFrame, candidates, feed: str | None = None, generic: list[str] | None = None, near: int = 40) -> DataFrame:
    """(keys, state, place, district, basis): the place that each headline is about.

    ``found``: its mentions. A dateline (a name before ``near`` characters that a colon follows) goes first, then names after
    "in", "at", "near", "outside" or "inside", then the others, each in reading order; the first that says a state wins. A weak
    name counts only in the first two ways. A place of several states takes the one that the headline names, else the
    biggest, if its size says so. Without any, the state that the feed's url is about, basis ``feed``; else nulls.
    """
    m = found.join(titles.select(*keys, F.col(title).alias("title_text")), keys)
    dateline = F.expr("substring(title_text, end + 1)").rlike(r"^\s*:") & (F.col("start") < near)
    led = F.expr("substring(title_text, 1, start)").rlike(r"(?i)(?:^|\s)(?:in|at|near|outside|inside)\s*$")
    m = m.withColumn("rank", F.struct(F.when(dateline, 0).when(led, 1).otherwise(2).alias("way"), "start")).drop("title_text").withColumn("name", F.col("mention"))
    m = m.filter((F.col("kind") == "state") | ~F.col("weak") | (F.col("rank.way") < 2))
    m = _resolved(m, candidates(m.filter("kind = 'place'").select("name").distinct()), _votes(found, keys), keys)
    said = F.when(F.col("kind") == "state", F.col("state")).otherwise(F.col("place_state"))
    place = F.when(F.col("kind") == "place", F.col("mention"))
    district = F.when(F.exists("c", lambda x: (x["s"] == said) & (x["kind"] == "district")), place)
    best = m.filter(said.isNotNull()).groupBy(*keys).agg(F.min_by(F.struct(said.alias("state"), place.alias("place"), district.alias("district")), "rank").alias("best"))
    t = titles.join(best, keys, "left")
    if feed is None:
        fallback = F.lit(None).cast("string")
    else:
        by_feed = feed_states(titles.select(F.col(feed).alias("feed")), states, candidates, generic or [])
        t, fallback = t.join(by_feed.withColumnRenamed("feed", "feed_url"), F.col(feed) == F.col("feed_url"), "left"), F.col("feed_state")
    basis = F.when(F.col("best").isNotNull(), "headline").when(fallback.isNotNull(), "feed")
    return t.select(*keys, F.coalesce("best.state", fallback).alias("state"), "best.place", "best.district", basis.alias("basis"))
