"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact weighted-shingle check.

DataFrame functions only. Steps:

1. Texts become lower-cased words (runs of letters and digits) and hashes of their k-word shingles (k = 5; an item
   with fewer words is one shingle of all its words, and documents are cut into shingles of that size too).
2. A window has as many shingles as an item. Sliding a best window to the right until its first shingle is one of
   the item's never lowers its similarity, so only windows that begin at a shingle of some item of that size need a
   fingerprint. A bit set of the benchmark's shingles (fixed size, no false negatives) finds those starts inside the
   row; an equi-join on the shingle confirms them.
3. Each window and each item gets a 64-bit SimHash, weighted by how often a shingle occurs in it. Multi-index: the
   64 bits are cut into ``blocks`` blocks; a pair within ``radius`` = blocks * (block_radius + 1) - 1 bits agrees in
   some block up to block_radius bits, so items are indexed under every such variant and windows probe each block.
4. Pairs within the radius are verified by weighted Jaccard similarity (weights: occurrences), 0.8 or more. A window
   that many documents share is verified once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import if_small, written

#: word shingles of the benchmark up to this count are broadcast for the confirming join
BROADCAST_SHINGLES = 500_000
SHINGLE, SIMILARITY, BLOCKS, BLOCK_RADIUS = 5, 0.8, 4, 4
#: the bit set has at most 2^24 bits (2 MB) whatever the benchmark's size
MAX_BITS = 24


def held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once a row: the generator keeps Catalyst from copying it into lambdas."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingles(w: Column, k: int) -> Column:
    """Hashes of all k-word shingles in order; none if there are fewer words."""
    at = F.sequence(F.lit(0), F.size(w) - k)
    return F.when(F.size(w) < k, F.array().cast("array<bigint>")).otherwise(F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)])))


def simhash(sh: Column, planes: int) -> Column:
    """64-bit SimHash of an array of hashes: bit-sliced counters, 64 of them in each step, then a majority vote."""
    def add(acc, h):
        carry, out = h, []
        for p in range(planes):
            c = acc[f"c{p}"]
            out.append(c.bitwiseXOR(carry).alias(f"c{p}"))
            carry = c.bitwiseAND(carry)
        return F.struct(*out)

    def vote(acc):
        # bits whose count exceeds size / 2, compared from the highest plane down
        half, more, same = F.floor(F.size(sh) / 2).cast("bigint"), F.lit(0).cast("bigint"), F.lit(-1).cast("bigint")
        for p in reversed(range(planes)):
            c, bit = acc[f"c{p}"], -F.getbit(half, F.lit(p)).cast("bigint")
            more = more.bitwiseOR(same.bitwiseAND(c).bitwiseAND(F.bitwise_not(bit)))
            same = same.bitwiseAND(F.bitwise_not(c.bitwiseXOR(bit)))
        return more

    zero = F.struct(*[F.lit(0).cast("bigint").alias(f"c{p}") for p in range(planes)])
    return F.aggregate(sh, zero, add, vote)


def with_occurrences(df: DataFrame, sh: str, name: str) -> DataFrame:
    """A multiset as a set: the n-th occurrence of a hash becomes a hash of its own."""
    df = held(df, "_sorted", F.array_sort(sh))
    return held(df, name, F.transform("_sorted", lambda x, i: F.xxhash64(x, i + 1 - F.array_position(F.col("_sorted"), x)))).drop("_sorted")


def _block(fp: Column, b: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, b * width).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY, blocks: int = BLOCKS, block_radius: int = BLOCK_RADIUS) -> DataFrame:
    """One row per (document, benchmark item) whose best window has the similarity: id, item id, window_start (in
    words, from 0; the smallest among equals), window_shingles, hamming, similarity.

    Null and empty texts, on either side, match nothing. Repeated documents or items give one row per id pair.
    A null id is an id of its own. Extra columns are ignored. An empty table on either side gives none.
    """
    spark, width = docs.sparkSession, 64 // blocks
    items = held(benchmark.select(F.col(item_col).alias("item"), F.col(item_text).alias("text")), "w", words(F.col("text"))).drop("text").filter(F.size("w") > 0).distinct()
    items = items.withColumn("k", F.least(F.size("w"), F.lit(shingle)))
    shape = items.agg(F.collect_set("k").alias("ks"), F.max(F.size("w")).alias("longest"), F.sum(F.size("w")).alias("total")).first()
    empty = spark.createDataFrame([], f"{id_col} {dict(docs.dtypes)[id_col]}, {item_col} {dict(benchmark.dtypes)[item_col]}, window_start int, window_shingles int, hamming int, similarity double")
    if not shape["ks"]:
        return empty
    planes, bits = max(2, int(shape["longest"]).bit_length() + 1), min(MAX_BITS, max(12, (16 * shape["total"]).bit_length()))
    found = [_matches(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), items.filter(F.col("k") == k), k, planes, bits,
                      shape["total"], shape["longest"], similarity, blocks, block_radius, width) for k in sorted(shape["ks"])]
    best = reduce(DataFrame.unionByName, found).groupBy("id", "item").agg(F.max(F.struct("similarity", (-F.col("start")).alias("before"), "n", "hamming")).alias("b"))
    return best.select(F.col("id").alias(id_col), F.col("item").alias(item_col), (-F.col("b.before")).cast("int").alias("window_start"), F.col("b.n").cast("int").alias("window_shingles"),
                       F.col("b.hamming").cast("int").alias("hamming"), F.col("b.similarity").alias("similarity"))


def _matches(docs, items, k, planes, bits, total, longest, similarity, blocks, block_radius, width):
    spark = docs.sparkSession
    it = held(items, "sh", shingles(F.col("w"), k)).drop("w").withColumn("n", F.size("sh"))
    starts = it.select("n", F.explode("sh").alias("h")).distinct()
    it = with_occurrences(held(it, "fp", simhash(F.col("sh"), planes)), "sh", "own").drop("sh")

    # the bit set, as an array of 64-bit words
    word = lambda h: F.shiftrightunsigned(h.bitwiseAND(F.lit((1 << bits) - 1).cast("bigint")), 6).cast("int")
    low = lambda h: h.bitwiseAND(F.lit(63).cast("bigint")).cast("int")
    sparse = starts.groupBy(word(F.col("h")).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("b"))
    dense = spark.range(1 << (bits - 6)).select(F.col("id").cast("int").alias("at")).join(sparse, "at", "left").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", F.coalesce("b", F.lit(0).cast("bigint")).alias("b")))), lambda x: x["b"]).alias("set"))
    longest = F.lit(longest - k + 1)
    d = held(docs, "w", words(F.col("text"))).drop("text")
    d = held(d, "sh", shingles(F.col("w"), k)).drop("w").withColumn("set", dense.scalar())
    # positions whose shingle may be one of an item's, with the longest window from there on
    hit = F.filter(F.transform(F.col("sh"), lambda h, i: F.when(F.getbit(F.get(F.col("set"), word(h)), low(h)) == 1, i)), lambda i: i.isNotNull())
    # one window a row, cut out after the generator: a row never holds all windows of a text
    win = held(d, "hit", hit).select("id", "sh", F.explode("hit").alias("start"))
    win = win.select("id", "start", F.slice("sh", F.col("start") + 1, longest).alias("ahead"), F.get("sh", F.col("start")).alias("h"))
    win = win.join(if_small(starts, total, BROADCAST_SHINGLES), "h").select("id", "start", "n", F.slice("ahead", F.lit(1), F.col("n")).alias("sh"))
    win = written(held(win, "fp", simhash(F.col("sh"), planes)), "windows")  # used twice

    # multi-index over distinct fingerprints: the items' side holds every variant within block_radius bits
    variants = F.filter(F.sequence(F.lit(0).cast("bigint"), F.lit((1 << width) - 1).cast("bigint")), lambda v: F.bit_count(v) <= block_radius)
    index = it.select("item", "n", "fp", F.explode(F.array(*[F.struct(F.lit(b).alias("block"), _block(F.col("fp"), b, width).alias("v")) for b in range(blocks)])).alias("x"))
    index = index.repartition("item", "x").withColumn("flip", F.explode(variants)).select(F.col("n"), F.col("x.block").alias("block"), F.col("x.v").bitwiseXOR(F.col("flip")).alias("v"), F.col("fp").alias("item_fp")).distinct()
    probe = win.select("n", "fp").distinct().select("n", "fp", F.explode(F.array(*[F.struct(F.lit(b).alias("block"), _block(F.col("fp"), b, width).alias("v")) for b in range(blocks)])).alias("x"))
    hamming = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    # the index's size is underestimated (generators count as one row), hence the hint: it is never broadcast
    near = probe.select("n", "fp", "x.block", "x.v").join(index.hint("merge"), ["n", "block", "v"]).filter(hamming <= blocks * (block_radius + 1) - 1).select("n", "fp", "item_fp").distinct()

    own = it.select("item", "n", F.col("fp").alias("item_fp"), "own")
    distinct = win.select("n", "fp", "sh").distinct().withColumn("theirs", F.col("sh"))
    pair = with_occurrences(distinct.join(near.join(own, ["n", "item_fp"]), ["n", "fp"]), "theirs", "theirs_own")
    pair = held(pair, "both", F.size(F.array_intersect("theirs_own", "own"))).withColumn("similarity", F.col("both") / (F.size("theirs_own") + F.size("own") - F.col("both")))
    sure = written(pair.filter(F.col("similarity") >= similarity).select("n", "fp", "sh", "item", hamming.alias("hamming"), "similarity"), "contaminated-windows")
    return win.join(sure, ["n", "fp", "sh"]).select("id", "item", F.col("start").cast("long").alias("start"), "n", "hamming", "similarity")
