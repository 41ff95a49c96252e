"""Resolving names: canonical lists, fuzzy matching of the misses, phrases, places, suffixes, evidence."""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.text import normal_name
from factloom.operators.names import unused
from factloom.operators.reconcile import distinct_apply
from factloom.session import ship


def canonical(df: DataFrame, col: str, lookup: DataFrame, name: str = "code") -> DataFrame:
    """Exact look-up of the normalised name in (alias, code); unknown names stay null."""
    n, = unused(df.columns, "_n")
    names = lookup.select(normal_name(F.col("alias")).alias(n), F.col("code").alias(name)).groupBy(n).agg(F.min(name).alias(name))
    return df.withColumn(n, normal_name(F.col(col))).join(names, n, "left").drop(n)


def fuzzy(df: DataFrame, col: str, lookup: list[tuple[str, str]], cutoff: float = 0.88, name: str = "code") -> DataFrame:
    """Exact, else the closest name of ``lookup`` (name, code; a closed list) with a Ratcliff-Obershelp ratio of ``cutoff`` or more.

    The ratio is computed once per distinct name.
    """
    ship(df.sparkSession)
    codes = {k: v for k, v in lookup}

    @F.pandas_udf("string")
    def closest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda x: None if x is None else codes.get(x) or next((codes[m] for m in difflib.get_close_matches(x, list(codes), 1, cutoff)), None))

    n, = unused(df.columns, "_n")
    return distinct_apply(df.withColumn(n, normal_name(F.col(col))), n, lambda d: d.withColumn(name, closest(n))).drop(n)


def phrases(words: Column, vocabulary: list[str], longest: int = 4) -> Column:
    """Phrases of a closed list found in an array of words: left to right, the longest first, not overlapping.

    A phrase is looked up by ``isin``, which the optimiser turns into a hash set for all but the shortest lists.
    """
    gram = lambda i, n: F.array_join(F.slice(words, i + 1, n), " ")

    def step(acc, i):
        hit, size = F.lit(None).cast("string"), F.lit(0)
        for n in range(1, longest + 1):
            ok = (i + n <= F.size(words)) & gram(i, n).isin(vocabulary)
            hit, size = F.when(ok, gram(i, n)).otherwise(hit), F.when(ok, n).otherwise(size)
        return F.when(i < acc["skip"], acc).otherwise(F.struct((i + F.greatest(size, F.lit(1))).alias("skip"), F.when(hit.isNull(), acc["found"]).otherwise(F.array_append(acc["found"], hit)).alias("found")))

    start = F.struct(F.lit(0).alias("skip"), F.array().cast("array<string>").alias("found"))
    return F.when(F.size(words) > 0, F.aggregate(F.sequence(F.lit(0), F.size(words) - 1), start, step)["found"]).otherwise(F.array().cast("array<string>"))


def disambiguate(names: DataFrame, candidates: DataFrame, votes: DataFrame, min_votes: int = 5, top_share: float = 0.8, factor: float = 3.0) -> DataFrame:
    """One state per name of ``names`` (name).

    ``candidates``: (name, state, population); ``votes``: (name, state, n). The evidence is strong with ``min_votes``
    votes of which ``top_share`` agree. One candidate: kept unless strong evidence names another. Several: the strong
    top if it is among them, else the biggest if it has ``factor`` times the next one's population, else null.
    """
    c = candidates.groupBy("name").agg(F.array_sort(F.collect_list(F.struct((-F.col("population")).alias("p"), F.col("state").alias("s")))).alias("c"))
    v = votes.groupBy("name").agg(F.min(F.struct((-F.col("n")).alias("n"), F.col("state").alias("s"))).alias("t"), F.sum("n").alias("all"))
    t = names.join(c, "name", "left").join(v, "name", "left")
    top = F.when((F.col("all") >= min_votes) & (-F.col("t.n") >= top_share * F.col("all")), F.col("t.s"))
    t = t.withColumn("_top", top)
    one = F.when(F.col("_top").isNull() | (F.col("_top") == F.get("c", F.lit(0))["s"]), F.get("c", F.lit(0))["s"])
    big = F.when(-F.get("c", F.lit(0))["p"] >= factor * F.greatest(-F.get("c", F.lit(1))["p"], F.lit(1)), F.get("c", F.lit(0))["s"])
    several = F.when(F.exists("c", lambda x: x["s"] == F.col("_top")), F.col("_top")).otherwise(big)
    return t.select("name", F.coalesce(F.size("c"), F.lit(0)).alias("n_candidates"), F.when(F.size("c") == 1, one).when(F.size("c") > 1, several).alias("state"))


def weighted_votes(sources: list[tuple[DataFrame, int]], keys: list[str], label: str) -> DataFrame:
    """Evidence of several sources, each row worth its source's weight: the winner per key (ties: the smallest)."""
    union = None
    for df, weight in sources:
        d = df.select(*keys, label, F.lit(weight).alias("_w"))
        union = d if union is None else union.unionByName(d)
    n = union.filter(F.col(label).isNotNull()).groupBy(*keys, label).agg(F.sum("_w").alias("_n"))
    return n.groupBy(*keys).agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col(label).alias("v"))).alias("_b"), F.sum("_n").alias("votes")) \
        .select(*keys, F.col("_b.v").alias("winner"), (-F.col("_b.n")).alias("winner_votes"), "votes")


def suffix_join(df: DataFrame, host: str, registry: DataFrame, keep: str) -> DataFrame:
    """Hosts against registered suffixes (suffix, publisher, priority): host equal or a subdomain; the first hit by priority.

    Only the distinct hosts are expanded; without a hit the publisher is the host itself.
    """
    hosts = df.select(host).filter(F.col(host).isNotNull()).distinct()
    labels = F.split(host, r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    hit = hosts.withColumn("suffix", F.explode(suffix)).join(registry, "suffix").groupBy(host).agg(F.min_by(keep, "priority").alias(keep))
    return df.join(hit, host, "left").withColumn(keep, F.coalesce(keep, F.col(host)))


def merge_gazetteer(entries: DataFrame) -> DataFrame:
    """(name, state, kind, population, flag) to one row per name and state: the town's figure, else the district's; any flag."""
    g = entries.groupBy("name", "state").agg(F.max(F.when(F.col("kind") == "town", F.col("population"))).alias("t"), F.max(F.when(F.col("kind") == "district", F.col("population"))).alias("d"), F.bool_or("flag").alias("flag"))
    return g.select("name", "state", F.coalesce(F.nullif("t", F.lit(0)), F.col("d")).alias("population"), "flag")


def range_join(points: DataFrame, point: str, ranges: DataFrame, low: str, high: str, width: int, keys: list[str] | None = None) -> DataFrame:
    """Points with the ranges (bounds included) that contain them, left join: both sides meet in buckets of ``width``."""
    keys = keys or []
    b, = unused([*points.columns, *ranges.columns], "_b")
    r = ranges.withColumn(b, F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))))
    p = points.withColumn(b, F.floor(F.col(point) / width))
    on = [p[k].eqNullSafe(r[k]) for k in keys] + [p[b] == r[b], p[point].between(r[low], r[high])]
    return p.join(r, on, "left").drop(r[b], *[r[k] for k in keys]).drop(b)
