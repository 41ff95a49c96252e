"""One row out of several: keep-first, votes, merges, upserts; aggregations instead of windows where order allows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str | Column], order: list[str]) -> DataFrame:
    """The first row of each key by ``order``: a partial aggregation, so a hot key never sits in one sort."""
    cols = df.columns
    best = F.min_by(F.struct(*cols), F.struct(*order)).alias("_r")
    return df.groupBy(*keys).agg(best).select("_r.*")


def majority_collapse(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Votes: per key the most frequent non-null value (ties: the smallest), its votes, all votes, whether disputed."""
    votes = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return votes.groupBy(*keys).agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v"))).alias("_b"), F.sum("_n").alias("n_rows"), (F.count(F.lit(1)) > 1).alias("disputed")) \
        .select(*keys, F.col("_b.v").alias("winner"), (-F.col("_b.n")).alias("votes"), "n_rows", "disputed")


def plurality(df: DataFrame, keys: list[str], label: str, share: float, least: int = 2) -> DataFrame:
    """Per key the most frequent label if it has ``share`` of the rows and ``least`` rows (or is alone), else null."""
    n = df.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("_n"))
    g = n.groupBy(*keys).agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col(label).alias("v"))).alias("_b"), F.sum("_n").alias("_all"))
    top = -F.col("_b.n")
    ok = (top >= share * F.col("_all")) & ((top >= least) | (F.col("_all") == 1))
    return g.select(*keys, F.when(ok, F.col("_b.v")).alias("label"), top.alias("n_top"), F.col("_all").alias("n_rows"))


def merge_split_entities(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """Rows that share a key are summed; the other columns come from the first of them. Single rows stay as they are."""
    rest = [c for c in df.columns if c not in (*keys, value)]
    g = df.groupBy(*keys).agg(F.sum(value).alias(value), F.min_by(F.struct(*rest), F.col(order)).alias("_r"), F.count(F.lit(1)).alias("n_merged"))
    return g.select(*keys, value, *[F.col(f"_r.{c}") for c in rest], "n_merged")


def upsert(old: DataFrame, new: DataFrame, key: str, rejected: DataFrame | None = None) -> DataFrame:
    """old and new by key, new wins; rejected keys leave both."""
    out = old.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)
    return out if rejected is None else out.join(rejected.select(key), key, "left_anti")


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order`` (nulls first)."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("_r")).select("_r.*")


def distinct_apply(df: DataFrame, col: str, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Derives columns once per distinct value of ``col`` and joins them back; for functions dearer than a join."""
    derived = fn(df.select(col).distinct())
    return df.join(derived, col, "left")


def ranked(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """Top n rows per key."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= n)
