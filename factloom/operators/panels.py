"""From facts to panels: labels of stacked blocks, redundancy and trust, collapsing votes to one row a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.operators.names import unused
from factloom.operators.order import blocks_closed_by
from factloom.operators.quality import null_safe


def label_blocks(df: DataFrame, keys: list[str], order: list[str], code: str, total: Column, inferred: Column, share: float = 0.8, least: int = 2, majority: int = 4) -> DataFrame:
    """Stacked blocks, each closed by a total row, take the code that most of their placed rows have.

    Adds ``block``, ``block_code`` (null unless a code has ``share`` of the placed rows that are no totals, and ``least``
    rows of them or the block has a single row), ``placed`` and ``changed``. Rows without a code, totals too, take the
    block's; an inferred code that differs gives way to a majority of ``majority`` rows; a printed code stays.
    """
    is_total, rows = unused([*df.columns, "block", "block_code", "placed", "changed"], "is_total_row", "block_rows")
    b = blocks_closed_by(df.withColumn(is_total, F.coalesce(total, F.lit(False))), keys, order, F.col(is_total), "block")
    n = b.filter(~F.col(is_total)).groupBy(*keys, "block", F.col(code).alias("code")).agg(F.count(F.lit(1)).alias("n"))
    g = n.groupBy(*keys, "block").agg(F.min(F.when(F.col("code").isNotNull(), F.struct((-F.col("n")).alias("n"), F.col("code").alias("v")))).alias("top"), F.sum(F.when(F.col("code").isNotNull(), F.col("n"))).alias("placed_rows"), F.sum("n").alias("rows"))
    won = -F.col("top.n")
    ok = (won >= share * F.col("placed_rows")) & ((won >= least) | (F.col("rows") == 1))
    g = g.select(*keys, "block", F.when(ok, F.col("top.v")).alias("block_code"), F.when(ok, won).alias(rows))
    out = null_safe(b, g, [*keys, "block"])
    takes = F.col("block_code").isNotNull() & (F.col(code).isNull() | (F.coalesce(inferred, F.lit(False)) & (F.col(code) != F.col("block_code")) & (F.col(rows) >= majority)))
    return out.withColumn("placed", F.when(takes, F.col("block_code")).otherwise(F.col(code))).withColumn("changed", takes).drop(is_total, rows)


def redundancy(df: DataFrame, keys: list[str], value: str, trusted: Column, prefer: list) -> DataFrame:
    """One row per key, trust and value (the first by ``prefer``), with ``trusted``, ``n_sources`` (rows of the key) and
    ``conflict`` (whether the key has several values). Both sides of the trust are kept: see ``sinks.write_split``."""
    t = df.withColumn("trusted", F.coalesce(trusted, F.lit(False)))
    one = t.groupBy(*keys, "trusted", value).agg(F.min_by(F.struct(*[c for c in df.columns if c not in (*keys, value)]), F.struct(*prefer)).alias("r"), F.count(F.lit(1)).alias("n"))
    g = one.groupBy(*keys, "trusted").agg(F.sum("n").alias("n_sources"), (F.count(value) > 1).alias("conflict"))
    return null_safe(one.drop("n"), g, [*keys, "trusted"]).select(*keys, "trusted", value, "r.*", "n_sources", "conflict")


def collapse(df: DataFrame, keys: list[str], value: str, priority: str, capture: str, order: str, checked: Column) -> DataFrame:
    """Votes: per key the value of most rows, then of the best priority, then the smallest; all columns of the row that
    carries it (best priority, latest capture with nulls last, then ``order``), ``votes``, ``checked`` (whether a checked
    row has that value) and ``disputed`` (whether another value was seen)."""
    rest = [c for c in df.columns if c not in (*keys, value)]
    best = F.max_by(F.struct(*rest), F.struct(-F.col(priority), F.col(capture), -F.col(order)))
    v = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("votes"), F.min(priority).alias("p"), F.bool_or(F.coalesce(checked, F.lit(False))).alias("checked"), best.alias("row"))
    win = v.groupBy(*keys).agg(F.min(F.struct((-F.col("votes")).alias("v"), "p", value, "votes", "checked", "row")).alias("w"), (F.count(F.lit(1)) > 1).alias("disputed"))
    return win.select(*keys, F.col(f"w.{value}").alias(value), "w.row.*", "w.votes", "w.checked", "disputed")
