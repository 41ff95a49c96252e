"""Reconciling totals with parts, flagging conflicts, guarding publication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe(a: DataFrame, b: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """A join on ``keys`` where null equals null; b's keys do not appear again."""
    b = b.select([F.col(k).alias(f"_k_{k}") if k in keys else F.col(k) for k in b.columns])
    on = reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[f"_k_{k}"]) for k in keys])
    return a.join(b, on, how).drop(*[f"_k_{k}" for k in keys])


def _status(total: Column, parts: Column, good: str, rel: float, absolute: float) -> Column:
    close = F.abs(total - parts) <= rel * F.abs(total) + absolute
    return F.when(total.isNull() | parts.isNull(), "unchecked").when(close, good).otherwise("sum_mismatch")


def sum_check(df: DataFrame, keys: list[str], value: str, order: str, total: Column, part: Column, rel: float = 0.005, absolute: float = 1.0, name: str = "qc") -> DataFrame:
    """Each row with its key's status: the first total against the sum of the parts; absent sides are unchecked."""
    g = df.groupBy(*keys).agg(F.min_by(F.when(total, F.col(value)), F.when(total & F.col(value).isNotNull(), F.col(order))).alias("_t"), F.sum(F.when(part, F.col(value))).alias("_p"))
    return null_safe(df, g.select(*keys, _status(F.col("_t"), F.col("_p"), "sum_ok", rel, absolute).alias(name)), keys)


def block_check(df: DataFrame, keys: list[str], value: str, total: Column, part: Column, rel: float = 0.005, absolute: float = 1.0, name: str = "qc") -> DataFrame:
    """As sum_check, but a key is only checked if it has exactly one total."""
    g = df.groupBy(*keys).agg(F.sum(F.when(total, F.col(value))).alias("_t"), F.count(F.when(total, 1)).alias("_n"), F.sum(F.when(part, F.col(value))).alias("_p"))
    status = _status(F.when(F.col("_n") == 1, F.col("_t")), F.col("_p"), "block_ok", rel, absolute)
    return null_safe(df, g.select(*keys, status.alias(name)), keys)


def conflict_flags(df: DataFrame, keys: list[str], value: str, source: str) -> DataFrame:
    """One row per key: rows, distinct sources, and whether its values disagree."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(source).alias("n_sources"), (F.min(value) != F.max(value)).alias("conflict"))


def shrink_guard(previous: dict[str, int], current: dict[str, int], keep: float = 0.9) -> list[str]:
    """Names of tables that lost more than the allowed share of their rows, or vanished."""
    return sorted(k for k, n in previous.items() if current.get(k, 0) < keep * n)
