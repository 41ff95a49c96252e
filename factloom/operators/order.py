"""Operators over source order: every one takes explicit ordering columns, never the rows' arrival."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.operators.names import unused


def _w(keys, order):
    return Window.partitionBy(*keys).orderBy(*order)


def run_id(df: DataFrame, keys: list[str], order: list[str], value: str, name: str = "run") -> DataFrame:
    """Gaps and islands: a new run (from 1) wherever the value changes; nulls equal nulls."""
    w = _w(keys, order)
    first = F.row_number().over(w) == 1
    changed = F.when(first | ~F.col(value).eqNullSafe(F.lag(value).over(w)), 1).otherwise(0)
    (c,) = unused([*df.columns, name], "changed")
    return df.withColumn(c, changed).withColumn(name, F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, 0))).drop(c)


def blocks_closed_by(df: DataFrame, keys: list[str], order: list[str], closes: Column, name: str = "block") -> DataFrame:
    """Blocks (from 1) that end with the row for which ``closes`` holds."""
    w = _w(keys, order)
    (end,) = unused([*df.columns, name], "ends")
    df = df.withColumn(end, F.coalesce(closes, F.lit(False)).cast("int"))
    return df.withColumn(name, 1 + F.coalesce(F.sum(end).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop(end)


def carry_down(df: DataFrame, keys: list[str], order: list[str], value: Column, resets: Column, name: str = "context") -> DataFrame:
    """The last non-null ``value`` up to a row; a row that ``resets`` still sees it, later ones do not."""
    v, seg = unused([*df.columns, name], "carried", "segment")
    df = blocks_closed_by(df.withColumn(v, value), keys, order, resets, seg)
    w = _w([*keys, seg], order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(v, ignorenulls=True).over(w)).drop(v, seg)


def forward_fill(df: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    w = _w(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def elimination_fill(df: DataFrame, keys: list[str], order: list[str], code: str, codes: DataFrame, name: str = "filled") -> DataFrame:
    """Unknown codes between known neighbours, filled if exactly as many unused codes lie strictly between them.

    ``code`` holds positions in an ordered list, ``codes`` the list per key (``keys`` and ``code``). A missing
    neighbour is the list's end.
    """
    w = _w(keys, order)
    a, z, n, k, f, m = unused([*df.columns, *codes.columns, name], "before", "behind", "unknown", "place", "free", "fitting")
    back, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    df = df.withColumn(a, F.coalesce(F.last(code, ignorenulls=True).over(back), F.lit(-1))).withColumn(z, F.coalesce(F.first(code, ignorenulls=True).over(ahead), F.lit(2**31 - 1)))
    gap = Window.partitionBy(*keys, a, z, F.col(code).isNull())
    df = df.withColumn(n, F.count(F.lit(1)).over(gap)).withColumn(k, F.row_number().over(gap.orderBy(*order)))
    used = df.filter(F.col(code).isNotNull()).select(*keys, code).distinct()
    free = codes.select(*keys, code).join(used, [*keys, code], "left_anti").withColumnRenamed(code, f)
    gaps = df.filter(F.col(code).isNull()).select(*keys, a, z, n).distinct()
    fit = gaps.join(free, keys).filter((F.col(f) > F.col(a)) & (F.col(f) < F.col(z)))
    g = Window.partitionBy(*keys, a, z)
    fit = fit.withColumn(m, F.count(F.lit(1)).over(g)).filter(F.col(m) == F.col(n)).withColumn(k, F.row_number().over(g.orderBy(f))).select(*keys, a, z, k, f)
    out = df.join(fit, [*keys, a, z, k], "left")
    return out.withColumn(name, F.coalesce(F.col(code), F.col(f))).drop(a, z, n, k, f)


def adjacent_distinct(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """The rows whose value differs from the row before."""
    w = _w(keys, order)
    p, r = unused(df.columns, "before", "place")
    return df.withColumn(p, F.lag(value).over(w)).withColumn(r, F.row_number().over(w)) \
        .filter((F.col(r) == 1) | ~F.col(value).eqNullSafe(F.col(p))).drop(p, r)
