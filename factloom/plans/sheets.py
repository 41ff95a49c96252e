"""Queries on sheets of stacked and side-by-side tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.operators import grid
from factloom.plans.facts import t

#: cells (row, column, text, figure) that every sheet has: a table with serial numbers, a strip of years over its head,
#: an index strip and a banner; below it two tables side by side, whose head spans two rows
FRAME = [(1, 2, None, 2001.0), (1, 4, None, 2002.0), (2, 0, "Sl. No.", None), (2, 1, "Holder", None), (2, 2, "balance", None), (2, 3, "key", None), (2, 4, "balance", None), (2, 5, "key", None),
         (3, 1, "(1)", None), (3, 2, "(2)", None), (3, 3, "(3)", None), (4, 1, "Zone: north", None),
         (101, 0, "State", None), (101, 1, "sent", None), (101, 2, "kept", None), (101, 4, "City", None), (101, 5, "sent", None),
         (102, 0, "State", None), (102, 1, None, 2010.0), (102, 2, None, 2010.0), (102, 4, "City", None), (102, 5, "2010", None)]


def _cells(spark, sf_dir):
    """Customers as sheets of sixty: forty in the upper table, of which each tenth is a total and two are banners, ten in each of the lower ones."""
    k, i = F.floor(F.col("c_custkey") / 60), F.col("c_custkey") % 60
    c = t(spark, sf_dir, "customer").select(k.alias("k"), i.alias("i"), "c_name", F.col("c_acctbal").cast("double").alias("bal"), F.col("c_custkey").cast("double").alias("key"))
    cell = lambda r, col, s=None, n=None: F.struct(F.lit(r).cast("int").alias("r"), F.lit(col).alias("c"), (F.lit(None) if s is None else s).cast("string").alias("v_str"), (F.lit(None) if n is None else n).cast("double").alias("v_num"))
    r, bal, key = F.col("i") + 5, F.col("bal"), F.col("key")
    name = F.when(F.col("i") % 10 == 9, F.lit("Total")).when(F.col("i") % 20 == 15, F.concat(F.lit("Zone: south "), "k")).otherwise(F.col("c_name"))
    upper = F.concat(F.array(cell(r, 0, None, F.col("i")), cell(r, 1, name)), F.when(F.col("i") % 20 == 15, F.array().cast("array<struct<r:int,c:int,v_str:string,v_num:double>>"))
                     .otherwise(F.array(cell(r, 2, None, bal), cell(r, 3, None, key), cell(r, 4, None, bal + 1), cell(r, 5, None, key + 1))))
    left = F.array(cell(F.col("i") + 63, 0, F.col("c_name")), cell(F.col("i") + 63, 1, None, bal), cell(F.col("i") + 63, 2, None, key))
    right = F.array(cell(F.col("i") + 53, 4, F.col("c_name")), cell(F.col("i") + 53, 5, F.format_number(key * 1000, 0)))
    body = c.select("k", F.explode(F.when(F.col("i") < 40, upper).when(F.col("i") < 50, left).otherwise(right)).alias("x"))
    titles = [cell(0, 0, F.concat(F.lit("Accounts of sheet "), "k")), cell(100, 0, F.concat(F.lit("Left part of sheet "), "k")), cell(100, 4, F.concat(F.lit("Right part of sheet "), "k"))]
    fixed = [cell(a, b, None if s is None else F.lit(s), None if n is None else F.lit(n)) for a, b, s, n in FRAME]
    frame = c.select("k").distinct().select("k", F.explode(F.array(*titles, *fixed)).alias("x"))
    return body.unionByName(frame).select(F.concat(F.lit("f"), F.floor(F.col("k") / 8)).alias("file"), F.concat(F.lit("s"), "k").alias("sheet"), "x.*")


def stacked_sheets(spark, sf_dir):
    return grid.sheet_facts(_cells(spark, sf_dir))


QUERIES = {"stacked_sheets": stacked_sheets}
ORACLES = {"stacked_sheets": """
with c as (select c_custkey // 60 as k, c_custkey % 60 as i, c_name, cast(c_acctbal as double) as bal, cast(c_custkey as double) as key from customer),
upper as (select k, 'Accounts of sheet ' || k as title, 'Holder' as entity_type, case when i % 10 = 9 then 'Total' else c_name end as entity,
    case when i < 10 then 'north' when i between 16 and 19 or i between 36 and 39 then 'south ' || k end as context, i % 10 = 9 as is_total, x.label, i + 5 as r, x.c, x.value
  from c, unnest([{'label': '2001 | balance', 'c': 2, 'value': bal}, {'label': '2001 | key', 'c': 3, 'value': key}, {'label': '2002 | balance', 'c': 4, 'value': bal + 1}, {'label': '2002 | key', 'c': 5, 'value': key + 1}]) as u(x)
  where i < 40 and i % 20 <> 15),
lower_left as (select k, 'Left part of sheet ' || k, 'State', c_name, null, false, x.label, i + 63, x.c, x.value
  from c, unnest([{'label': 'sent | 2010', 'c': 1, 'value': bal}, {'label': 'kept | 2010', 'c': 2, 'value': key}]) as u(x) where i between 40 and 49),
lower_right as (select k, 'Right part of sheet ' || k, 'City', c_name, null, false, 'sent | 2010', i + 53, 5, key * 1000 from c where i >= 50)
select 'f' || k // 8 as file, 's' || k as sheet, title, entity_type, entity, context, is_total, label, r::int as r, c::int as c, value
from (select * from upper union all select * from lower_left union all select * from lower_right)"""}
