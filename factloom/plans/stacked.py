"""Queries on stacked tables of places: states by evidence, then by blocks, then the checks; and their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from factloom.operators import inference, places
from factloom.operators.quality import sum_check
from factloom.plans.facts import t
from factloom.plans.headlines import GENERIC, QUALIFIERS, _world
from factloom.session import written

#: a state, the first year that it existed, and what it was part of before
SUCCESSORS = [("n8", 2014, "n9"), ("n10", 2019, "n3")]


def stacked_facts(spark, sf_dir):
    """Customers as rows of sheets of a hundred, in blocks of six of which the last is the total; a third of the blocks prints no state and names unknown units."""
    c, p = t(spark, sf_dir, "customer"), t(spark, sf_dir, "part").select(F.col("p_partkey").alias("c_custkey"), "p_name")
    sheet = F.floor(F.col("c_custkey") / 100)
    d = c.join(p, "c_custkey", "left").select("c_custkey", F.concat(F.lit("f"), F.floor(sheet / 7)).alias("file"), F.concat(F.lit("s"), sheet).alias("sheet"), "p_name", "c_acctbal", sheet.alias("k"))
    w = Window.partitionBy("file", "sheet").orderBy("c_custkey")
    d = d.withColumn("i", F.row_number().over(w) - 1).withColumn("b", F.floor(F.col("i") / 6)).withColumn("is_total", F.col("i") % 6 == 5)
    known, state = F.col("b") % 3 != 1, F.concat(F.lit("n"), F.col("b") % 25)
    value = F.when(F.col("c_custkey") % 5 == 0, 30.0).otherwise(10.0)
    d = d.withColumn("part", F.when(F.col("is_total"), 0).otherwise(value))
    total = F.sum("part").over(Window.partitionBy("file", "sheet", "b"))
    return d.select(
        F.col("c_custkey").alias("pos"), "file", "sheet", F.when(F.col("k") % 4 == 1, F.concat(F.lit("Towns of nation "), F.chr(97 + F.col("k") % 10))).otherwise(F.lit("Towns")).alias("table_title"),
        F.when(F.col("c_custkey") % 3 == 0, "city").otherwise("district").alias("entity_type"),
        F.when(F.col("is_total"), "Total").when(known, F.col("p_name")).otherwise(F.concat(F.lit("unit "), F.col("i"))).alias("entity"), F.lit(None).cast("string").alias("state_code"),
        F.when(known & ~F.col("is_total") & (F.col("i") % 2 == 0), state).alias("parent_state_code"), "is_total", (2009 + F.col("k") % 12).cast("double").alias("year"),
        F.when(F.col("is_total"), total + F.when(F.col("b") % 9 == 4, 500).otherwise(0)).otherwise(value).alias("value"))


def inferred(spark, sf_dir):
    states, gazetteer, aliases = _world(spark, sf_dir)
    look = lambda n: places.candidates(n, gazetteer, aliases, GENERIC, QUALIFIERS)
    return inference.infer_states(stacked_facts(spark, sf_dir), "pos", states, look, SUCCESSORS)


def inferred_states(spark, sf_dir):
    return inferred(spark, sf_dir).select("pos", "parent_state_code", "state_code", "state_inferred")


def settled_blocks(spark, sf_dir):
    """Towns count as districts here, so that all rows of the sheets take part in the blocks."""
    facts = written(inferred(spark, sf_dir).withColumn("entity_type", F.lit("district")), "inferred")
    sequence = t(spark, sf_dir, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("code"), F.col("n_nationkey").alias("place"))
    s = written(inference.settle_blocks(facts, "pos", sequence, 2014, 2020), "settled")
    keys = ["file", "sheet", "table_title", "year"]
    s = sum_check(s, keys, "value", "pos", F.col("is_total"), ~F.col("is_total"))
    return inference.check_blocks(s, keys, "value", F.lit(False)).select("pos", "parent_state_code", "state_inferred", "qc")


QUERIES = {f.__name__: f for f in (inferred_states, settled_blocks)}

_NORMAL = "trim(regexp_replace(regexp_replace(lower(replace({}, '&', ' and ')), '[^a-z]+', ' ', 'g'), ' +', ' ', 'g'))"
_STATE = "translate(n_name, '_0123456789', ' abcdefghij')"
_YEARS = "case " + " ".join(f"when s = '{new}' and year < {since} then '{old}'" for new, since, old in SUCCESSORS) + " else s end"
FLOW = rf"""
c0 as (select c_custkey as pos, 'f' || (c_custkey // 100) // 7 as file, 's' || c_custkey // 100 as sheet, p_name, c_custkey // 100 as k, row_number() over (partition by c_custkey // 100 order by c_custkey) - 1 as i from customer left join part on p_partkey = c_custkey),
c1 as (select *, i // 6 as b, i % 6 = 5 as is_total, case when pos % 5 = 0 then 30.0 else 10.0 end as own from c0),
facts as (select pos, file, sheet, case when k % 4 = 1 then 'Towns of nation ' || chr((97 + k % 10)::int) else 'Towns' end as title, case when pos % 3 = 0 then 'city' else 'district' end as type,
  case when is_total then 'Total' when b % 3 <> 1 then p_name else 'unit ' || i end as entity, case when b % 3 <> 1 and not is_total and i % 2 = 0 then 'n' || b % 25 end as parent, is_total, 2009 + k % 12 as year,
  case when is_total then sum(case when is_total then 0 else own end) over (partition by sheet, b) + case when b % 9 = 4 then 500 else 0 end else own end as value from c1),
sn as (select {_NORMAL.format(_STATE)} as name, 'n' || n_nationkey as state from nation),
gz as (select {_NORMAL.format('p_name')} as name, 'n' || (case when p_size % 3 = 0 then length(p_name) % 25 else ascii(p_name) % 25 end) as state, sum(p_size) as population, case when min(p_size) % 2 = 0 then 'district' else 'city' end as kind from part group by 1, 2),
al as (select * from (select regexp_extract(p_name, '([a-z]+)$', 1) as alias, min(p_name) as name from part group by 1) where alias <> ''),
ask as (select distinct file, sheet, type, entity from facts where not is_total and parent is null and entity is not null),
ky as (select distinct entity, regexp_extract({_NORMAL.format('entity')}, '^(.+?)(?: (?:city|rural))*$', 1) as own from ask),
kz as (select entity, coalesce((select al.name from al where al.alias = own), own) as key from ky),
ca as (select entity, list({{'p': -population, 's': state}} order by -population, state) as c, count(*) filter (kind = 'district') as districts from kz join gz on gz.name = kz.key where key <> 'hot gear' group by 1),
e as (select ask.*, sn.state as own_state, c, districts from ask left join ca using (entity) left join sn on sn.name = {_NORMAL.format('entity')}),
ti as (select file, sheet, arg_min(title, pos) as title from facts where not is_total and parent is null group by 1, 2),
vo as (select file, sheet, parent as vote, 1 as n from (select distinct file, sheet, entity, parent from facts where not is_total and parent is not null)
  union all select file, sheet, state, 3 from ti join sn on contains(' ' || {_NORMAL.format('title')} || ' ', ' ' || sn.name || ' ')
  union all select file, sheet, coalesce(own_state, case when len(c) = 1 then c[1].s end), 1 from e),
vs as (select file, sheet, vote, sum(n) as n from vo where vote is not null group by all),
vt as (select file, sheet, arg_min(vote, (-n, vote)) as top, max(n) as top_n, sum(n) as votes from vs group by 1, 2),
st as (select e.*, case when votes >= 5 and top_n >= 0.8 * votes then top end as strong from e left join vt using (file, sheet)),
rs as (select file, sheet, type, entity, coalesce(own_state, case when len(c) = 1 then case when strong is null or strong = c[1].s then c[1].s end
  when len(c) > 1 then case when list_contains(list_transform(c, lambda z: z.s), strong) then strong when (type = 'city' or districts <= 1) and -c[1].p >= 3 * greatest(-c[2].p, 1) then c[1].s end end) as s from st),
inf as (select f.*, case when not is_total and parent is null then {_YEARS} end as new from facts f left join rs using (file, sheet, type, entity)),
fin as (select pos, file, sheet, title, entity, is_total, year, value, coalesce(parent, new) as parent, new is not null as inferred, case when type = 'city' then new end as state_code from inf)"""
ORACLES = {
    "inferred_states": f"with {FLOW} select pos, parent as parent_state_code, state_code, inferred as state_inferred from fin",
    "settled_blocks": rf"""with {FLOW},
r0 as (select *, case when entity is not distinct from lag(entity) over (partition by file, sheet, title order by pos) and row_number() over (partition by file, sheet, title order by pos) > 1 then 0 else 1 end as new_run from fin),
r1 as (select *, sum(new_run) over (partition by file, sheet, title order by pos) as run from r0),
r2 as (select file, sheet, title, run, max(parent) as code, arg_min(is_total, pos) as total, arg_min(inferred, pos) as inf, arg_min(year, pos) as year from r1 group by all),
r3 as (select *, 1 + coalesce(sum(total::int) over (partition by file, sheet, title order by run rows between unbounded preceding and 1 preceding), 0) as block from r2),
n as (select file, sheet, title, block, code, count(*) as n from r3 where not total and code is not null group by all),
top as (select file, sheet, title, block, arg_min(code, (-n, code)) as code, max(n) as n, sum(n) as placed from n group by all),
b0 as (select file, sheet, title, block, arg_min(year, run) as year, count(*) filter (not total) as rows from r3 group by all),
b1 as (select b0.*, case when n >= 0.8 * placed and (n >= 2 or rows = 1) then code end as code, case when n >= 0.8 * placed and (n >= 2 or rows = 1) then n else 0 end as won from b0 left join top using (file, sheet, title, block)),
b2 as (select *, substr(code, 2)::int as p, last_value(substr(code, 2)::int ignore nulls) over (x rows between unbounded preceding and 1 preceding) as a, first_value(substr(code, 2)::int ignore nulls) over (x rows between 1 following and unbounded following) as z,
  count(code) over (x rows between unbounded preceding and current row) as gap, first_value(year) over x as first_year from b1 window x as (partition by file, sheet, title order by block)),
u as (select *, row_number() over (partition by file, sheet, title, gap order by block) as k, count(*) over (partition by file, sheet, title, gap) as size from b2 where code is null and first_year >= 2014 and first_year < 2020),
fr as (select file, sheet, title, gap, size, n_nationkey as q, row_number() over (partition by file, sheet, title, gap order by n_nationkey) as k, count(*) over (partition by file, sheet, title, gap) as m
  from (select distinct file, sheet, title, gap, size, a, z from u) g join nation on (a is null or n_nationkey > a) and (z is null or n_nationkey < z)
  where not exists (select 1 from b1 where b1.file = g.file and b1.sheet = g.sheet and b1.title = g.title and b1.code = 'n' || n_nationkey)),
b3 as (select b1.file, b1.sheet, b1.title, b1.block, b1.won, coalesce(b1.code, 'n' || q) as code from b1 left join u using (file, sheet, title, block) left join fr on fr.file = u.file and fr.sheet = u.sheet and fr.title = u.title and fr.gap = u.gap and fr.k = u.k and m = fr.size),
r4 as (select r3.file, r3.sheet, r3.title, r3.run, case when b3.code is not null and (r3.code is null or (inf and won >= 4 and r3.code <> b3.code)) then b3.code end as takes from r3 join b3 using (file, sheet, title, block)),
f1 as (select r1.*, coalesce(takes, parent) as now, inferred or takes is not null as now_inferred from r1 join r4 using (file, sheet, title, run)),
q as (select file, sheet, title, year, now, sum(value) filter (is_total) as t, count(*) filter (is_total) as n, sum(value) filter (not is_total) as p from f1 group by all)
select pos, now as parent_state_code, now_inferred as state_inferred, case when now is null or n <> 1 or t is null or p is null then 'unchecked' when abs(t - p) <= 0.005 * abs(t) + 1 then 'block_ok' else 'sum_mismatch' end as qc
from f1 left join q using (file, sheet, title, year, now)""",
}
