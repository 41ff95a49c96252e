"""Queries over figures: sum checks, conflicts, votes, panels, order operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators import order, quality, reconcile, resolve
from factloom.operators.grid import unpivot




def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(c: str):
    return F.col(c).cast("decimal(18,2)")


def order_facts(spark, sf_dir) -> DataFrame:
    """Facts: order value per year, region and nation."""
    o, c = t(spark, sf_dir, "orders"), t(spark, sf_dir, "customer")
    n, r = t(spark, sf_dir, "nation"), t(spark, sf_dir, "region")
    return o.join(c, o.o_custkey == c.c_custkey).groupBy(F.year("o_orderdate").alias("year"), "c_nationkey").agg(F.sum(money("o_totalprice")).alias("v")) \
        .join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey).join(F.broadcast(r), n.n_regionkey == r.r_regionkey) \
        .select("year", F.col("r_name").alias("region"), F.col("n_name").alias("entity"), F.col("n_nationkey").alias("ord"), F.col("v").cast("double").alias("value"))


FACTS_SQL = """facts as (select year(o_orderdate) as year, r_name as region, n_name as entity, n_nationkey as ord, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as value
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1, 2, 3, 4)"""


def checked_national(spark, sf_dir):
    f = order_facts(spark, sf_dir)
    total = f.groupBy("year").agg(F.sum("value").alias("value")).filter("year % 5 <> 0").select("year", F.lit(None).cast("string").alias("region"), F.lit("Total").alias("entity"), F.lit(-1).alias("ord"), (F.col("value") * F.when(F.col("year") % 3 == 0, 1.02).otherwise(1.0)).alias("value"))
    both = f.withColumn("is_total", F.lit(False)).unionByName(total.withColumn("is_total", F.lit(True)))
    return quality.sum_check(both, ["year"], "value", "ord", F.col("is_total"), ~F.col("is_total"))


def sum_check_national(spark, sf_dir):
    return checked_national(spark, sf_dir).select("year", "entity", "is_total", F.round("value", 2).alias("value"), "qc")


def sum_check_block(spark, sf_dir):
    f = order_facts(spark, sf_dir)
    total = f.groupBy("year", "region").agg(F.sum("value").alias("value")).withColumn("value", F.col("value") * F.when((F.col("year") + F.length("region")) % 3 == 0, 1.02).otherwise(1.0))
    total = total.withColumn("_n", F.explode(F.when((F.col("region") == "ASIA") & (F.col("year") % 2 == 0), F.sequence(F.lit(1), F.lit(2))).otherwise(F.sequence(F.lit(1), F.lit(1))))).drop("_n")
    both = f.select("year", "region", "entity", "value", F.lit(False).alias("is_total")).unionByName(total.select("year", "region", F.lit("Total").alias("entity"), "value", F.lit(True).alias("is_total")))
    return quality.block_check(both, ["year", "region"], "value", F.col("is_total"), ~F.col("is_total")).select("year", "region", "entity", F.round("value", 2).alias("value"), "qc")


def conflict_flags(spark, sf_dir):
    return quality.conflict_flags(t(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_tax", "l_orderkey"), ["l_partkey", "l_suppkey"], "l_tax", "l_orderkey")


def dedupe_keep_first(spark, sf_dir):
    d = t(spark, sf_dir, "documents").select("doc_id", "source", F.md5(F.coalesce("text", F.lit(""))).alias("h"))
    return reconcile.keep_first(d, ["h"], ["source", "doc_id"]).select("doc_id", "source", "h")


def with_k(spark, sf_dir):
    return t(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").try_cast("int"))


def majority_collapse(spark, sf_dir):
    return reconcile.majority_collapse(with_k(spark, sf_dir).select("user_id", "event_type", "k"), ["user_id", "event_type"], "k")


def plurality_share(spark, sf_dir):
    return reconcile.plurality(t(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment"), ["c_nationkey"], "c_mktsegment", 0.25)


def split_entity_sum(spark, sf_dir):
    s = t(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.sum(money("s_acctbal")).cast("double").alias("value"))
    d = s.join(F.broadcast(t(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    d = d.select(F.when(F.col("n_nationkey") == 1, 0).otherwise(F.col("n_nationkey")).alias("nation"), "value", F.col("n_name").alias("name"), F.col("n_nationkey").alias("ord"))
    return reconcile.merge_split_entities(d, ["nation"], "value", "ord").select("nation", F.round("value", 2).alias("value"), "name", "n_merged")


def nation_year_panel(spark, sf_dir):
    o, c = t(spark, sf_dir, "orders"), t(spark, sf_dir, "customer")
    scope = F.when(F.col("o_orderstatus") == "F", "final").when(F.col("o_orderstatus") == "O", "open").otherwise("partial")
    g = o.join(c, o.o_custkey == c.c_custkey).groupBy("c_nationkey", F.year("o_orderdate").alias("year"), scope.alias("scope")).agg(F.sum(money("o_totalprice")).alias("v"), F.count(F.lit(1)).alias("n"))
    return g.join(F.broadcast(t(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("nation"), "year", "scope", F.col("v").cast("double").alias("value"), "n")


def national_panel(spark, sf_dir):
    """Verified national figures: the total row where the sum check holds, else the sum of the parts, marked unchecked."""
    f = checked_national(spark, sf_dir)
    total = f.filter(F.col("is_total") & (F.col("qc") == "sum_ok")).select("year", "value", F.lit(True).alias("checked"))
    parts = f.filter(~F.col("is_total") & (F.col("qc") != "sum_ok")).groupBy("year").agg(F.sum("value").alias("value")).withColumn("checked", F.lit(False))
    return total.unionByName(parts).select("year", F.round("value", 1).alias("value"), "checked")


def ev(spark, sf_dir):
    return with_k(spark, sf_dir).select("event_id", "ts", "user_id", "event_type", "value", "k")


def runs_islands(spark, sf_dir):
    r = order.run_id(ev(spark, sf_dir), ["user_id"], ["ts", "event_id"], "event_type")
    return r.groupBy("user_id", "run").agg(F.first("event_type").alias("event_type"), F.count(F.lit(1)).alias("n"), F.min_by("event_id", F.struct("ts", "event_id")).alias("first_event"))


def blocks_by_terminator(spark, sf_dir):
    b = order.blocks_closed_by(ev(spark, sf_dir), ["user_id"], ["ts", "event_id"], F.col("event_type") == "purchase")
    return b.groupBy("user_id", "block").agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.col("event_type") == "purchase").alias("closed"))


def carry_down_context(spark, sf_dir):
    return order.carry_down(ev(spark, sf_dir), ["user_id"], ["ts", "event_id"], F.when(F.col("event_type") == "signup", F.col("event_id")), F.col("event_type") == "error").select("event_id", "context")


def header_ffill(spark, sf_dir):
    e = ev(spark, sf_dir).withColumn("sparse", F.when(F.col("event_id") % 3 == 0, F.col("k")))
    return order.forward_fill(e, ["user_id"], ["ts", "event_id"], "sparse", "filled").select("event_id", "filled")


def elimination_fill(spark, sf_dir):
    n = t(spark, sf_dir, "nation").withColumn("code", F.col("n_nationkey")).withColumn("sheet", F.col("n_regionkey"))
    codes = n.select("sheet", "code")
    rows = n.filter("n_nationkey % 11 <> 4").withColumn("seen", F.when((F.col("n_nationkey") * 7 + F.col("n_regionkey")) % 3 != 0, F.col("code")))
    out = order.elimination_fill(rows.select("sheet", "n_nationkey", F.col("seen").alias("code")), ["sheet"], ["n_nationkey"], "code", codes)
    return out.select("sheet", "n_nationkey", "code", "filled")


def merged_range_join(spark, sf_dir):
    p = t(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    r = p.filter("p_partkey % 100 = 0").select(F.col("p_partkey").alias("r0"), (F.col("p_partkey") + 9).alias("r1"), F.col("p_brand").alias("anchor"))
    return resolve.range_join(p, "p_partkey", r, "r0", "r1", 64).select("p_partkey", F.coalesce("anchor", "p_name").alias("label"))


def adjacent_collapse(spark, sf_dir):
    d = order.adjacent_distinct(ev(spark, sf_dir), ["user_id"], ["ts", "event_id"], "event_type")
    g = d.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("ts", "event_id", "event_type"))).alias("x"))
    return g.select("user_id", F.array_join(F.transform("x", lambda s: s["event_type"]), ">").alias("path"))


def block_label_vote(spark, sf_dir):
    b = order.blocks_closed_by(ev(spark, sf_dir), ["user_id"], ["ts", "event_id"], F.col("event_type") == "purchase")
    return reconcile.plurality(b.filter("event_type <> 'purchase'").select("user_id", "block", "event_type"), ["user_id", "block"], "event_type", 0.5)


def unpivot_facts(spark, sf_dir):
    return unpivot(t(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice"), ["p_partkey"], ["p_size", "p_retailprice"])


def latest_row(spark, sf_dir):
    return reconcile.latest(ev(spark, sf_dir), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


def upsert_by_key(spark, sf_dir):
    lab = t(spark, sf_dir, "labels").select("doc_id", "quality")
    old, new = lab.filter("doc_id % 2 = 0"), lab.filter("doc_id % 3 = 0").select("doc_id", (1 - F.col("quality")).alias("quality"))
    return reconcile.upsert(old, new, "doc_id", lab.filter("doc_id % 7 = 0"))


def source_trace(spark, sf_dir):
    top = t(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)
    c, n = t(spark, sf_dir, "customer"), t(spark, sf_dir, "nation")
    return top.join(c, top.o_custkey == c.c_custkey).join(F.broadcast(n), c.c_nationkey == n.n_nationkey).select("o_orderkey", "o_totalprice", "c_name", "n_name")


def semi_membership(spark, sf_dir):
    big = t(spark, sf_dir, "lineitem").filter("l_quantity >= 49").select(F.col("l_orderkey").alias("o_orderkey"))
    return t(spark, sf_dir, "orders").join(big, "o_orderkey", "left_semi").select("o_orderkey", "o_orderstatus")


def anti_seen(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", "lang").join(t(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


def series_sum(spark, sf_dir):
    return order_facts(spark, sf_dir).groupBy("year").agg(F.round(F.sum("value"), 1).alias("value"), F.count(F.lit(1)).alias("n"))


def top10_latest(spark, sf_dir):
    f = order_facts(spark, sf_dir)
    year = f.agg(F.max("year").alias("year"))
    return f.join(F.broadcast(year), "year").orderBy(F.desc("value"), "entity").limit(10).select("year", "entity", "value")


def shrink_guard(spark, sf_dir):
    """Row counts of the tables against yesterday's (here: the filtered ones), and whether publication is allowed."""
    out = None
    for name, key in (("orders", "o_orderkey"), ("customer", "c_custkey"), ("part", "p_partkey")):
        d = t(spark, sf_dir, name).agg(F.count(F.lit(1)).alias("previous"), F.count(F.when(F.col(key) % (12 if name == "orders" else 5) != 0, 1)).alias("current")).select(F.lit(name).alias("table_name"), "previous", "current", (F.col("current") >= 0.9 * F.col("previous")).alias("ok"))
        out = d if out is None else out.unionByName(d)
    return out


EV = "ev as (select *, cast(props->>'$.k' as int) as k from events)"
BLOCKS = EV + """, b as (select *, 1 + coalesce(sum(case when event_type = 'purchase' then 1 else 0 end) over (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding), 0) as block from ev)"""
CHECKED = FACTS_SQL + """, total as (select year, 'Total' as entity, sum(value) * case when year % 3 = 0 then 1.02 else 1.0 end as value from facts where year % 5 <> 0 group by year),
both_ as (select year, entity, false as is_total, value from facts union all select year, entity, true, value from total),
s as (select year, sum(case when is_total then value end) as t, sum(case when not is_total then value end) as p from both_ group by year),
checked as (select both_.*, case when t is null or p is null then 'unchecked' when abs(t - p) <= 0.005 * abs(t) + 1 then 'sum_ok' else 'sum_mismatch' end as qc from both_ join s using (year))"""

QUERIES = {f.__name__: f for f in (
    sum_check_national, sum_check_block, conflict_flags, dedupe_keep_first, majority_collapse, plurality_share, split_entity_sum, nation_year_panel, national_panel, runs_islands, blocks_by_terminator, carry_down_context, header_ffill,
    elimination_fill, merged_range_join, adjacent_collapse, block_label_vote, unpivot_facts, latest_row, upsert_by_key, source_trace, semi_membership, anti_seen, series_sum, top10_latest, shrink_guard)}

ORACLES = {
    "sum_check_national": f"with {CHECKED} select year, entity, is_total, round(value, 2) as value, qc from checked",
    "sum_check_block": f"""with {FACTS_SQL}, total as (select year, region, sum(value) * case when (year + length(region)) % 3 = 0 then 1.02 else 1.0 end as value from facts group by year, region),
twice as (select * from total union all select * from total where region = 'ASIA' and year % 2 = 0),
s as (select year, region, (select sum(value) from facts f where f.year = x.year and f.region = x.region) as p, count(*) as n, min(value) as t from twice x group by year, region),
u as (select year, region, entity, value from facts union all select year, region, 'Total', value from twice)
select u.year, u.region, entity, round(u.value, 2) as value, case when n <> 1 or t is null or p is null then 'unchecked' when abs(t - p) <= 0.005 * abs(t) + 1 then 'block_ok' else 'sum_mismatch' end as qc from u join s on u.year = s.year and u.region = s.region""",
    "conflict_flags": "select l_partkey, l_suppkey, count(*) as n_rows, count(distinct l_orderkey) as n_sources, min(l_tax) <> max(l_tax) as conflict from lineitem group by 1, 2",
    "dedupe_keep_first": "select doc_id, source, h from (select doc_id, source, md5(coalesce(text, '')) as h, row_number() over (partition by md5(coalesce(text, '')) order by source, doc_id) as r from documents) where r = 1",
    "majority_collapse": f"""with {EV}, v as (select user_id, event_type, k, count(*) as n from ev where k is not null group by 1, 2, 3),
r as (select *, row_number() over (partition by user_id, event_type order by n desc, k) as r, sum(n) over (partition by user_id, event_type) as n_rows, count(*) over (partition by user_id, event_type) as d from v)
select user_id, event_type, k as winner, n as votes, cast(n_rows as bigint) as n_rows, d > 1 as disputed from r where r = 1""",
    "plurality_share": """with v as (select c_nationkey, c_mktsegment, count(*) as n from customer group by 1, 2),
r as (select *, row_number() over (partition by c_nationkey order by n desc, c_mktsegment) as r, cast(sum(n) over (partition by c_nationkey) as bigint) as n_rows from v)
select c_nationkey, case when n >= 0.25 * n_rows and (n >= 2 or n_rows = 1) then c_mktsegment end as label, n as n_top, n_rows from r where r = 1""",
    "split_entity_sum": """with s as (select s_nationkey, cast(sum(cast(s_acctbal as decimal(18,2))) as double) as value from supplier group by 1),
d as (select case when n_nationkey = 1 then 0 else n_nationkey end as nation, value, n_name, n_nationkey from s join nation on s_nationkey = n_nationkey)
select nation, round(sum(value), 2) as value, arg_min(n_name, n_nationkey) as name, count(*) as n_merged from d group by nation""",
    "nation_year_panel": """select n_name as nation, year(o_orderdate) as year, case o_orderstatus when 'F' then 'final' when 'O' then 'open' else 'partial' end as scope, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as value, count(*) as n
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1, 2, 3""",
    "national_panel": f"with {CHECKED} select year, round(value, 1) as value, true as checked from checked where is_total and qc = 'sum_ok' union all select year, round(sum(value), 1), false from checked where not is_total and qc <> 'sum_ok' group by year",
    "runs_islands": f"""with {EV}, c as (select *, case when lag(event_type) over w is distinct from event_type or row_number() over w = 1 then 1 else 0 end as c from ev window w as (partition by user_id order by ts, event_id)),
r as (select *, sum(c) over (partition by user_id order by ts, event_id rows unbounded preceding) as run from c)
select user_id, cast(run as bigint) as run, min(event_type) as event_type, count(*) as n, arg_min(event_id, (ts, event_id)) as first_event from r group by 1, 2""",
    "blocks_by_terminator": f"with {BLOCKS} select user_id, cast(block as bigint) as block, count(*) as n, bool_or(event_type = 'purchase') as closed from b group by 1, 2",
    "carry_down_context": f"""with {EV}, s as (select *, coalesce(sum(case when event_type = 'error' then 1 else 0 end) over (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding), 0) as seg from ev)
select event_id, last_value(case when event_type = 'signup' then event_id end ignore nulls) over (partition by user_id, seg order by ts, event_id rows unbounded preceding) as context from s""",
    "header_ffill": f"with {EV} select event_id, last_value(case when event_id % 3 = 0 then k end ignore nulls) over (partition by user_id order by ts, event_id rows unbounded preceding) as filled from ev",
    "elimination_fill": """with n as (select n_regionkey as sheet, n_nationkey, n_nationkey as code from nation),
r as (select sheet, n_nationkey, case when (n_nationkey * 7 + sheet) % 3 <> 0 then code end as code from n where n_nationkey % 11 <> 4),
g as (select *, coalesce(last_value(code ignore nulls) over (partition by sheet order by n_nationkey rows unbounded preceding), -1) as a,
  coalesce(first_value(code ignore nulls) over (partition by sheet order by n_nationkey rows between current row and unbounded following), 2147483647) as z from r),
m as (select *, count(*) over (partition by sheet, a, z, code is null) as c, row_number() over (partition by sheet, a, z, code is null order by n_nationkey) as k from g),
f as (select n.sheet, n.code from n where not exists (select 1 from r where r.sheet = n.sheet and r.code = n.code)),
x as (select d.sheet, d.a, d.z, f.code as free, count(*) over (partition by d.sheet, d.a, d.z) as c2, d.c, row_number() over (partition by d.sheet, d.a, d.z order by f.code) as k
  from (select distinct sheet, a, z, c from m where code is null) d join f on f.sheet = d.sheet and f.code > d.a and f.code < d.z)
select m.sheet, m.n_nationkey, m.code, coalesce(m.code, x.free) as filled from m left join x on m.sheet = x.sheet and m.a = x.a and m.z = x.z and m.k = x.k and x.c2 = x.c""",
    "merged_range_join": "select p.p_partkey, coalesce(r.p_brand, p.p_name) as label from part p left join part r on r.p_partkey % 100 = 0 and p.p_partkey between r.p_partkey and r.p_partkey + 9",
    "adjacent_collapse": f"""with {EV}, c as (select *, lag(event_type) over w as p, row_number() over w as r from ev window w as (partition by user_id order by ts, event_id))
select user_id, string_agg(event_type, '>' order by ts, event_id) as path from c where r = 1 or p is distinct from event_type group by 1""",
    "block_label_vote": f"""with {BLOCKS}, v as (select user_id, block, event_type, count(*) as n from b where event_type <> 'purchase' group by 1, 2, 3),
r as (select *, row_number() over (partition by user_id, block order by n desc, event_type) as r, sum(n) over (partition by user_id, block) as n_rows from v)
select user_id, cast(block as bigint) as block, case when n >= 0.5 * n_rows and (n >= 2 or n_rows = 1) then event_type end as label, n as n_top, cast(n_rows as bigint) as n_rows from r where r = 1""",
    "unpivot_facts": "select p_partkey, 'p_size' as label, cast(p_size as double) as value from part where p_size is not null union all select p_partkey, 'p_retailprice', p_retailprice from part where p_retailprice is not null",
    "latest_row": "select user_id, event_id, event_type, value from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as r from events) where r = 1",
    "upsert_by_key": """with n as (select doc_id, 1 - quality as quality from labels where doc_id % 3 = 0), o as (select doc_id, quality from labels where doc_id % 2 = 0 and doc_id not in (select doc_id from n))
select * from (select * from o union all select * from n) where doc_id not in (select doc_id from labels where doc_id % 7 = 0)""",
    "source_trace": "select o_orderkey, o_totalprice, c_name, n_name from (select * from orders order by o_totalprice desc, o_orderkey limit 20) join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey",
    "semi_membership": "select o_orderkey, o_orderstatus from orders where o_orderkey in (select l_orderkey from lineitem where l_quantity >= 49)",
    "anti_seen": "select doc_id, lang from documents where doc_id not in (select doc_id from labels where doc_id is not null)",
    "series_sum": f"with {FACTS_SQL} select year, round(sum(value), 1) as value, count(*) as n from facts group by year",
    "top10_latest": f"with {FACTS_SQL} select year, entity, value from facts where year = (select max(year) from facts) order by value desc, entity limit 10",
    "shrink_guard": """with c as (select 'orders' as table_name, count(*) as previous, count(*) filter (o_orderkey % 12 <> 0) as current from orders
union all select 'customer', count(*), count(*) filter (c_custkey % 5 <> 0) from customer union all select 'part', count(*), count(*) filter (p_partkey % 5 <> 0) from part)
select table_name, previous, current, current >= 0.9 * previous as ok from c""",
}
