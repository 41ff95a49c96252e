"""Queries of panels by family and head over orders dressed as facts of published tables, and their SQL."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from factloom.operators import scopes
from factloom.plans.facts import t

TITLES = ["fraud against women (head-wise)", "cases registered under ipc & sll crimes", "disposal of cases under theft", "cases registered under larceny during 2003", "cyber crimes (state/ut-wise)",
          "district-wise crimes against children", "rainfall of the year", "cases registered under ipc crimes in state of nation c during", "district-wise missing persons", "cases registered under toll acts during 2004,"]
LABELS = ["Larceny | I", "2005 | Larceny (Total)", "2005", "2005 | CR", "Male | I", "Fraud (Sec. 4) | V", "Toll Act | I", "Table 3 | Thefts", "Nation c"]


def _facts(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("x"), F.col("o_custkey").alias("y"))
    pick = lambda names, i: F.try_element_at(F.array(*map(F.lit, names)), (i + 1).cast("int"))
    x, y = F.col("x"), F.col("y")
    kind = pick(["state", "district", "crime_head"], y % 3)
    return o.select(
        x.alias("pos"), F.concat(F.lit("f"), x).alias("file"), F.lit("s").alias("sheet"), pick(TITLES, (x + y) % 10).alias("title_key"), pick(TITLES, (x + y) % 10).alias("table_title"),
        pick(LABELS, F.floor(x / 7) % 9).alias("column_label"), kind.alias("entity_type"), F.when(y % 4 == 1, F.lit("Total (All India)")).otherwise(F.concat(F.lit("Larceny "), F.chr(97 + y % 5))).alias("entity"),
        F.when(y % 11 > 0, F.concat(F.lit("n"), y % 25)).alias("state_code"), F.concat(F.lit("n"), (y + 1) % 25).alias("parent_state_code"), (y % 4 == 1).alias("is_total"),
        F.when(x % 17 > 0, 2001 + F.floor(x / 3) % 5).alias("year"), pick(["cases_registered", "victims", "rate"], x % 3).alias("metric"), F.when(x % 5 == 0, "sum_mismatch").when(y % 3 == 1, "block_ok").otherwise("sum_ok").alias("qc"),
        (1 + F.floor(x / 2) % 3).cast("double").alias("value"), F.when(x % 7 > 0, (x % 1000).cast("string")).alias("capture"), F.when(x % 6 > 0, "xls").otherwise("pdf").alias("format"))


def _shown(df, *keys):
    return df.select(*keys, "year", "scope", "head_key", "head", "metric", "value", "votes", "checked", "disputed", "file")


def state_panel(spark, sf_dir):
    return _shown(scopes.state_panel(_facts(spark, sf_dir), "pos"), "state_code", "source")


def country_panel(spark, sf_dir):
    names = t(spark, sf_dir, "nation").select(F.translate("n_name", "_0123456789", " abcdefghij").alias("name"))
    return _shown(scopes.national_panel(_facts(spark, sf_dir), names, "pos"))


QUERIES = {f.__name__: f for f in (state_panel, country_panel)}

_Q = lambda s: "'" + s.replace("'", "''") + "'"
_LIST = lambda v: "[" + ", ".join(map(_Q, v)) + "]"
_RE = lambda c, p: f"regexp_matches({c}, {_Q(p)})"
_FAMILY = "case " + " ".join(f"when {_RE('title', p)} then '{k}'" for k, p in scopes.FAMILIES) + " else '' end"
_TOTALS = "case own " + " ".join(f"when '{k}' then {_Q(v)}" for k, v in scopes.FAMILY_TOTALS.items()) + " end"
_SYNONYM = "case key " + " ".join(f"when {_Q(k)} then {_Q(v)}" for k, v in scopes.SYNONYMS.items()) + " else key end"
_SEGMENTS = f"""list_filter(list_transform(string_split(label, ' | '), lambda s: trim(s)), lambda s: s <> '' and not regexp_full_match(s, '(19|20)[0-9]{{2}}') and not list_contains({_LIST(scopes.MEASURES)}, lower(s))
  and not {_RE('s', scopes.SOURCE_LABEL)} and not {_RE('s', scopes.BANNER)} and not {_RE('s', scopes.FAMILY_LABEL)})"""
_FACTS = f"""f0 as (select o_orderkey as x, o_custkey as y from orders),
f1 as (select x as pos, 'f' || x as file, {_LIST(TITLES)}[(x + y) % 10 + 1] as title, {_LIST(LABELS)}[(x // 7) % 9 + 1] as label, ['state', 'district', 'crime_head'][y % 3 + 1] as type,
  case when y % 4 = 1 then 'Total (All India)' else 'Larceny ' || chr((97 + y % 5)::int) end as entity, case when y % 11 > 0 then 'n' || y % 25 end as state, 'n' || (y + 1) % 25 as parent, y % 4 = 1 as total,
  case when x % 17 > 0 then 2001 + (x // 3) % 5 end as year, ['cases_registered', 'victims', 'rate'][x % 3 + 1] as metric, case when x % 5 = 0 then 'sum_mismatch' when y % 3 = 1 then 'block_ok' else 'sum_ok' end as qc,
  (1 + (x // 2) % 3)::double as value, case when x % 7 > 0 then (x % 1000)::varchar end as capture, case when x % 6 > 0 then 'xls' else 'pdf' end as format from f0),
f2 as (select *, {_SEGMENTS} as seg, {_FAMILY} as own from f1),
facts as (select *, case when len(seg) > 0 and len(list_filter(seg, lambda s: {_RE('s', scopes.PARTS)})) = 0 then array_to_string(seg, ' | ') end as label_head,
  case when ({_RE('title', scopes.HEADWISE)} or ({_RE('title', scopes.DISTRICTWISE)} and not contains(title, 'missing')) or {_RE('title', scopes.FAMILY_TITLE)}) and not {_RE('title', scopes.NOT_HEADWISE)} then own end as title_scope from f2 where year is not null)"""
_SETTLE = f"""b as (select *, head is null and regexp_matches(label, '(^|[^0-9])(19|20)[0-9]{{2}}([^0-9]|$)') and len(seg) = 0 and not {_RE('title', scopes.NOT_HEADWISE)} as bare from src),
b1 as (select *, case when bare then case title when 'cases registered under larceny during 2003' then 'Larceny' when 'cases registered under toll acts during 2004,' then 'Toll acts' when 'cases registered under ipc crimes in state of nation c during' then 'IPC crimes in state of nation c' end end as said from b),
b2 as (select *, bare and said is null and {_RE('title', scopes.SUMMARY)} and not {_RE('title', scopes.BOTH)} and not regexp_matches(title, 'head-?wise') as summary from b1),
b3 as (select * exclude (head), case when said is not null then case when own <> '' then own when {_RE('said', scopes.ACT)} then 'sll' else 'ipc' end when summary then own
    when not bare then case when title_scope in ('ipc', 'sll') and {_RE('title', scopes.BOTH)} then case when {_RE('head', scopes.ACT)} then 'sll' else 'ipc' end else title_scope end end as scope,
  case when said is not null then said when summary then {_TOTALS} else head end as head from b2),
b4 as (select *, trim(regexp_replace(regexp_replace(regexp_replace(lower(head), '\\( *total *\\)', ' total ', 'g'), {_Q(scopes.HEAD_NOISE)}, '', 'g'), ' +', ' ', 'g')) as key from b3 where scope <> '' and head is not null),
v as (select *, {_SYNONYM} as head_key from b4),
g as (select {{k}} year, scope, head_key, metric, value, count(*) as votes, min(priority) as p, bool_or(qc = 'sum_ok') as checked from v group by all),
w as (select *, row_number() over (partition by {{k}} year, scope, head_key, metric order by votes desc, p, value) as i, count(*) over (partition by {{k}} year, scope, head_key, metric) > 1 as disputed from g),
r as (select v.*, w.votes, w.checked, w.disputed, row_number() over (partition by {{n}} v.year, v.scope, v.head_key, v.metric order by v.priority, v.capture desc nulls last, v.pos) as j
  from v join w on {{on}} v.year = w.year and v.scope = w.scope and v.head_key = w.head_key and v.metric = w.metric and v.value = w.value and w.i = 1)
select {{out}} year, scope, head_key, trim(regexp_replace(head, ' +', ' ', 'g')) as head, metric, value, votes, checked, disputed, file from r where j = 1"""
_settle = lambda *own: functools.reduce(lambda s, kv: s.replace(*kv), zip(("{k}", "{n}", "{on}", "{out}"), own, strict=True), _SETTLE)
_KEEP = lambda v: "metric in (" + ", ".join(map(_Q, v)) + ")"
ORACLES = {
    "state_panel": f"""with {_FACTS},
src as (select * exclude (state), state, label_head as head, 'state_table' as source, 0 as priority from facts where {_KEEP(scopes.KEEP)} and qc = 'sum_ok' and type = 'state' and state is not null and not total
  union all select * exclude (state), parent as state, label_head, 'district_total', 1 from facts where {_KEEP(scopes.KEEP)} and qc = 'block_ok' and ((type = 'district' and total) or (type = 'state' and not total))),
""" + _settle("state,", "v.state,", "v.state = w.state and", "state as state_code, source,"),
    "country_panel": f"""with {_FACTS}, names as (select translate(lower(n_name), '_0123456789', ' abcdefghij') as name from nation),
src as (select *, case when not {_RE('entity', scopes.PARTS)} or regexp_matches(entity, '(?i)^total') then entity end as head, 0 as priority from facts where {_KEEP(scopes.KEEP_NATIONAL)} and format = 'xls' and type = 'crime_head' and not {_RE('label', scopes.PARTS)}
    and regexp_extract(title, {_Q(scopes.OF_PLACE)}, 1) not in (select name from names) and lower(string_split(label, ' | ')[-1]) not in (select name from names)
  union all select *, label_head, 0 from facts where {_KEEP(scopes.KEEP_NATIONAL)} and type = 'state' and total and qc = 'sum_ok' and regexp_matches(entity, '(?i)india')),
""" + _settle("", "", "", "")}
