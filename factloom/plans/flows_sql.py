"""DuckDB SQL for the queries of factloom.plans.flows."""

from __future__ import annotations

from factloom.plans.facts import FACTS_SQL
from factloom.plans.flows import ARCHIVE, EVENT_LABELS, GAZETTEER, GENERIC, PLACE_ALIASES, QUALIFIERS
from factloom.plans.texts_sql import NORMAL, values

K = "try_cast(json_extract_string(props, '$.k') as int)"
ENDS = "|".join(QUALIFIERS)
LISTED = lambda xs: ", ".join(f"'{x}'" for x in xs)
YEAR = r"(?:^|[^0-9])((?:19[5-9]|20[0-3])[0-9])"
#: every year that touches no other digit: digits runs of exactly four
YEARS = "list_distinct(list_filter(regexp_extract_all({}, '[0-9]+'), lambda x: regexp_full_match(x, '(19[5-9]|20[0-3])[0-9]')))"
ONE = "case when len(" + YEARS + ") = 1 then cast(" + YEARS + "[1] as int) end"
CELLS = """cells as (select 'f' as file, p_brand as sheet, cast(floor(p_partkey / 10) as int) * 2 as r, cast(p_partkey % 10 as int) * 3 as c, case when p_partkey % 3 > 0 then p_type end as v_str, case when p_partkey % 3 = 0 then cast(p_size as double) end as v_num from part)"""

ORACLES = {
    "block_labels": """
with e as (select user_id, ts, event_id, case when event_id % 4 = 0 then null when event_id % 11 = 0 then 7 else user_id % 3 end as code, event_type = 'purchase' as tot, event_id % 2 = 1 as inf from events),
b as (select *, 1 + coalesce(sum(tot::int) over (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding), 0) as block from e),
n as (select user_id, block, code, count(*) as n from b where not tot and code is not null group by 1, 2, 3),
g as (select user_id, block, first(code order by n desc, code) as code, max(n) as won, sum(n) as placed from n group by 1, 2),
r as (select user_id, block, count(*) as rows from b where not tot group by 1, 2),
l as (select user_id, block, code as block_code, won from g join r using (user_id, block) where won >= 0.7 * placed and (won >= 2 or rows = 1))
select user_id, event_id, cast(block as bigint) as block, block_code, case when block_code is not null and (code is null or inf and code <> block_code and won >= 4) then block_code else code end as placed,
  coalesce(block_code is not null and (code is null or inf and code <> block_code and won >= 4), false) as changed from b left join l using (user_id, block)""",
    "fact_redundancy": """
with x as (select *, case when l_linenumber % 2 = 0 then 'sheet' else 'text' end as format, l_linenumber % 2 = 0 or l_returnflag = 'A' as trusted from lineitem),
y as (select *, count(*) over (partition by l_partkey, l_suppkey, trusted) as n_sources, min(l_tax) over (partition by l_partkey, l_suppkey, trusted) <> max(l_tax) over (partition by l_partkey, l_suppkey, trusted) as conflict,
  row_number() over (partition by l_partkey, l_suppkey, trusted, l_tax order by format, l_orderkey, l_linenumber) as k from x)
select l_partkey, l_suppkey, trusted, l_tax, format, l_orderkey, n_sources, conflict from y where k = 1""",
    "vote_collapse": f"""
with e as (select user_id, event_type, {K} as k, event_id, case when event_id % 9 > 0 then ts end as seen, event_id % 3 as p from events),
v as (select user_id, event_type, k, count(*) as votes, min(p) as p, bool_or(event_id % 7 = 0) as checked, first(event_id order by p, seen desc nulls last, event_id) as event_id from e where k is not null group by 1, 2, 3),
w as (select *, row_number() over (partition by user_id, event_type order by votes desc, p, k) as i, count(*) over (partition by user_id, event_type) > 1 as disputed from v)
select user_id, event_type, k, event_id, votes, checked, disputed from w where i = 1""",
    "place_candidates": f"""
with g(name, state, population, kind) as (values {values(GAZETTEER)}), a(alias, name) as (values {values(PLACE_ALIASES)}),
c as (select c_custkey % 6 as k, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) as c from customer),
n as (select distinct case k when 0 then c || ' City Rural' when 1 then c || ' - Furniture' when 2 then 'Mach.' when 3 then 'North City' when 4 then c || ' & Unknown' else c end as name from c),
p as (select name, -1 as pos, name as part from n union all select name, unnest(range(len(regexp_split_to_array(name, ' *[-&] *')))) as pos, unnest(regexp_split_to_array(name, ' *[-&] *')) as part from n),
q as (select name, pos, regexp_extract({NORMAL.format('part')}, '^(.+?)(?: (?:{ENDS}))*$', 1) as key from p),
k as (select q.name, pos, coalesce(a.name, key) as key from q left join a on key = alias),
f as (select k.name, pos, state, population, kind from k join g on key = g.name where key not in ({LISTED(GENERIC)})),
w as (select * from f where pos = -1),
o as (select name, min(pos) as pos from f where pos >= 0 and name not in (select name from w) and name not in (select name from k where pos = -1 and key in ({LISTED(GENERIC)})) group by name having count(distinct state) = 1)
select name, state, population, kind from w union all select f.name, state, population, kind from f join o using (name, pos)""",
    "place_states": """
with p as (select p_brand || '-' || (p_partkey % 40) as name, split_part(p_type, ' ', 1) as state, p_size, p_partkey from part),
f as (select name, state, sum(p_size) as pop, case when min(p_size) % 2 = 0 then 'district' else 'city' end as kind from p group by 1, 2),
c as (select name, list(state order by pop desc, state) as s, list(pop order by pop desc, state) as q, count(*) filter (kind = 'district') as districts from f group by 1),
v as (select name, state, count(*) as n from p where p_partkey % 3 = 0 group by 1, 2),
t as (select name, first(state order by n desc, state) as top, max(n) as won, sum(n) as votes from v group by 1),
x as (select distinct name, case when length(name) % 2 = 0 then 2010 else 2020 end as year, ends_with(name, '1') as metro from p),
y as (select x.*, s, q, districts, case when votes >= 2 and won >= 0.8 * votes then top end as strong from x left join c using (name) left join t using (name)),
z as (select *, case when len(s) = 1 then case when strong is null or strong = s[1] then s[1] end
  when strong is not null and list_contains(s, strong) then strong when (metro or districts <= 1) and q[1] >= 3 * greatest(q[2], 1) then s[1] end as st from y)
select name, year, metro, case when st = 'SMALL' and year < 2014 then 'LARGE' else st end as state from z""",
    "news_ingest": """
with d as (select 'u' || (doc_id % 700) as url, md5(coalesce(text, '')) as title, source as summary, doc_id, lang, n_chars from documents),
k as (select url, min(doc_id) as doc_id from d where doc_id % 10 = 3 group by url),
n as (select *, row_number() over (partition by url order by doc_id desc) as i from d where lang in ('en', 'de') and url not in (select url from d where doc_id % 10 = 4) and url not in (select url from k))
select url, doc_id, 'old' as label, null as title, null as summary, null as hidden from k
union all select url, doc_id, 'l-' || lang, case when n_chars <= 2000 then title end, case when n_chars <= 2000 then summary end, n_chars > 2000 from n where i = 1""",
    "label_refinement": f"""
with e as (select event_id, event_type, coalesce({K}, 0) as k from events),
r as (select *, case when event_id % 6 = 0 then 0 when event_id % 10 = 0 and k = 13 then 0 when event_id % 4 in (0, 2) then 0 else 1 end as told, case event_type when 'purchase' then 'buy' when 'signup' then 'join' else event_type end as l from e)
select event_id, case when told = 1 and l in ({LISTED(EVENT_LABELS)}) then l else 'other' end as label, case when event_id % 6 = 0 or told = 1 and l in ({LISTED(EVENT_LABELS)}) then 'model' else 'rules' end as labeller, told = 1 and event_id % 5 = 0 as dropped from r""",
    "relabelled": "select event_id as url, case when event_id % 3 = 0 and event_id % 4 <> 0 then upper(event_type) else event_type end as label, case when event_id % 4 = 0 or event_id % 3 = 0 then 'model' else 'rules' end as labeller from events",
    "capture_index": r"""
with p as (select lpad(page_id::varchar, 14, '0') as stamp, coalesce(url, '') || case when page_id % 3 = 0 then '.xlsx' else '.html' end as url, page_id % 5 = 0 as gone, md5((page_id % 900)::varchar) as digest, case when page_id % 7 = 0 then 0 else length(coalesce(html, '')) end as bytes from pages),
q as (select *, row_number() over (partition by digest order by stamp, url) as i from p where not gone and regexp_matches(url, '(?i)\.xlsx?$|/en/') and not regexp_matches(url, '/9[0-9]*\.html$') and bytes <= 8000)
select url, stamp, digest, bytes from q where i = 1""",
    "documents_catalogue": f"""
with m as (select md5(coalesce(text, ''))[1:8] || case when doc_id % 2 = 0 then '.xlsx' else '.Doc' end as file, 'http://h/' || (doc_id % 300) as url, case when doc_id % 5 > 0 then '2020' || lpad((doc_id % 10000)::varchar, 10, '0') end as stamp, source as publisher from documents),
g as (select file, first(url order by coalesce(stamp, ''), url) as source_url, first(publisher order by coalesce(stamp, ''), url) as publisher, last(stamp order by coalesce(stamp, ''), url) as s, last(url order by coalesce(stamp, ''), url) as u, count(distinct url) as n_urls, min(stamp) as s0, max(stamp) as s1,
  case when file[1] in ('1', '2', '3') then count(*) else 0 end as n_facts from m group by file)
select file, lower(split_part(file, '.', -1)) as ext, publisher, source_url, '{ARCHIVE}' || s || '/' || u as permalink, s0[1:8] as first_capture, s1[1:8] as last_capture, n_urls, n_facts,
  case when file[1] in ('1', '2') then 'facts' when n_facts > 0 then 'facts_low_confidence' when ends_with(file, '.xlsx') then 'no_tables_found' else 'not_parsed' end as status from g""",
    "year_rules": f"""
with o as (select o_orderkey as k, year(o_orderdate)::varchar as y from orders),
u as (select k, case k % 6 when 0 then 'http://h/d/Orders of_' || y || '.XLSX' when 1 then 'http://h/1993-96/t_' || y || '-15.xls' when 2 then 'http://h/Lines 19.4.xlsx' when 3 then 'http://h/' || y || '/t.pdf' else 'http://h/t-' || y || '_x.pdf' end as url,
  case when k % 4 = 0 then 'Persons in ' || y when k % 4 = 1 then 'Years 1994 and 1995' else 'Persons' end as title, case when k % 10 = 0 then 'S ' || (y::int + 41) else 'S 1' end as sheet from o),
w as (select k, case when regexp_matches(lower(url), '\\.xlsx?$') then regexp_replace(regexp_extract(url, '[^/]*$'), '(19|20)[0-9][0-9] *[-_] *((19|20)?[0-9][0-9])', ' ', 'g') else '' end as name, url, title, sheet from u),
x as (select k, {ONE.format('name', 'name')} as a, {ONE.format('sheet', 'sheet')} as b, {ONE.format('title', 'title')} as c, {ONE.format('url', 'url')} as d from w),
z as (select k, coalesce(a, b, c, d) as year, case when a is not null then 'path' when b is not null then 'sheet' when c is not null then 'title' when d is not null then 'path' end as source from x)
select k as o_orderkey, case when year between 1950 and 2030 then year end as year, source from z""",
    "qualified_names": """
with p as (select p_partkey, p_size, p_partkey % 3 = 0 as q, array_to_string(list_transform(string_split(lower(p_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ') as big, p_name, p_type from part),
y as (select *, case when p_size % 5 = 0 then 2000 + p_size when p_size % 2 = 0 then 1950 + p_size % 50 else 1999 end as y from p)
select p_partkey, case when q then big else p_name end as name, case when q then p_type end as qualifier, case when y between 1950 and 2030 then y end as year from y""",
    "split_sink": f"""
with {FACTS_SQL}, p as (select case when value > 2000000 then 'trusted' else 'low' end as part, entity, year from facts union all select 'csv', entity, year from facts union all select distinct 'state', entity, 0 from facts)
select part, entity, count(*) as n, sum(year) as years from p group by 1, 2""",
    "new_files": "select n_nationkey, n_name from nation",
    "stale_files": """
with d as (select doc_id::varchar as file, doc_id % 3 = 0 as pdf, case when doc_id % 4 > 0 then doc_id % 4 end as v, n_chars from documents)
select file, n_chars from d where n_chars <= 100 or v is not distinct from case when pdf then 2 else 1 end""",
    "due_snapshots": "select distinct event_type || '@' || strftime(ts, '%Y%m%d') as key, event_type as feed, strftime(ts, '%Y%m%d') as stamp from events where strftime(ts, '%Y%m%d') >= '20240110'",
    "done_union": "select doc_id from documents where doc_id % 2 = 0 union select doc_id from documents where doc_id % 3 = 0",
    "undocumented_columns": """select * from (values ('nation', 'n_nationkey', 'undocumented'), ('nation', 'n_regionkey', 'undocumented'), ('labels', 'quality', 'undocumented'), ('labels', 'toxic', 'undocumented'), ('nation', 'n_comment', 'missing')) v("table", "column", problem)""",
    "named_sheets": """
with s as (select n_regionkey as file, case when n_regionkey % 3 = 0 or n_nationkey % 2 = 0 then 'Sheet' || n_nationkey else n_name end as sheet from nation)
select file, sheet from s where not starts_with(sheet, 'Sheet') or file not in (select file from s where not starts_with(sheet, 'Sheet'))""",
    "merged_cells": f"""
with {CELLS}, m as (select file, sheet, r, c, v_str from cells where v_str is not null),
s as (select file, sheet, r + i as r, c + j as c, min(v_str) as a from m, (values (0), (1)) x(i), (values (0), (1)) y(j) group by 1, 2, 3, 4),
o as (select file, sheet, r, c, case when v_num is null then coalesce(v_str, a) else v_str end as v_str, v_num from cells full join s using (file, sheet, r, c))
select * from o where v_str is not null or v_num is not null""",
    "without_empty_lines": f"""
with {CELLS} select file, sheet, dense_rank() over (partition by file, sheet order by r) - 1 as r, dense_rank() over (partition by file, sheet order by c) - 1 as c, v_str, v_num from cells where v_str is not null or v_num is not null""",
}
