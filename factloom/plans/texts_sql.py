"""DuckDB SQL for the queries of factloom.plans.texts."""

from __future__ import annotations

import difflib

from factloom.plans.facts import EV, FACTS_SQL
from factloom.plans.texts import ALIASES, KINDS, LABEL_RULES, PART_RULES, PHRASES, REGISTRY

NORMAL = "trim(regexp_replace(regexp_replace(lower(replace({}, '&', ' and ')), '[^a-z]+', ' ', 'g'), ' +', ' ', 'g'))"


def case(col: str, rules) -> str:
    return "case " + " ".join(f"when regexp_matches({col}, '{p}') then '{k}'" for k, p in rules)


def values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


LABELS = """lab as (select c_custkey, case when c_custkey % 50 = 0 then null when c_custkey % 7 = 0 then r_name || ' | Total' else r_name || ' | ' || n_name || ' | ' || c_mktsegment end as label
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"""
SKETCH = """sk as (select doc_id, lang, list_slice(list_sort(list_distinct(list_transform(regexp_extract_all(lower(coalesce(text, '')), '[a-z]{4,}'), lambda x: md5(x)[1:6]))), 1, 12) as s from documents)"""
PAIRS = SKETCH + """, tok as (select doc_id, lang, len(s) as n, unnest(s) as token from sk where len(s) > 0),
pairs as (select x.doc_id as a, y.doc_id as b, count(*) / least(any_value(x.n), any_value(y.n)) as overlap from tok x join tok y on x.lang is not distinct from y.lang and x.token = y.token and x.doc_id < y.doc_id group by 1, 2 having count(*) / least(any_value(x.n), any_value(y.n)) >= 0.4)"""
CLUSTERS = PAIRS.replace("sk as", "recursive sk as", 1) + """, e as (select a, b from pairs union all select b, a from pairs),
cc as (select doc_id as node, doc_id as root from documents union select e.b, cc.root from cc join e on e.a = cc.node where cc.root < e.b),
roots as (select node as doc_id, min(root) as root from cc group by 1)"""
#: the market segments, the closed list of the fuzzy match's names
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def closest(segment: str) -> str:
    """SQL literal of the code of the alias nearest to the misspelt segment, from a ratio of 0.88 on."""
    name = f"{segment[:3]}r{segment[3:]}".lower()
    ratio, code = max((difflib.SequenceMatcher(None, alias, name).ratio(), code) for alias, code in ALIASES)
    return f"'{code}'" if ratio >= 0.88 else "null"


HOST = "lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)', 1))"
#: fixed words of the greedy phrase match, longest first: each space is doubled so that neighbours do not share one
GREEDY = "|".join(p.replace(" ", "  ") for p in sorted(PHRASES, key=lambda p: (-len(p.split()), p)))

ORACLES = {
    "fuzzy_canonical": "select c_custkey, c_mktsegment[1:3] || 'r' || c_mktsegment[4:] as name, case c_mktsegment " + " ".join(f"when '{x}' then {closest(x)}" for x in SEGMENTS) + " end as code from customer",
    "first_match_rules": f"select p_partkey, {case('upper(p_type)', PART_RULES)} else 'other' end as rule from part",
    "leaf_first_rules": f"""with {LABELS}, seg as (select c_custkey, label, unnest(list_reverse(string_split(label, ' | '))) as s, generate_subscripts(string_split(label, ' | '), 1) as i from lab),
m as (select c_custkey, {case('s', LABEL_RULES)} end as k, s, i from seg), g as (select c_custkey, arg_min(k, i) filter (k is not null) as k, bool_or(s = 'Total') as total from m group by 1)
select lab.c_custkey, label, case when label is null then null else coalesce(k, case when total then 'total' end, 'other') end as category from lab left join g on lab.c_custkey = g.c_custkey""",
    "metric_precedence": """select p_partkey, coalesce(case regexp_extract(p_type, '([^ |]+)$', 1) when 'ECONOMY' then 'economy' when 'PROMO' then 'promotion' end, case when regexp_matches(p_type, 'SMALL|LARGE') then 'size' end, case when regexp_matches(p_name, 'red|blue') then 'colour' end, 'unknown') as metric from part""",
    "exact_canonical": f"with a(alias, code) as (values {values(ALIASES)}) select c_custkey, code from (select c_custkey, case when c_custkey % 4 = 0 then '  The-' || c_mktsegment else c_mktsegment end as name from customer) left join a on {NORMAL.format('name')} = {NORMAL.format('alias')}",
    "phrase_longest_match": f"""with c as (select conv_id, turn, {NORMAL.format('text')} as n from conversations)
select conv_id, turn, replace(array_to_string(regexp_extract_all(' ' || replace(n, ' ', '  ') || ' ', ' ({GREEDY}) ', 1), ','), '  ', ' ') as found from c""",
    "candidate_disambiguate": """with p as (select p_brand as name, p_type as state, p_size, p_partkey from part),
c as (select name, state, sum(p_size) as pop from p group by 1, 2), r as (select *, row_number() over (partition by name order by pop desc, state) as r, count(*) over (partition by name) as n from c),
v as (select name, case when p_partkey % 5 = 0 then 'SMALL' else 'PROMO' end as state, count(*) as n from p where p_partkey % 4 = 0 group by 1, 2),
w as (select name, state, n, row_number() over (partition by name order by n desc, state) as r, sum(n) over (partition by name) as tot from v),
top as (select name, state from w where r = 1 and tot >= 2 and n >= 0.8 * tot),
b as (select x.name, x.n as n_candidates, x.state as s1, x.pop as p1, y.pop as p2 from r x left join r y on x.name = y.name and y.r = 2 where x.r = 1)
select b.name, n_candidates, case when n_candidates = 1 then case when top.state is null or top.state = s1 then s1 end
  when exists (select 1 from c where c.name = b.name and c.state = top.state) then top.state when p1 >= 3 * greatest(coalesce(p2, 0), 1) then s1 end as state from b left join top on b.name = top.name""",
    "vote_evidence": """with u as (select c_nationkey as nation, c_mktsegment as label, 1 as w from customer union all select s_nationkey, case when s_acctbal > 5000 then 'BUILDING' else 'MACHINERY' end, 3 from supplier),
n as (select nation, label, sum(w) as n from u where label is not null group by 1, 2), r as (select *, row_number() over (partition by nation order by n desc, label) as r, sum(n) over (partition by nation) as votes from n)
select nation, label as winner, cast(n as bigint) as winner_votes, cast(votes as bigint) as votes from r where r = 1""",
    "suffix_host_join": f"""with g(suffix, publisher, priority) as (values {values(REGISTRY)}), p as (select page_id, {HOST} as host from pages),
m as (select p.*, publisher, row_number() over (partition by page_id order by priority) as r from p left join g on host = suffix or ends_with(host, '.' || suffix)) select page_id, host, coalesce(publisher, host) as publisher from m where r = 1""",
    "gazetteer_merge": """with e as (select c_mktsegment as name, c_nationkey as state, 'town' as kind, case when c_nationkey % 4 = 0 then 0 else cast(trunc(c_acctbal) as int) end as population, c_acctbal > 9000 as flag from customer
union all select 'BUILDING', s_nationkey, 'district', cast(trunc(s_acctbal) as int), false from supplier)
select name, state, coalesce(nullif(max(population) filter (kind = 'town'), 0), max(population) filter (kind = 'district')) as population, bool_or(flag) as flag from e group by 1, 2""",
    "sketch_tokens": f"with {SKETCH} select doc_id, array_to_string(s, ' ') as sketch from sk",
    "overlap_pairs": f"with {PAIRS} select a, b, round(overlap, 6) as overlap from pairs",
    "band_pairs": """with e as (select event_id, event_type, user_id, cast(ts as date) as d from events)
select least(x.event_id, y.event_id) as a, greatest(x.event_id, y.event_id) as b, y.d - x.d as days from e x join e y on x.event_type = y.event_type and x.user_id = y.user_id and (y.d - x.d = 1 or (y.d = x.d and x.event_id < y.event_id))""",
    "clusters": f"with {CLUSTERS} select doc_id, md5(cast(root as varchar))[1:12] as cluster_id from roots",
    "cluster_rollup": f"""with {CLUSTERS}, d as (select root, documents.doc_id, lang, 's' || (documents.doc_id % 4) as src from roots join documents using (doc_id)),
l as (select root, lang, row_number() over (partition by root order by count(*) desc, lang) as r from d where lang is not null group by root, lang),
g as (select root, min(doc_id) as first_doc, max(doc_id) as last_doc, count(*) as n, count(distinct src) as n_sources, array_to_string(list_sort(list(distinct src)), ', ') as sources from d group by root)
select md5(cast(g.root as varchar))[1:12] as cluster_id, first_doc, last_doc, lang, n, n_sources, sources from g left join l on g.root = l.root and r = 1""",
    "number_parse": "select o_orderkey, case o_orderkey % 5 when 0 then round(o_totalprice, 2) when 1 then cast(o_orderkey as double) when 4 then -cast(o_orderkey || '.5' as double) end as figure from orders",
    "clean_text": "select p_partkey, trim(regexp_replace(p_type, ' +', ' ', 'g')) as clean from part",
    "title_key": "select p_partkey, trim(regexp_replace(lower(p_type), '[^a-z]+', ' ', 'g')) as key from part",
    "head_key": """with k as (select p_partkey, trim(regexp_replace(lower(p_type), '[^a-z]+', ' ', 'g')) || case when p_size % 2 = 0 then ' total' else '' end as key from part)
select p_partkey, case key when 'standard polished tin' then 'polished tin' else key end as key from k""",
    "year_extract": """select o_orderkey, case when o_orderkey % 4 = 0 or o_orderkey % 3 = 0 then year(o_orderdate) end as year, case when o_orderkey % 4 = 0 then 'path' when o_orderkey % 3 = 0 then 'title' end as year_source from orders""",
    "rfc822_dates": "select event_id, case when event_id % 3 < 2 then cast(cast(ts as date) as varchar) end as day from events",
    "json_field": f"with {EV} select event_id, k from ev",
    "html_links": """with l as (select page_id, url, list_filter(regexp_extract_all(html, '(?i)(?:href|src)\\s*=\\s*["'']([^"'']+)["'']', 1), lambda x: not starts_with(x, '#')) as l from pages),
x as (select page_id, url, unnest(l) as link, unnest(range(len(l))) as pos from l)
select page_id, pos, link, case when regexp_matches(link, '^[a-zA-Z][a-zA-Z0-9+.-]*:') then regexp_replace(link, '#.*$', '') when starts_with(link, '//') then regexp_extract(url, '^([a-zA-Z]+:)', 1) || regexp_replace(link, '#.*$', '')
  when starts_with(link, '/') then regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1) || regexp_replace(link, '#.*$', '')
  else coalesce(nullif(regexp_extract(regexp_replace(url, '[?#].*$', '') || '/', '^([a-zA-Z]+://[^/?#]+/(?:.*/)?)[^/]*/$', 1), ''), regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1) || '/') || regexp_replace(link, '#.*$', '') end as target from x""",
    "html_title": "select page_id, nullif(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '') as title from pages",
    "strip_tags": """with a as (select page_id, regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?s)<[^>]+>', ' ', 'g') as x from pages),
b as (select page_id, replace(replace(replace(replace(replace(x, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') as x from a) select page_id, md5(trim(regexp_replace(x, '[ \\t\\r\\n\\f\\v]+', ' ', 'g'))) as plain_md5 from b""",
    "crawl_frontier": """with l as (select distinct url, unnest(list_filter(regexp_extract_all(html, '(?i)(?:href|src)\\s*=\\s*["'']([^"'']+)["'']', 1), lambda x: not starts_with(x, '#'))) as link from pages),
a as (select distinct regexp_replace(case when regexp_matches(link, '^[a-zA-Z][a-zA-Z0-9+.-]*:') then link when starts_with(link, '//') then regexp_extract(url, '^([a-zA-Z]+:)', 1) || link
  when starts_with(link, '/') then regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1) || link
  else coalesce(nullif(regexp_extract(regexp_replace(url, '[?#].*$', '') || '/', '^([a-zA-Z]+://[^/?#]+/(?:.*/)?)[^/]*/$', 1), ''), regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1) || '/') || link end, '[?#].*$', '') as target from l),
n as (select target, lower(regexp_extract(target, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)', 1)) as host, case when regexp_matches(target, '(?i)\\.(xlsx?|pdf|csv)$') then -1 when regexp_matches(target, '(?i)th') then 1 else 2 end as priority from a
  where target not in (select regexp_replace(url, '[?#].*$', '') from pages where url is not null)),
r as (select *, row_number() over (partition by host order by priority, target) as rank from n) select host, target, priority, cast(rank as int) as rank from r where rank <= 150""",
    "content_ledger": """with d as (select doc_id, coalesce(text, '') as x from documents), g as (select sha256(x)[1:16] as file, count(*) as n_docs, min(doc_id) as first_key, bool_or(length(x) = 0) as e from d group by 1)
select file, n_docs, first_key, case when e then 'empty' when n_docs > 1 then 'shared' else 'single' end as status from g""",
    "repair_plan": """with m as (select sha256(coalesce(text, ''))[1:16] as file, 'http://h/' || doc_id as url, doc_id % 3 = 0 as cap from documents), x as (select * from m where file[1:1] not in ('0', '1', '2', '3', '4', 'a')),
r as (select *, row_number() over (partition by file order by not cap, url) as r, count(*) over (partition by file) as n_urls, bool_or(cap) over (partition by file) as captured from x) select file, url, captured, n_urls from r where r = 1""",
    "privacy_mask": "select doc_id, case when coalesce(toxic, 0) = 0 then md5(text) end as shown from documents left join labels using (doc_id)",
    "validated_labels": f"""with {EV}, p as (select event_id, case when k % 3 = 0 then upper(event_type) else event_type end as kind from ev), c as (select event_id, kind, kind in ({", ".join(f"'{k}'" for k in KINDS)}) as ok from p)
select event_id, case when ok then kind else 'other' end as label, ok as accepted from c""",
    "profile_counts": "select event_type, count(*) as n, count(value) as n_value, count(distinct user_id) as users, round(avg(cast(value > 50 as int)), 6) as share from events group by 1",
    "profile_pivot": "select lang, count(*) filter (n_chars < 1000) as short, count(*) filter (n_chars >= 1000 or n_chars is null) as long from documents group by 1",
    "profile_coverage": "select lang, count(*) as n, count(quality) as labelled, min(n_chars) as least, max(n_chars) as most, round(avg(cast(quality is not null as int)), 6) as share from documents left join labels using (doc_id) group by 1",
    "top_gaps": "select source, count(*) as n from documents where doc_id not in (select doc_id from labels) group by 1 order by n desc, source limit 10",
    "share_of_year": f"with {FACTS_SQL} select year, entity, round(value / sum(value) over (partition by year), 8) as share from facts",
    "publisher_bundles": "select sha256(coalesce(text, ''))[1:1] as shard, count(*) as n, cast(sum(n_chars) as bigint) as chars from documents group by 1",
    "feed_items": "select page_id, 'A & B' || page_id as title, regexp_replace(url, '[?#].*$', '') as url, '2024-03-' || lpad(cast(page_id % 28 + 1 as varchar), 2, '0') as published, 'x y' as summary from pages",
    "text_table_rows": f"with {FACTS_SQL} select year, translate(entity, '0123456789_', 'abcdefghij ') as name, trim(format('{{:,}}', cast(floor(value / 1000) as bigint))) || '|NA' as figures from facts",
    "sheet_facts": f"with {FACTS_SQL} select region as sheet, 'Value of orders by nation' as title, entity, case when year = 1995 then 'Orders | Y1995' else 'Orders | Y' || year end as label, round(value, 2) as value from facts",
    "stream_dedupe": "select distinct user_id, event_type from events",
    "stream_tumbling": "select strftime(date_trunc('day', ts), '%Y-%m-%d') as day, event_type, count(*) as n, round(cast(sum(cast(value as decimal(18,4))) as double), 4) as v from events group by 1, 2",
    "stream_session": """with s as (select *, case when lag(ts) over (partition by user_id order by ts) is null or ts - lag(ts) over (partition by user_id order by ts) >= interval 1 hour then 1 else 0 end as c from events),
r as (select *, sum(c) over (partition by user_id order by ts rows unbounded preceding) as k from s) select user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') as start, count(*) as n from r group by user_id, k""",
}
