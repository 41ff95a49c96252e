"""Queries on mentions of names and the places of headlines, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.functions.text import normal_name
from factloom.operators import mentions, places
from factloom.plans.facts import t

GENERIC, FEED_WORDS, QUALIFIERS, SHORT = ["hot gear"], ["rss", "news", "xml", "x"], ["city", "rural"], {"XA": "a", "X&B": "b"}


def benchmark_names(spark, sf_dir):
    """All runs of one to three words of the benchmark's items as names."""
    words = t(spark, sf_dir, "benchmark").select(F.split(normal_name(F.col("text")), " ").alias("w")).filter("w[0] <> ''")
    grams = F.flatten(F.transform(F.array(*map(F.lit, (1, 2, 3))), lambda n: F.transform(F.filter(F.sequence(F.lit(1), F.size("w")), lambda i: i + n - 1 <= F.size("w")), lambda i: F.array_join(F.slice("w", i, n), " "))))
    n = words.select(F.explode(grams).alias("name")).distinct()
    state = F.length("name") % 5 == 0
    return n.select("name", F.when(state, "state").otherwise("place").alias("kind"), F.when(state, F.substring("name", 1, 2)).alias("state"), (F.length("name") < 6).alias("weak"))


def name_mentions(spark, sf_dir):
    """Every second document in lower case, so that its words need not be capitalised."""
    d = t(spark, sf_dir, "documents").select(F.lit("document").alias("src"), F.col("doc_id").alias("id"), F.lit(0).cast("long").alias("turn"), F.when(F.col("doc_id") % 2 == 0, F.lower("text")).otherwise(F.col("text")).alias("text"))
    c = t(spark, sf_dir, "conversations").select(F.lit("conversation").alias("src"), F.col("conv_id").alias("id"), "turn", "text")
    return mentions.mentions(d.unionByName(c), ["src", "id", "turn"], "text", benchmark_names(spark, sf_dir))


def _world(spark, sf_dir):
    states = t(spark, sf_dir, "nation").select(F.translate("n_name", "_0123456789", " abcdefghij").alias("alias"), F.concat(F.lit("n"), "n_nationkey").alias("code"))
    p = t(spark, sf_dir, "part")
    key = F.when(F.col("p_size") % 3 == 0, F.length("p_name") % 25).otherwise(F.ascii("p_name") % 25)
    gazetteer = p.groupBy(normal_name(F.col("p_name")).alias("name"), F.concat(F.lit("n"), key).alias("state")).agg(F.sum("p_size").cast("long").alias("population"), F.when(F.min("p_size") % 2 == 0, "district").otherwise("city").alias("kind"))
    aliases = p.groupBy(F.regexp_extract("p_name", "([a-z]+)$", 1).alias("alias")).agg(F.min("p_name").alias("name")).filter("alias <> ''")
    return states, gazetteer, aliases


def headlines(spark, sf_dir):
    c, n, p = t(spark, sf_dir, "customer"), t(spark, sf_dir, "nation"), t(spark, sf_dir, "part").select("p_partkey", "p_name")
    d = c.join(n, c.c_nationkey == n.n_nationkey).join(p.select(F.col("p_partkey").alias("c_custkey"), F.col("p_name").alias("a")), "c_custkey", "left") \
        .join(p.select((F.col("p_partkey") - 1).alias("c_custkey"), F.col("p_name").alias("b")), "c_custkey", "left")
    a, b, state, k = F.upper("a"), F.upper("b"), F.translate("n_name", "_0123456789", " ABCDEFGHIJ"), F.col("c_custkey") % 8
    title = F.when(k == 0, F.concat(a, F.lit(": two held after raid"))).when(k == 1, F.concat(F.lit("Man from "), a, F.lit(" held in "), b)).when(k == 2, F.concat(F.lit("Raid near "), state, F.lit(", "), a, F.lit(" man flees"))) \
        .when(k == 3, F.concat(F.lit("fire at "), F.col("a"))).when(k == 4, "No name here").when(k == 5, F.concat(a, F.lit(" wins "), b, F.lit(" as "), state, F.lit(" looks on"))) \
        .when(k == 6, F.concat(F.lit("Two die in "), F.upper(F.regexp_extract("a", "([a-z]+)$", 1)), F.lit(", XA says")))
    feed = F.concat(F.lit("https://feeds.example/rss/"), F.when(F.col("c_custkey") % 5 == 0, F.replace(F.lower(state), F.lit(" "), F.lit("-"))).otherwise(F.replace(F.col("b"), F.lit(" "), F.lit("-"))), F.lit("-news/x.xml"))
    return d.select("c_custkey", title.alias("title"), feed.alias("feed"))


def headline_places(spark, sf_dir):
    states, gazetteer, aliases = _world(spark, sf_dir)
    h = headlines(spark, sf_dir)
    found = mentions.mentions(h, ["c_custkey"], "title", mentions.names_table(states, gazetteer, aliases, GENERIC, ["ring"], 500), SHORT)
    look = lambda n: places.candidates(n, gazetteer, aliases, GENERIC, QUALIFIERS)
    return mentions.locate(h, ["c_custkey"], "title", found, states, look, "feed", FEED_WORDS)


QUERIES = {f.__name__: f for f in (name_mentions, headline_places)}


def scan_sql(texts: str, keys: str, names: str, longest: int) -> str:
    """CTEs up to ``taken`` (keys, start, stop, name, kind, state, weak): the greedy scan over CTE ``texts``, with CTE ``names``."""
    grams = " union all ".join(
        f"select {keys}, i, {n} as n, start, {'stop' if n == 1 else f'e{n - 1}'} as stop, lower(word{''.join(f' || chr(32) || w{k}' for k in range(1, n))}) as name from j where {'true' if n == 1 else f'w{n - 1} is not null'} and (loose or regexp_full_match(word[1]{''.join(f' || w{k}[1]' for k in range(1, n))}, '[A-Z]+'))"
        for n in range(1, longest + 1))
    return rf"""
t as (select {keys}, text = lower(text) or (text = upper(text) and text <> lower(text)) as loose, regexp_extract_all(text, '[A-Za-z]+') as w, string_split_regex(text, '[A-Za-z]+') as g from {texts} where text is not null),
e as (select {keys}, loose, unnest(w) as word, unnest(g[:len(w)]) as gap, unnest(range(len(w))) as i from t where len(w) > 0),
s as (select *, (sum(length(gap) + length(word)) over (partition by {keys} order by i))::int as stop from e),
j as (select *, stop - length(word)::int as start, {', '.join(f'lead(word, {k}) over x as w{k}, lead(stop, {k}) over x as e{k}' for k in range(1, longest))}, lead(gap) over x as next_gap from s window x as (partition by {keys} order by i)),
gr as ({grams}),
hit as (select {keys}, i, arg_max({{'i': i, 'n': n, 'start': start, 'stop': stop, 'name': name, 'kind': kind, 'state': state, 'weak': weak}}, n) as m from gr join {names} using (name) group by {keys}, i),
lists as (select {keys}, list(m order by i) as ms from hit group by {keys}),
taken as (select {keys}, unnest(list_reduce(ms, lambda a, x: case when x.i >= a.free then {{'free': x.i + x.n, 'f': list_append(a.f, x)}} else a end, {{'free': 0::bigint, 'f': ms[:0]}}).f, recursive := false) as m from lists),
tk as (select {keys}, m.start as start, m.stop as stop, m.name as name, m.kind as kind, m.state as state, m.weak as weak from taken)"""


NORMAL = "trim(regexp_replace(regexp_replace(lower(replace({}, '&', ' and ')), '[^a-z]+', ' ', 'g'), ' +', ' ', 'g'))"
STATE = "translate(n_name, '_0123456789', ' abcdefghij')"
ORACLES = {
    "name_mentions": rf"""with bw as (select string_split({NORMAL.format('text')}, ' ') as w from benchmark), bn as (select distinct unnest(flatten(list_transform([1, 2, 3], lambda n: list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i : i + n - 1], ' '))))) as name from bw where w[1] <> ''),
names as (select name, case when length(name) % 5 = 0 then 'state' else 'place' end as kind, case when length(name) % 5 = 0 then name[1:2] end as state, length(name) < 6 as weak from bn),
x as (select 'document' as src, doc_id as id, 0::bigint as turn, case when doc_id % 2 = 0 then lower(text) else text end as text from documents union all select 'conversation', conv_id, turn, text from conversations),
{scan_sql('x', 'src, id, turn', 'names', 4)}
select src, id, turn, start, stop as "end", substr(text, start + 1, stop - start) as mention, kind, state, weak from tk join x using (src, id, turn)""",
    "headline_places": rf"""with st as (select {STATE} as alias, 'n' || n_nationkey as code from nation), sn as (select {NORMAL.format('alias')} as name, min(code) as state from st group by 1),
gz as (select {NORMAL.format('p_name')} as name, 'n' || (case when p_size % 3 = 0 then length(p_name) % 25 else ascii(p_name) % 25 end) as state, sum(p_size) as population, case when min(p_size) % 2 = 0 then 'district' else 'city' end as kind from part group by 1, 2),
al as (select * from (select regexp_extract(p_name, '([a-z]+)$', 1) as alias, min(p_name) as name from part group by 1) where alias <> ''),
gm as (select name, max(population) as most, bool_or(kind = 'district') as district from gz group by 1),
gn as (select name, max(most) as most, bool_or(district) as district from (select * from gm union all select alias, most, district from al join gm using (name)) group by 1),
names as (select name, 'state' as kind, state, false as weak from sn union all
  select name, 'place', null, not contains(name, ' ') and (name = 'ring' or (most < 500 and not district)) from gn where name <> 'hot gear' and name not in (select name from sn)),
hh as (select c_custkey, n_name, a.p_name as a, b.p_name as b from customer join nation on c_nationkey = n_nationkey left join part a on a.p_partkey = c_custkey left join part b on b.p_partkey - 1 = c_custkey),
h as (select c_custkey, case c_custkey % 8 when 0 then upper(a) || ': two held after raid' when 1 then 'Man from ' || upper(a) || ' held in ' || upper(b) when 2 then 'Raid near ' || upper({STATE}) || ', ' || upper(a) || ' man flees'
  when 3 then 'fire at ' || a when 4 then 'No name here' when 5 then upper(a) || ' wins ' || upper(b) || ' as ' || upper({STATE}) || ' looks on' when 6 then 'Two die in ' || upper(regexp_extract(a, '([a-z]+)$', 1)) || ', XA says' end as text,
  'https://feeds.example/rss/' || case when c_custkey % 5 = 0 then replace({STATE.replace('n_name', 'lower(n_name)')}, ' ', '-') else replace(b, ' ', '-') end || '-news/x.xml' as feed from hh),
{scan_sql('h', 'c_custkey', 'names', 4)},
ab as (select c_custkey, start, stop, word as name, 'state' as kind, 'a' as state, false as weak from j where word = 'XA' and not regexp_matches(gap, '[0-9_]$') and not regexp_matches(coalesce(next_gap, ''), '^[0-9_]')
  union all select c_custkey, start, e1, 'x&b', 'state', 'b', false from j where word = 'X' and w1 = 'B' and regexp_full_match(next_gap, ' ?& ?') and not regexp_matches(gap, '[0-9_]$')),
m as (select tk.*, text from (select * from tk union all select * from ab) tk join h using (c_custkey)),
v as (select c_custkey, state, count(*) as n from m where kind = 'state' group by all),
vt as (select c_custkey, arg_min(state, (-n, state)) as top, max(n) as top_n, sum(n) as votes from v group by 1),
nm as (select distinct name, coalesce((select al.name from al where al.alias = m.name), name) as key from m where kind = 'place'),
ca as (select nm.name, list({{'p': -population, 's': state, 'k': kind}} order by -population, state) as c, count(*) filter (kind = 'district') as districts from nm join gz on gz.name = nm.key where nm.key <> 'hot gear' group by 1),
rs as (select m.*, c, case when len(c) = 1 then c[1].s when len(c) > 1 then case when top_n >= 0.8 * votes and list_contains(list_transform(c, lambda z: z.s), top) then top when districts <= 1 and -c[1].p >= 3 * greatest(-c[2].p, 1) then c[1].s end end as place_state,
  case when regexp_matches(substr(text, stop + 1), '^\s*:') and start < 40 then 0 when regexp_matches(substr(text, 1, start), '(?i)(^|\s)(in|at|near|outside|inside)\s*$') then 1 else 2 end as way from m left join ca using (name) left join vt using (c_custkey)),
ok as (select *, case when kind = 'state' then state else place_state end as said from rs where kind = 'state' or not weak or way < 2),
best as (select c_custkey, arg_min({{'state': said, 'place': case when kind = 'place' then substr(text, start + 1, stop - start) end, 'district': case when list_contains(list_transform(c, lambda z: z.s || z.k), said || 'district') and kind = 'place' then substr(text, start + 1, stop - start) end}}, (way, start)) as b from ok where said is not null group by 1),
fw as (select distinct feed, list_filter(regexp_extract_all(lower(regexp_extract(feed, '^https://[^/?#]*([^?#]*)', 1)), '[a-z]+'), lambda x: x not in ('rss', 'news', 'xml', 'x')) as w from h where feed is not null),
sp as (select feed, n, k, w[k : k + n - 1] as s from (select *, unnest(range(1, len(w) - n + 2)) as k from fw, (select unnest([1, 2, 3]) as n))),
inn as (select feed, n, k, j, q, array_to_string(s[j : j + q - 1], ' ') as name from (select *, unnest(range(1, len(s) - q + 2)) as j from sp, (select unnest([1, 2, 3]) as q))),
bs as (select feed, n, k, arg_min(state, (j, -q)) as named from inn join sn using (name) group by all),
fk as (select feed, n, k, array_to_string(s, ' ') as name, coalesce((select al.name from al where al.alias = array_to_string(s, ' ')), array_to_string(s, ' ')) as key from sp),
fc as (select feed, n, k, list({{'p': -population, 's': state, 'k': kind}} order by -population, state) as c, count(*) filter (kind = 'district') as districts from fk join gz on gz.name = fk.key where key <> 'hot gear' group by all),
fs as (select sp.feed, sp.n, sp.k, coalesce(named, case when len(c) = 1 then c[1].s when len(c) > 1 and districts <= 1 and -c[1].p >= 3 * greatest(-c[2].p, 1) then c[1].s end) as state from sp left join bs using (feed, n, k) left join fc using (feed, n, k)),
ff as (select feed, arg_min(state, (-n, k)) as feed_state from fs where state is not null group by 1)
select h.c_custkey, coalesce(b.state, feed_state) as state, b.place as place, b.district as district, case when b is not null then 'headline' when feed_state is not null then 'feed' end as basis from h left join best using (c_custkey) left join ff using (feed)""",
}
