"""The thin queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.llm import language, packing, toxicity
from factloom.llm.collocations import collocations
from factloom.llm.common import crc32_mod, table
from factloom.llm.decontaminate import contaminated
from factloom.llm.divergence import divergence
from factloom.llm.exact_dedup import exact_dedup
from factloom.llm.lm import lm_scores
from factloom.llm.ngram_join import jaccard_components
from factloom.llm.suffix_dedup import suffix_dedup
from factloom.llm.token_file import read_tokens, write_tokens
from factloom.llm.url_filter import judge_urls, rule_table
from factloom.llm.warc import archive_and_read

URL_RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]


def fold(n: int, held: int):
    """Whether a row's doc_id is in the held-out fold; a row without id is not."""
    return F.coalesce(crc32_mod("doc_id", n) == held, F.lit(False))


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    profiles = language.fit(docs.filter(~fold(5, 0)).select("doc_id", "text", "lang"))
    return language.classify(docs, profiles, extra={"held_out": fold(5, 0)})


def op2_decontamination(spark, sf_dir):
    # without the distance of the fingerprints, which depends on the engine's hash function
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("hamming")


def op3_warc(spark, sf_dir):
    return archive_and_read(table(spark, sf_dir, "pages"))


def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), train=~fold(3, 1))
    return toxicity.score(docs, model, extra={"held_out": fold(3, 1)})


def op5_suffix_dedup(spark, sf_dir):
    return suffix_dedup(table(spark, sf_dir, "documents"))


def op6_url_filter(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages"), rule_table(spark, URL_RULES))


def op7_token_ids(spark, sf_dir):
    return read_tokens(spark, write_tokens(table(spark, sf_dir, "documents"), tokenizer()))


def op8_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer())


def op9_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"), keep="max")


def op10_ngram_join(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents"), k=3, num=90, den=100)


def op11_lm_scores(spark, sf_dir):
    return lm_scores(table(spark, sf_dir, "documents"), held_out=fold(5, 1))


def op12_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark, sf_dir):
    return divergence(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_language_id, op2_decontamination, op3_warc, op4_toxicity, op5_suffix_dedup, op6_url_filter, op7_token_ids, op8_packing, op9_exact_dedup, op10_ngram_join,
                                   op11_lm_scores, op12_collocations, op13_source_divergence)}

ORACLES = {
    # every window that begins at a shingle of an item of its size, compared with every item of that size
    "op2_decontamination": r"""
with i as (select distinct item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w from benchmark),
it as (select item_id, least(len(w), 5) as k, list_transform(range(1, len(w) - least(len(w), 5) + 2), lambda j: array_to_string(w[j : j + least(len(w), 5) - 1], ' ')) as s from i where len(w) > 0),
d as (select distinct doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w from documents),
dk as (select doc_id, w, k, row_number() over () as r from d, (select distinct k from it) where len(w) >= k),
p as (select r, doc_id, k, unnest(range(len(w) - k + 1)) as pos, unnest(list_transform(range(1, len(w) - k + 2), lambda j: array_to_string(w[j : j + k - 1], ' '))) as h from dk),
st as (select distinct k, len(s) as n, unnest(s) as h from it),
a as (select r, doc_id, k, n, pos as start from p join st using (k, h)),
c as (select a.r, doc_id, k, n, start, p.h, count(*) as c from a join p using (r, doc_id, k) where p.pos between start and start + n - 1 group by all),
z as (select r, k, n, start, sum(c) as size from c group by all),
ic as (select item_id, k, len(s) as n, unnest(s) as h from it),
ig as (select item_id, k, n, h, count(*) as c from ic group by all),
b as (select r, doc_id, c.k, n, start, item_id, sum(least(c.c, ig.c)) as common from c join ig using (k, n, h) group by all),
s as (select doc_id, item_id, start, n, common / (size + n - common) as similarity from b join z using (r, k, n, start) where common / (size + n - common) >= 0.8),
o as (select *, row_number() over (partition by doc_id, item_id order by similarity desc, start) as rank from s)
select doc_id, item_id, start::int as window_start, n::int as window_shingles, similarity from o where rank = 1""",
    "op3_warc": r"""
with t as (select page_id, url, coalesce(html, '') as p from pages),
f as (select p, min(page_id) as first from t where strlen(p) >= 100 group by p),
j as (select t.*, case when first < page_id then first end as refers_to from t left join f using (p))
select page_id, strlen(p) as payload_bytes, sha256(p) as payload_digest, case when refers_to is null then 'response' else 'revisit' end as record_type, refers_to, url from j""",
    # every 100-byte window as hex digits, cut out of overlapping chunks of the text
    "op5_suffix_dedup": r"""
with t as (select doc_id, hex(encode(coalesce(text, ''))) as x, strlen(coalesce(text, '')) as n from documents),
c as (select doc_id, n, unnest(range(0, n - 99, 128)) as lo, unnest(list_transform(range(0, n - 99, 128), lambda i: x[2 * i + 1 : 2 * i + 454])) as y from t where n >= 100),
b as (select doc_id, lo, y, unnest(range(least(128, n - 99 - lo))) as i from c),
w as (select doc_id, lo + i as s, md5_number(y[2 * i + 1 : 2 * i + 200]) as m from b),
f as (select m, min((doc_id, s)) as first from w group by m having count(*) > 1),
r as (select w.doc_id, s from w join f using (m) where (w.doc_id, s) > first),
o as (select doc_id, s, case when s <= lag(s) over (partition by doc_id order by s) + 100 then 0 else 1 end as new from r),
g as (select doc_id, s, sum(new) over (partition by doc_id order by s) as run from o),
p as (select doc_id, run, min(s) as a, max(s) + 100 as z from g group by doc_id, run),
k as (select doc_id, a, z, coalesce(lag(z) over (partition by doc_id order by a), 0) as before from p),
j as (select doc_id, count(*) as n_spans, sum(z - a) as n_removed, max(z) as last, list((before, a) order by a) as kept from k group by doc_id)
select doc_id, n as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(case when last is null then x else list_aggregate(list_transform(kept, lambda q: x[2 * q[1] + 1 : 2 * q[2]]), 'string_agg', '') || x[2 * last + 1 :] end)) as kept_sha256
from t left join j using (doc_id)""",
    "op6_url_filter": r"""
with u as (select page_id, strpos(url, '://') as pos, url from pages),
p as (select page_id, case when coalesce(pos, 0) = 0 then '' else substr(url, pos + 3) end as rest from u),
h as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from p),
r(rank, action, rhost, rpath) as (values (0, 'block', 'com', '/en/'), (1, 'allow', 'example.com', '/en/7'), (2, 'allow', 'net', '/de/'), (3, 'block', 'example.net', '/de/8'), (4, 'block', 'org', '/es/')),
m as (select h.*, action, rhost || rpath as rule, row_number() over (partition by page_id order by length(rhost || rpath) desc nulls last, rank) as k
      from h left join r on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath))
select page_id, host, path, rule, coalesce(action, 'allow') as verdict from m where k = 1""",
    "op9_exact_dedup": r"""
with t as (select doc_id, coalesce(text, '') as text from documents),
g as (select text, max(doc_id) as keep_id, count(*) as group_size from t group by text)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(text) as text_sha256 from t join g using (text)""",
    "op10_ngram_join": r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select doc_id, case when len(w) >= 3 then list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s from w),
t as (select doc_id, len(s) as n, unnest(s) as x from s),
l as (select a.doc_id as a, b.doc_id as b from t a join t b on a.x = b.x and a.doc_id < b.doc_id group by a.doc_id, b.doc_id having 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))),
e as (select a, b from l union all select b, a from l),
c as (select doc_id as node, doc_id as root from documents union select e.b, c.root from c join e on e.a = c.node where c.root < e.b),
r as (select node, min(root) as root from c group by node)
select s.doc_id, len(s) as n_shingles, root as component_id from s left join r on s.doc_id = r.node""",
    "op12_collocations": r"""
with d as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
p as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from d),
t as (select lang, sum(len(w))::bigint as n from p group by lang),
g as (select lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i : i + size - 1], ' '))) as phrase from p, (select unnest(range(1, 5)) as size) where len(w) >= size),
f as (select lang, phrase, size, count(*) as a from g group by all having count(*) >= 30),
c as (select *, string_split(phrase, ' ') as w, unnest(range(1, size)) as k from f where size > 1),
s as (select c.lang, c.phrase, c.a, k, l.a as l, r.a as r, ((2000000::hugeint * c.a) // (l.a + r.a))::bigint as score
      from c join f l on l.lang = c.lang and l.phrase = array_to_string(w[:k], ' ') join f r on r.lang = c.lang and r.phrase = array_to_string(w[k + 1 :], ' ')),
b as (select *, row_number() over (partition by lang, phrase order by score, k) as o from s),
x as (select *, string_split(phrase, ' ') as w, unnest(range(2, size)) as m from f where size > 2),
y as (select lang, a, unnest(list_transform(range(1, size - m + 2), lambda i: array_to_string(w[i : i + m - 1], ' '))) as phrase from x),
z as (select lang, phrase, max(a) as longer from y group by all),
k as (select b.*, row_number() over (partition by b.lang order by score desc, b.a desc, encode(b.phrase)) as rank from b left join z on z.lang = b.lang and z.phrase = b.phrase where o = 1 and (longer is null or 100::hugeint * longer < 80::hugeint * b.a))
select lang, rank, phrase, a, l, r, n, score from k join t using (lang) where rank <= 2000""",
    "op13_source_divergence": r"""
with d as (select coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as r,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
t as (select lang, source, r, unnest(w) as term from d),
k as (select lang, term, count(*) as all_n from t group by lang, term having count(distinct r) >= 3),
g as (select distinct lang, source from d),
c as (select lang, source, term, count(*) as n from t group by all),
m as (select g.lang, g.source, k.term, all_n, coalesce(c.n, 0) as n from g join k using (lang) left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
s as (select *, sum(n) over w as total, sum(all_n) over w as lang_total, count(*) over w as v from m window w as (partition by lang, source)),
p as (select lang, source, term, n, (1 + 1000000000::hugeint * (n + 1) // (total + v))::bigint as p, (1 + 1000000000::hugeint * (all_n + 1) // (lang_total + v))::bigint as q from s),
f as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
o as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value from g a join g b on a.lang = b.lang and a.source <> b.source
      left join f on f.lang = a.lang and f.source = a.source and f.item = b.source
      union all select lang, source, 'term', term, (p - q) * (p - q) // q from p where n > 0 and p > q),
r as (select *, row_number() over (partition by lang, source, part order by value desc, encode(item))::int as rank from o)
select * from r where part = 'pair' or rank <= 200""",
}
