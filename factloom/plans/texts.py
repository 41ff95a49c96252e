"""Queries over texts, names, pages and events: parsing, classification, resolution, similarity, profile, streams."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from factloom.functions import classify, text
from factloom.operators import grid, reconcile, resolve, similarity
from factloom.plans.facts import ev, order_facts, t, with_k
from factloom.sources import readers, store
from factloom.streaming import events as streams

PART_RULES = [("cheap", "ECONOMY|PROMO"), ("small", "SMALL"), ("large", "LARGE|MEDIUM")]
LABEL_RULES = [("machinery", "MACHINERY|AUTOMOBILE"), ("home", "HOUSEHOLD|FURNITURE"), ("asia", "ASIA")]
ALIASES = [("building", "B"), ("automobile", "A"), ("machinery", "M"), ("house hold", "H"), ("furniture & fittings", "F")]
PHRASES = ["of the", "in the", "the", "and the", "on the", "that of the", "to the", "is the", "of", "and", "in", "by the"]
REGISTRY = [("example.com", "Example Post", 1), ("example.net", "Example Net", 2), ("net", "Any Net", 9), ("example.org", "Example Org", 3)]
KINDS = ["click", "view", "purchase"]


def first_match_rules(spark, sf_dir):
    return t(spark, sf_dir, "part").select("p_partkey", classify.first_match(F.upper("p_type"), PART_RULES, "other").alias("rule"))


def label_of_customers(spark, sf_dir):
    c, n, r = t(spark, sf_dir, "customer"), t(spark, sf_dir, "nation"), t(spark, sf_dir, "region")
    d = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    return d.select("c_custkey", F.when(F.col("c_custkey") % 50 == 0, None).when(F.col("c_custkey") % 7 == 0, F.concat_ws(" | ", "r_name", F.lit("Total"))).otherwise(F.concat_ws(" | ", "r_name", "n_name", "c_mktsegment")).alias("label"))


def leaf_first_rules(spark, sf_dir):
    return label_of_customers(spark, sf_dir).select("c_custkey", "label", classify.leaf_first(F.col("label"), LABEL_RULES, "^Total$").alias("category"))


def metric_precedence(spark, sf_dir):
    p = t(spark, sf_dir, "part")
    m = classify.by_precedence(F.col("p_type"), F.col("p_name"), {"ECONOMY": "economy", "PROMO": "promotion"}, [("size", "SMALL|LARGE")], [("colour", "red|blue")])
    return p.select("p_partkey", m.alias("metric"))


def exact_canonical(spark, sf_dir):
    look = spark.createDataFrame(ALIASES, "alias string, code string")
    names = t(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("  The-"), "c_mktsegment")).otherwise(F.initcap("c_mktsegment")).alias("name"))
    return resolve.canonical(names, "name", F.broadcast(look)).select("c_custkey", "code")


def fuzzy_canonical(spark, sf_dir):
    n = t(spark, sf_dir, "customer").select("c_custkey", F.concat(F.substring("c_mktsegment", 1, 3), F.lit("r"), F.expr("substr(c_mktsegment, 4)")).alias("name"))
    return resolve.fuzzy(n, "name", ALIASES).select("c_custkey", "name", "code")


def phrase_longest_match(spark, sf_dir):
    c = t(spark, sf_dir, "conversations").select("conv_id", "turn", text.normal_name(F.col("text")).alias("n"))
    c = c.select("*", F.explode(F.array(F.split("n", " "))).alias("w"))
    return c.select("conv_id", "turn", F.array_join(resolve.phrases(F.col("w"), PHRASES), ",").alias("found"))


def candidate_disambiguate(spark, sf_dir):
    p = t(spark, sf_dir, "part").select(F.col("p_brand").alias("name"), F.col("p_type").alias("state"), "p_size", "p_partkey")
    cand = p.groupBy("name", "state").agg(F.sum("p_size").alias("population"))
    votes = p.filter("p_partkey % 4 = 0").groupBy("name", F.when(F.col("p_partkey") % 5 == 0, F.lit("SMALL")).otherwise(F.lit("PROMO")).alias("state")).agg(F.count(F.lit(1)).alias("n"))
    return resolve.disambiguate(p.select("name").distinct(), cand, votes, min_votes=2)


def vote_evidence(spark, sf_dir):
    c = t(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("label"))
    s = t(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), F.when(F.col("s_acctbal") > 5000, "BUILDING").otherwise("MACHINERY").alias("label"))
    return resolve.weighted_votes([(c, 1), (s, 3)], ["nation"], "label")


def suffix_host_join(spark, sf_dir):
    p = t(spark, sf_dir, "pages").select("page_id", text.host(F.col("url")).alias("host"))
    return resolve.suffix_join(p, "host", F.broadcast(spark.createDataFrame(REGISTRY, "suffix string, publisher string, priority int")), "publisher")


def gazetteer_merge(spark, sf_dir):
    c = t(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("name"), F.col("c_nationkey").alias("state"), F.lit("town").alias("kind"), F.when(F.col("c_nationkey") % 4 == 0, 0).otherwise(F.col("c_acctbal").cast("int")).alias("population"), (F.col("c_acctbal") > 9000).alias("flag"))
    s = t(spark, sf_dir, "supplier").select(F.lit("BUILDING").alias("name"), F.col("s_nationkey").alias("state"), F.lit("district").alias("kind"), F.col("s_acctbal").cast("int").alias("population"), F.lit(False).alias("flag"))
    return resolve.merge_gazetteer(c.unionByName(s))


def sketched(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", "lang", "source", text.sketch(F.coalesce("text", F.lit(""))).alias("s"))


def sketch_tokens(spark, sf_dir):
    return sketched(spark, sf_dir).select("doc_id", F.array_join("s", " ").alias("sketch"))


def numbered(spark, sf_dir):
    """Sketches as numbers: arrays of six hexadecimal digits each take three times the memory."""
    return sketched(spark, sf_dir).withColumn("s", F.transform("s", lambda x: F.conv(x, 16, 10).cast("int")))


def overlap_pairs(spark, sf_dir):
    return similarity.overlap_pairs(numbered(spark, sf_dir), "doc_id", "s", 0.4, ["lang"]).select("a", "b", F.round("overlap", 6).alias("overlap"))


def band_pairs(spark, sf_dir):
    e = ev(spark, sf_dir).select("event_id", "event_type", "user_id", F.to_date("ts").alias("day"))
    return similarity.day_band_pairs(e, "event_id", "day", ["event_type", "user_id"]).select("a", "b", "days")


def clustered(spark, sf_dir):
    s = numbered(spark, sf_dir)
    return similarity.clusters(s, "doc_id", similarity.similar_edges(s, "doc_id", "s", 0.4, ["lang"]))


def clusters(spark, sf_dir):
    return clustered(spark, sf_dir).select("doc_id", "cluster_id")


def cluster_rollup(spark, sf_dir):
    d = clustered(spark, sf_dir).join(t(spark, sf_dir, "documents").select("doc_id", "lang", F.concat(F.lit("s"), F.col("doc_id") % 4).alias("src")).hint("merge"), "doc_id")
    r = similarity.roll_up(d, ["cluster_id"], F.col("doc_id"), ["lang"], "src", ("doc_id", "doc_id"))
    return r.select("cluster_id", F.col("first").alias("first_doc"), F.col("last").alias("last_doc"), "lang", "n", "n_sources", "sources")


def number_parse(spark, sf_dir):
    k = F.col("o_orderkey") % 5
    raw = F.when(k == 0, F.format_number("o_totalprice", 2)).when(k == 1, F.concat(F.lit(" "), F.col("o_orderkey").cast("string"))).when(k == 2, F.lit("NA")).when(k == 3, F.concat(F.col("o_orderkey").cast("string"), F.lit("d"))).otherwise(F.concat(F.lit("-"), F.col("o_orderkey").cast("string"), F.lit(".5")))
    return t(spark, sf_dir, "orders").select("o_orderkey", text.number(raw).alias("figure"))


def clean_text(spark, sf_dir):
    return t(spark, sf_dir, "part").select("p_partkey", text.clean(F.concat(F.lit("  "), F.regexp_replace("p_type", " ", " \t\n "), F.lit("\n"))).alias("clean"))


def title_key(spark, sf_dir):
    return t(spark, sf_dir, "part").select("p_partkey", text.title_key(F.concat(F.lit("Table 3.2 "), F.col("p_type"), F.lit(" ("), F.col("p_size").cast("string"), F.lit(") 2019"))).alias("key"))


def head_key(spark, sf_dir):
    head = F.concat(F.initcap("p_type"), F.when(F.col("p_size") % 2 == 0, F.lit(" (Total)")).otherwise(F.lit(" (Sec. 302)")), F.lit(" 2019"))
    return t(spark, sf_dir, "part").select("p_partkey", text.head_key(head, {"standard polished tin": "polished tin"}).alias("key"))


def year_extract(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").cast("string").alias("y"))
    path = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("report-"), F.col("y"), F.lit(".xls"))).when(F.col("o_orderkey") % 4 == 1, F.concat(F.col("y"), F.lit("-2031/"))).otherwise(F.lit("report%20x.xls"))
    title = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("cases during "), F.col("y"), F.lit(" and "), F.col("y"))).otherwise(F.lit("id 120190"))
    return o.select("o_orderkey", F.coalesce(text.unique_year(path), text.unique_year(title)).alias("year"), F.when(text.unique_year(path).isNotNull(), "path").when(text.unique_year(title).isNotNull(), "title").alias("year_source"))


def rfc822_dates(spark, sf_dir):
    e = t(spark, sf_dir, "events").select("event_id", "ts")
    raw = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "EEE, d MMM yyyy HH:mm:ss 'GMT'")).when(F.col("event_id") % 3 == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).otherwise(F.lit("yesterday"))
    return e.select("event_id", text.feed_date(raw).cast("string").alias("day"))


def json_field(spark, sf_dir):
    return with_k(spark, sf_dir).select("event_id", "k")


def html_links(spark, sf_dir):
    p = t(spark, sf_dir, "pages")
    return p.select("page_id", "url", F.posexplode(text.html_links(F.col("html"))).alias("pos", "link")).select("page_id", F.col("pos").cast("bigint").alias("pos"), "link", text.absolute(F.col("url"), F.col("link")).alias("target"))


def html_title(spark, sf_dir):
    return t(spark, sf_dir, "pages").select("page_id", text.html_title(F.col("html")).alias("title"))


def strip_tags(spark, sf_dir):
    return t(spark, sf_dir, "pages").select("page_id", F.md5(text.strip_tags(F.col("html"))).alias("plain_md5"))


def crawl_frontier(spark, sf_dir):
    """Next pages to fetch: link targets not yet seen, files first, at most 150 a host."""
    p = t(spark, sf_dir, "pages").select("url", "html")
    links = p.select("url", F.explode(text.html_links(F.col("html"))).alias("link")).select(text.without_query(text.absolute(F.col("url"), F.col("link"))).alias("target")).distinct()
    new = links.join(p.select(text.without_query(F.col("url")).alias("target")).distinct(), "target", "left_anti").withColumn("host", text.host(F.col("target")))
    pri = F.when(F.col("target").rlike(r"(?i)\.(xlsx?|pdf|csv)$"), -1).when(F.col("target").rlike("(?i)th"), 1).otherwise(2)
    return reconcile.ranked(new.withColumn("priority", pri), ["host"], ["priority", "target"], 150).select("host", "target", "priority", "rank")


def content_ledger(spark, sf_dir):
    return store.ledger(t(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")


def repair_plan(spark, sf_dir):
    m = t(spark, sf_dir, "documents").select(store.content_id(F.coalesce("text", F.lit(""))).alias("file"), F.concat(F.lit("http://h/"), F.col("doc_id").cast("string")).alias("url"), (F.col("doc_id") % 3 == 0).alias("cap"))
    return store.repair_plan(m, m.filter(F.substring("file", 1, 1).isin("0", "1", "2", "3", "4")), m.filter(F.substring("file", 1, 1) == "a"), F.col("cap"))


def privacy_mask(spark, sf_dir):
    d = t(spark, sf_dir, "documents").select("doc_id", "text").join(t(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id", "left")
    return d.select("doc_id", F.when(F.coalesce("toxic", F.lit(0)) == 0, F.md5("text")).alias("shown"))


def validated_labels(spark, sf_dir):
    """Proposed labels are taken only from the closed list; rejected ones keep the rule's label."""
    proposed = F.to_json(F.struct(F.struct(F.when(F.col("k") % 3 == 0, F.upper("event_type")).otherwise(F.col("event_type")).alias("kind"), F.col("k").alias("i")).alias("label")))
    got = F.from_json(proposed, "label struct<kind:string,i:int>")["label"]["kind"]
    return with_k(spark, sf_dir).select("event_id", F.coalesce(classify.allowed(got, KINDS), F.lit("other")).alias("label"), classify.allowed(got, KINDS).isNotNull().alias("accepted"))


def profile_counts(spark, sf_dir):
    return t(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("n_value"), F.countDistinct("user_id").alias("users"), F.round(F.avg((F.col("value") > 50).cast("int")), 6).alias("share"))


def profile_pivot(spark, sf_dir):
    return t(spark, sf_dir, "documents").withColumn("bucket", F.when(F.col("n_chars") < 1000, "short").otherwise("long")).groupBy("lang").pivot("bucket", ["short", "long"]).agg(F.count(F.lit(1))).na.fill(0)


def profile_coverage(spark, sf_dir):
    d = t(spark, sf_dir, "documents").join(t(spark, sf_dir, "labels"), "doc_id", "left")
    return d.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count("quality").alias("labelled"), F.min("n_chars").alias("least"), F.max("n_chars").alias("most"), F.round(F.avg(F.col("quality").isNotNull().cast("int")), 6).alias("share"))


def top_gaps(spark, sf_dir):
    """Sources with the most unlabelled documents."""
    d = t(spark, sf_dir, "documents").select("doc_id", "source").join(t(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")
    return d.groupBy("source").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "source").limit(10)


def share_of_year(spark, sf_dir):
    f = order_facts(spark, sf_dir)
    return f.select("year", "entity", F.round(F.col("value") / F.sum("value").over(Window.partitionBy("year")), 8).alias("share"))


def publisher_bundles(spark, sf_dir):
    return t(spark, sf_dir, "documents").groupBy(store.shard(F.coalesce("text", F.lit(""))).alias("shard")).agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


def feed_items(spark, sf_dir):
    """Pages as feeds: items built from the pages' own titles, then read back."""
    p = t(spark, sf_dir, "pages")
    item = F.concat(F.lit("<item><title>A &amp; B"), F.col("page_id").cast("string"), F.lit("</title><link>"), F.col("url"), F.lit("</link><pubDate>Tue, "), F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0"), F.lit(" Mar 2024 10:00:00 GMT</pubDate><description>&lt;b&gt;x&lt;/b&gt;  y</description></item>"))
    return readers.feed_items(p.select("page_id", F.concat(F.lit("<rss>"), item, F.lit("<item><title>no date</title></item></rss>")).alias("xml")), "xml", ["page_id"]).select("page_id", "title", "url", F.col("published").cast("string").alias("published"), "summary")


def text_table_rows(spark, sf_dir):
    """Pages of figures as text lines, back to names and figures."""
    n = order_facts(spark, sf_dir)
    lines = n.groupBy("year").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "entity", "value"))), lambda x: F.concat(x["ord"].cast("string"), F.lit(" "), F.translate(x["entity"], "0123456789_", "abcdefghij "), F.lit(" "), F.format_number(F.floor(x["value"] / 1000), 0), F.lit(" NA"))), "\n").alias("page"))
    r = grid.text_rows(lines.withColumn("page", F.concat(F.lit("Table of orders\n(1) (2) (3)\n"), F.col("page"), F.lit("\nNote 12"))), "page", ["year"])
    return r.select("year", "name", F.array_join("figures", "|").alias("figures"))


def sheet_facts(spark, sf_dir):
    """Header blocks: a sheet per region, two header rows, a Total row, back to facts."""
    f = order_facts(spark, sf_dir)
    w = Window.partitionBy("region")
    body = f.select("region", "entity", "year", "value").withColumn("r", F.dense_rank().over(w.orderBy("entity")) + 2).withColumn("c", F.dense_rank().over(w.orderBy("year")))
    cells = body.select(F.lit("f").alias("file"), F.col("region").alias("sheet"), "r", "c", F.lit(None).cast("string").alias("v_str"), F.col("value").alias("v_num"))
    names = body.select("region", "entity", "r").distinct().select(F.lit("f"), "region", "r", F.lit(0), "entity", F.lit(None).cast("double"))
    heads = body.select("region", "c", "year").distinct()
    years = heads.select(F.lit("f"), "region", F.lit(2), "c", F.concat(F.lit("Y"), F.col("year").cast("string")), F.lit(None).cast("double"))
    top = heads.select("region").distinct().select(F.lit("f"), "region", F.lit(1), F.explode(F.array(F.struct(F.lit(0).alias("c"), F.lit("Nation").alias("s")), F.struct(F.lit(1).alias("c"), F.lit("Orders").alias("s")))).alias("x"))
    top = top.select("f", "region", "1", "x.c", "x.s", F.lit(None).cast("double"))
    title = heads.select("region").distinct().select(F.lit("f"), "region", F.lit(0), F.lit(0), F.lit("Value of orders by nation"), F.lit(None).cast("double"))
    out = grid.sheet_facts(cells.union(names).union(years).union(top).union(title))
    return out.select("sheet", "title", "entity", "label", F.round("value", 2).alias("value"))


def stream_dedupe(spark, sf_dir):
    return streams.distinct_keys(streams.read_events(spark, sf_dir, t(spark, sf_dir, "events").schema), ["user_id", "event_type"])


def stream_tumbling(spark, sf_dir):
    r = streams.tumbling(streams.read_events(spark, sf_dir, t(spark, sf_dir, "events").schema), "1 day", ["event_type"])
    return r.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.round("v", 4).alias("v"))


def stream_session(spark, sf_dir):
    r = streams.sessions(streams.read_events(spark, sf_dir, t(spark, sf_dir, "events").schema), "1 hour", ["user_id"])
    return r.select("user_id", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


QUERIES = {f.__name__: f for f in (
    first_match_rules, leaf_first_rules, metric_precedence, exact_canonical, fuzzy_canonical, phrase_longest_match, candidate_disambiguate, vote_evidence, suffix_host_join, gazetteer_merge, sketch_tokens, overlap_pairs, band_pairs,
    clusters, cluster_rollup, number_parse, clean_text, title_key, head_key, year_extract, rfc822_dates, json_field, html_links, html_title, strip_tags, crawl_frontier, content_ledger, repair_plan, privacy_mask, validated_labels,
    profile_counts, profile_pivot, profile_coverage, top_gaps, share_of_year, publisher_bundles, feed_items, text_table_rows, sheet_facts, stream_dedupe, stream_tumbling, stream_session)}
