"""Queries that compose operators: block labels, redundancy, votes, places, news, captures, catalogue, files, sheets."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from factloom.functions import text
from factloom.operators import grid, news, panels, places
from factloom.plans.facts import order_facts, t, with_k
from factloom.session import shared_dir
from factloom.sources import sinks
from factloom.streaming import files

GAZETTEER = [("building", "B1", 900, "city"), ("building", "B2", 100, "district"), ("machinery", "M1", 50, "district"), ("furniture", "M1", 70, "city"), ("automobile", "A1", 9, "city"), ("household", "H1", 3, "city")]
PLACE_ALIASES = [("mach", "machinery")]
GENERIC, QUALIFIERS = ["north", "city"], ["city", "rural"]
ARCHIVE = "https://archive.example.org/web/"
#: allowed labels of the refined items
EVENT_LABELS = ["click", "view", "buy"]


def block_labels(spark, sf_dir):
    """Events of a user as stacked rows, each block closed by a purchase; the code of a row is known, inferred or missing."""
    e = with_k(spark, sf_dir).select("user_id", "ts", "event_id", F.when(F.col("event_id") % 4 == 0, None).when(F.col("event_id") % 11 == 0, 7).otherwise(F.col("user_id") % 3).alias("code"), "event_type")
    out = panels.label_blocks(e, ["user_id"], ["ts", "event_id"], "code", F.col("event_type") == "purchase", F.col("event_id") % 2 == 1, share=0.7)
    return out.select("user_id", "event_id", F.col("block").cast("long").alias("block"), "block_code", "placed", "changed")


def fact_redundancy(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_tax", "l_orderkey", "l_linenumber", "l_returnflag", F.when(F.col("l_linenumber") % 2 == 0, "sheet").otherwise("text").alias("format"))
    out = panels.redundancy(li, ["l_partkey", "l_suppkey"], "l_tax", (F.col("format") == "sheet") | (F.col("l_returnflag") == "A"), ["format", "l_orderkey", "l_linenumber"])
    return out.select("l_partkey", "l_suppkey", "trusted", "l_tax", "format", "l_orderkey", "n_sources", "conflict")


def vote_collapse(spark, sf_dir):
    e = with_k(spark, sf_dir).select("user_id", "event_type", "k", "event_id", F.when(F.col("event_id") % 9 > 0, F.col("ts")).alias("seen"), (F.col("event_id") % 3).alias("priority"))
    out = panels.collapse(e, ["user_id", "event_type"], "k", "priority", "seen", "event_id", F.col("event_id") % 7 == 0)
    return out.select("user_id", "event_type", "k", "event_id", "votes", "checked", "disputed")


def place_candidates(spark, sf_dir):
    c = F.initcap("c_mktsegment")
    k = F.col("c_custkey") % 6
    name = F.when(k == 0, F.concat(c, F.lit(" City Rural"))).when(k == 1, F.concat(c, F.lit(" - Furniture"))).when(k == 2, F.lit("Mach.")).when(k == 3, F.lit("North City")).when(k == 4, F.concat(c, F.lit(" & Unknown"))).otherwise(c)
    gaz = F.broadcast(spark.createDataFrame(GAZETTEER, "name string, state string, population int, kind string"))
    found = places.candidates(t(spark, sf_dir, "customer").select(name.alias("name")), gaz, F.broadcast(spark.createDataFrame(PLACE_ALIASES, "alias string, name string")), GENERIC, QUALIFIERS)
    return found


def place_states(spark, sf_dir):
    """Brands as places whose states are part types, with votes, districts, metropolitan tables, years and no veto."""
    p = t(spark, sf_dir, "part").select(F.concat("p_brand", F.lit("-"), (F.col("p_partkey") % 40).cast("string")).alias("name"), F.split("p_type", " ")[0].alias("state"), "p_size", "p_partkey")
    found = p.groupBy("name", "state").agg(F.sum("p_size").alias("population"), F.when(F.min("p_size") % 2 == 0, "district").otherwise("city").alias("kind"))
    votes = p.filter("p_partkey % 3 = 0").groupBy("name", "state").agg(F.count(F.lit(1)).alias("n"))
    names = p.select("name", (F.when(F.length("name") % 2 == 0, 2010).otherwise(2020)).alias("year"), F.col("name").endswith("1").alias("metro")).distinct()
    return places.state_of(names, found, votes, min_votes=2, successors=[("SMALL", 2014, "LARGE")])


def news_ingest(spark, sf_dir):
    """Documents as news: some known, some rejected, repeated urls, long ones hidden."""
    d = t(spark, sf_dir, "documents").select(F.concat(F.lit("u"), (F.col("doc_id") % 700).cast("string")).alias("url"), F.md5(F.coalesce("text", F.lit(""))).alias("title"), F.col("source").alias("summary"), "doc_id", "lang", "n_chars")
    known = d.filter("doc_id % 10 = 3").groupBy("url").agg(F.min("doc_id").alias("doc_id")).select("url", "doc_id", F.lit("old").alias("label"))
    rejected = d.filter("doc_id % 10 = 4").select("url").distinct()
    new = news.ingest(d, known, rejected, F.col("lang").isin("en", "de"), F.concat(F.lit("l-"), "lang"), F.col("n_chars") > 2000, "doc_id")
    return new.select("url", "doc_id", "label", "title", "summary", "hidden")


def label_refinement(spark, sf_dir):
    """A stand-in for a model: it answers in code fences, names labels that are not allowed, breaks replies and fails."""
    def labeller(texts):
        if any(x.endswith("0 13") for x in texts):
            raise TimeoutError
        out = []
        for x in texts:
            kind, n = x.split(" ")[0], int(x.split(" ")[1])
            reply = json.dumps({"keep": n % 5 > 0, "label": {"purchase": "buy", "signup": "join"}.get(kind, kind)})
            out.append({0: None, 1: f"```json\n{reply}\n```", 2: reply[:-3]}.get(n % 4, reply))
        return out

    e = with_k(spark, sf_dir)
    e = e.select("event_id", F.concat_ws(" ", "event_type", F.col("event_id").cast("string"), F.coalesce("k", F.lit(0)).cast("string")).alias("title"), F.lit("other").alias("label"), F.when(F.col("event_id") % 6 == 0, "model").otherwise("rules").alias("labeller"))
    return news.refine(e, labeller, EVENT_LABELS, batch=1).select("event_id", "label", "labeller", "dropped")


def relabelled(spark, sf_dir):
    e = with_k(spark, sf_dir).select(F.col("event_id").alias("url"), F.col("event_type").alias("label"), F.when(F.col("event_id") % 4 == 0, "model").otherwise("rules").alias("labeller"))
    better = e.filter("url % 3 = 0").select("url", F.upper("label").alias("label"), F.lit("model").alias("labeller"))
    return news.relabel_backlog(e, better)


def capture_index(spark, sf_dir):
    p = t(spark, sf_dir, "pages").select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.length(F.coalesce("html", F.lit(""))).alias("n"))
    row = F.array(F.lpad(F.col("page_id").cast("string"), 14, "0"), F.concat("url", F.when(F.col("page_id") % 3 == 0, ".xlsx").otherwise(".html")), F.when(F.col("page_id") % 5 == 0, "404").otherwise("200"), F.md5((F.col("page_id") % 900).cast("string")), F.when(F.col("page_id") % 7 == 0, "-").otherwise(F.col("n").cast("string")))
    listing = p.select(F.to_json(F.array(F.array(*[F.lit(x) for x in ("timestamp", "original", "statuscode", "digest", "length")]), row)).alias("body"))
    return sinks.capture_rows(listing, "body", r"(?i)\.xlsx?$|/en/", r"/9[0-9]*\.html$", 8000)


def documents_catalogue(spark, sf_dir):
    d = t(spark, sf_dir, "documents")
    m = d.select(F.concat(F.substring(F.md5(F.coalesce("text", F.lit(""))), 1, 8), F.when(F.col("doc_id") % 2 == 0, ".xlsx").otherwise(".Doc")).alias("file"), F.concat(F.lit("http://h/"), (F.col("doc_id") % 300).cast("string")).alias("url"), F.when(F.col("doc_id") % 5 == 0, "").otherwise(F.concat(F.lit("2020"), F.lpad((F.col("doc_id") % 10000).cast("string"), 10, "0"))).alias("stamp"), F.col("source").alias("publisher"))
    facts = m.filter(F.substring("file", 1, 1).isin("1", "2", "3")).select("file", F.substring("file", 1, 1).isin("1", "2").alias("trusted"))
    return sinks.documents(m, facts, ARCHIVE, ["xls", "xlsx", "pdf"])


def year_rules(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").cast("string").alias("y"))
    k = F.col("o_orderkey") % 6
    url = F.when(k == 0, F.concat(F.lit("http://h/d/Orders%20of_"), "y", F.lit(".XLSX"))).when(k == 1, F.concat(F.lit("http://h/1993-96/t_"), "y", F.lit("-15.xls"))).when(k == 2, F.lit("http://h/Lines%2019.4.xlsx")).when(k == 3, F.concat(F.lit("http://h/"), "y", F.lit("/t.pdf"))).otherwise(F.concat(F.lit("http://h/t-"), "y", F.lit("_x"), F.lit(".pdf")))
    title = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("Persons in "), "y")).when(F.col("o_orderkey") % 4 == 1, F.lit("Years 1994 and 1995")).otherwise(F.lit("Persons"))
    sheet = F.when(F.col("o_orderkey") % 10 == 0, F.concat(F.lit("S "), (F.col("y").cast("int") + 41).cast("string"))).otherwise(F.lit("S 1"))
    x = text.publication_year(url, title, sheet)
    return o.select("o_orderkey", text.plausible_year(x["year"]).alias("year"), x["source"].alias("source"))


def qualified_names(spark, sf_dir):
    """City (State) entities with the year of their row, else of their column, else of their table."""
    p = t(spark, sf_dir, "part").select("p_partkey", "p_size", F.when(F.col("p_partkey") % 3 == 0, F.concat(F.initcap("p_name"), F.lit("  ("), "p_type", F.lit(")"))).otherwise(F.concat(F.lit(" "), "p_name")).alias("entity"))
    x = text.split_qualified(F.col("entity"))
    row = F.when(F.col("p_size") % 5 == 0, 2000 + F.col("p_size"))
    column = text.unique_year(F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("Cases 19"), F.lpad((50 + F.col("p_size") % 50).cast("string"), 2, "0"))).otherwise(F.lit("Cases")))
    return p.select("p_partkey", x["name"].alias("name"), x["qualifier"].alias("qualifier"), text.plausible_year(F.coalesce(row, column, F.lit(1999))).alias("year"))


def split_sink(spark, sf_dir):
    """Facts to a table split by trust, a sorted CSV and JSON state, and back."""
    f, root = order_facts(spark, sf_dir), shared_dir(spark, "sinks")
    sinks.write_split(f, F.col("value") > 2_000_000, f"{root}/split")
    sinks.write_csv(f.select("year", "entity"), f"{root}/csv", ["year", "entity"])
    sinks.write_state(f.select("entity").distinct(), f"{root}/state")
    back = sinks.read_split(spark, f"{root}/split", "trusted").select(F.lit("trusted").alias("part"), "entity", "year")
    back = back.unionByName(sinks.read_split(spark, f"{root}/split", "low").select(F.lit("low").alias("part"), "entity", "year"))
    back = back.unionByName(spark.read.option("header", True).schema("year int, entity string").csv(f"{root}/csv").select(F.lit("csv").alias("part"), "entity", "year"))
    state = sinks.read_state(spark, f"{root}/state", "entity string").unionByName(sinks.read_state(spark, f"{root}/none", "entity string"))
    return back.unionByName(state.select(F.lit("state").alias("part"), "entity", F.lit(0).alias("year"))).groupBy("part", "entity").agg(F.count(F.lit(1)).alias("n"), F.sum("year").alias("years"))


def new_files(spark, sf_dir):
    """Two runs over a growing folder with one checkpoint: the second takes the new files only."""
    root = shared_dir(spark, "incoming")
    n = t(spark, sf_dir, "nation").select("n_regionkey", F.concat_ws(",", F.col("n_nationkey").cast("string"), "n_name").alias("value"))
    parse = lambda b: b.select(F.explode(F.split(F.trim(F.col("content").cast("string")), "\n")).alias("line")).filter("line <> ''").select(F.split("line", ",")[0].cast("int").alias("n_nationkey"), F.split("line", ",")[1].alias("n_name"))
    for regions in ("n_regionkey < 2", "n_regionkey >= 2"):
        n.filter(regions).select("value").write.mode("append").text(f"{root}/in")
        files.take_new_files(spark, f"{root}/in", "*.txt", parse, f"{root}/out", f"{root}/state", at_once=2)
    return spark.read.parquet(f"{root}/out").select("n_nationkey", "n_name")


def stale_files(spark, sf_dir):
    d = t(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("file"), F.when(F.col("doc_id") % 3 == 0, "pdf").otherwise("xls").alias("ext"), F.when(F.col("doc_id") % 4 > 0, F.col("doc_id") % 4).cast("int").alias("version"), "n_chars")
    gone = files.stale(d.select("file", "ext", "version"), {"pdf": 2, "xls": 1}, d.filter("n_chars > 100").select("file"))
    return files.without_stale(d.select("file", "n_chars"), gone)


def due_snapshots(spark, sf_dir):
    e = t(spark, sf_dir, "events").select(F.col("event_type").alias("feed"), F.date_format("ts", "yyyyMMdd").alias("stamp")).distinct()
    return files.due_snapshots(e, e.filter("stamp < '20240110'").select(F.concat_ws("@", "feed", "stamp").alias("key"))).select("key", "feed", "stamp")


def done_union(spark, sf_dir):
    """Work done by either run, each key once."""
    d = t(spark, sf_dir, "documents").select("doc_id")
    return d.filter("doc_id % 2 = 0").union(d.filter("doc_id % 3 = 0")).distinct()


def undocumented_columns(spark, sf_dir):
    """The columns that tables really have against a list of documented ones."""
    have = [(n, c) for n in ("nation", "region", "labels") for c in t(spark, sf_dir, n).columns]
    docs = [("nation", "n_name"), ("nation", "n_comment"), ("region", "r_regionkey"), ("region", "r_name"), ("labels", "doc_id")]
    return sinks.undocumented(spark.createDataFrame(have, "table string, column string"), spark.createDataFrame(docs, "table string, column string"))


def sheets_of(spark, sf_dir):
    """Workbooks: a file per region, a sheet per nation, every third file with default names only."""
    n = t(spark, sf_dir, "nation")
    return n.select(F.col("n_regionkey").alias("file"), F.when((F.col("n_regionkey") % 3 == 0) | (F.col("n_nationkey") % 2 == 0), F.concat(F.lit("Sheet"), F.col("n_nationkey").cast("string"))).otherwise(F.col("n_name")).alias("sheet"))


def named_sheets(spark, sf_dir):
    return grid.named_sheets_only(sheets_of(spark, sf_dir))


def cells_of(spark, sf_dir):
    p = t(spark, sf_dir, "part").select(F.lit("f").alias("file"), F.col("p_brand").alias("sheet"), ((F.col("p_partkey") / 10).cast("int") * 2).alias("r"), ((F.col("p_partkey") % 10).cast("int") * 3).alias("c"), F.when(F.col("p_partkey") % 3 > 0, F.col("p_type")).alias("v_str"), F.when(F.col("p_partkey") % 3 == 0, F.col("p_size").cast("double")).alias("v_num"))
    return p


def merged_cells(spark, sf_dir):
    """Each cell with text heads a merged range (two rows high, two columns wide); the text is copied to all cells of its range."""
    c = cells_of(spark, sf_dir)
    m = c.filter("v_str is not null").select("file", "sheet", F.col("r").alias("r0"), (F.col("r") + 1).alias("r1"), F.col("c").alias("c0"), (F.col("c") + 1).alias("c1"))
    return grid.fill_merges(c, m, clip=False).filter("v_str is not null or v_num is not null")


def without_empty_lines(spark, sf_dir):
    r = grid.without_empty_lines(cells_of(spark, sf_dir))
    return r.select("file", "sheet", F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"), "v_str", "v_num")


QUERIES = {f.__name__: f for f in (block_labels, fact_redundancy, vote_collapse, place_candidates, place_states, news_ingest, label_refinement, relabelled, capture_index, documents_catalogue, year_rules, qualified_names, split_sink, new_files,
                                   stale_files, due_snapshots, done_union, undocumented_columns, named_sheets, merged_cells, without_empty_lines)}
