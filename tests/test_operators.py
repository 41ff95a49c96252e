import io
import random
import zipfile

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from factloom.functions import classify, text
from factloom.operators import graph, grid, order, quality, reconcile, resolve, similarity
from factloom.plans import catalogue
from factloom.sources import readers, store


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn(F.col("x")).alias("y")).first()["y"]


def test_numbers(spark):
    for raw, want in (("1,234.5", 1234.5), (" 12 ", 12.0), ("-3", -3.0), ("12d", None), ("", None), ("NA", None), ("nan", None), (None, None), ("inf", None)):
        assert one(spark, raw, text.number) == want


def test_clean_takes_no_break_spaces(spark):
    assert one(spark, "\u00a0a \t\u00a0 b\n", text.clean) == "a b"


def test_unique_year(spark):
    for raw, want in (("cases 2019", 2019), ("2018-2019", None), ("2019 and 2019", 2019), ("id 120190", None), (None, None)):
        assert one(spark, raw, text.unique_year) == want


def test_feed_dates(spark):
    for raw, want in (("Tue, 05 Mar 2024 10:00:00 GMT", "2024-03-05"), ("2024-03-05T01:02:03Z", "2024-03-05"), ("5/3/2024", "2024-03-05"), ("soon", None), (None, None)):
        got = one(spark, raw, text.feed_date)
        assert (str(got) if got else None) == want


def test_links_resolve(spark):
    df = spark.createDataFrame([("http://h/a/b.html?q", "c.xls"), ("http://h/a/b", "/d#x"), ("http://h", "e"), ("http://h/a/", "//o/p"), ("http://h/a/", "https://z/")], "b string, l string")
    assert [r[0] for r in df.select(text.absolute(F.col("b"), F.col("l"))).collect()] == ["http://h/a/c.xls", "http://h/d", "http://h/e", "http://o/p", "https://z/"]


def test_leaf_first(spark):
    rules = [("sent", "(?i)sent"), ("kept", "(?i)kept")]
    fn = lambda c: classify.leaf_first(c, rules, "^Total$")
    for raw, want in (("Kept | Sent", "sent"), ("Sent | Total", "sent"), ("Total", "total"), ("x", "other"), ("", None), (None, None)):
        assert one(spark, raw, fn) == want


def test_block_labels_by_elimination(spark):
    df = spark.createDataFrame([("s", i, c) for i, c in enumerate([1, None, None, 4, None, 7])], "sheet string, i int, code int")
    codes = spark.createDataFrame([("s", c) for c in range(1, 8)], "sheet string, code int")
    assert [r["filled"] for r in order.elimination_fill(df, ["sheet"], ["i"], "code", codes).orderBy("i").collect()] == [1, 2, 3, 4, None, 7]


def test_sum_check_with_null_keys(spark):
    rows = [(None, "a", 1.0, False), (None, "b", 2.0, False), (None, "T", 3.0, True), ("x", "a", 100.0, False), ("x", "T", 150.0, True), ("y", "a", 1.0, False)]
    df = spark.createDataFrame(rows, "k string, e string, v double, total boolean").withColumn("o", F.col("e"))
    got = {r["k"]: r["qc"] for r in quality.sum_check(df, ["k"], "v", "o", F.col("total"), ~F.col("total")).collect()}
    assert got == {None: "sum_ok", "x": "sum_mismatch", "y": "unchecked"}


def test_block_check_needs_one_total(spark):
    df = spark.createDataFrame([("a", 1.0, False), ("a", 1.0, True), ("b", 1.0, False), ("b", 1.0, True), ("b", 1.0, True)], "k string, v double, total boolean")
    assert {r["k"]: r["qc"] for r in quality.block_check(df, ["k"], "v", F.col("total"), ~F.col("total")).collect()} == {"a": "block_ok", "b": "unchecked"}


def test_shrink_guard():
    assert quality.shrink_guard({"a": 100, "b": 10, "c": 1}, {"a": 90, "b": 8}) == ["b", "c"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(0, 3))), max_size=20))
def test_majority_is_order_independent(spark, rows):
    schema = "k int, v int"
    a = {tuple(r) for r in reconcile.majority_collapse(spark.createDataFrame(rows, schema), ["k"], "v").collect()}
    b = {tuple(r) for r in reconcile.majority_collapse(spark.createDataFrame(rows[::-1], schema).repartition(3), ["k"], "v").collect()}
    assert a == b


def test_runs_do_not_depend_on_arrival(spark):
    rows = [(1, i, v) for i, v in enumerate(["a", "a", None, None, "b", "a"])]
    want = [1, 1, 2, 2, 3, 4]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        got = order.run_id(spark.createDataFrame(rows, "u int, i int, v string").repartition(3), ["u"], ["i"], "v").orderBy("i")
        assert [r["run"] for r in got.collect()] == want


def test_upsert_twice_is_the_same(spark):
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    once = reconcile.upsert(old, new, "k")
    assert sorted(map(tuple, reconcile.upsert(once, new, "k").collect())) == sorted(map(tuple, once.collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_places(spark):
    names = spark.createDataFrame([("one",), ("big",), ("even",), ("told",), ("vetoed",), ("none",)], "name string")
    cand = spark.createDataFrame([("one", "A", 5), ("big", "A", 30), ("big", "B", 10), ("even", "A", 20), ("even", "B", 10), ("told", "A", 90), ("told", "B", 1), ("vetoed", "A", 5)], "name string, state string, population long")
    votes = spark.createDataFrame([("told", "B", 9), ("told", "A", 1), ("vetoed", "B", 6), ("even", "B", 2)], "name string, state string, n long")
    got = {r["name"]: r["state"] for r in resolve.disambiguate(names, cand, votes).collect()}
    assert got == {"one": "A", "big": "A", "even": None, "told": "B", "vetoed": None, "none": None}


def test_fuzzy(spark):
    df = spark.createDataFrame([("Northlland",), ("NORTHLAND",), ("Total",), (None,)], "n string")
    assert [r["code"] for r in resolve.fuzzy(df, "n", [("northland", "NL"), ("islet", "IS")]).orderBy(F.col("n")).collect()] == [None, "NL", "NL", None]


def test_components_of_a_long_chain(spark):
    n = 200
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (5, 5)], "a long, b long")
    got = {r["node"]: r["component"] for r in graph.connected_components(edges, "a", "b").collect()}
    assert got == {**dict.fromkeys(range(n + 1), 0), 1000: 1000, 1001: 1000}


def test_overlap_pairs_against_all_pairs(spark):
    rnd = random.Random(4)
    rows = [(i, rnd.choice(["x", "y", None]), rnd.sample("abcdefgh", rnd.randint(0, 5))) for i in range(40)]
    got = {(r["a"], r["b"]): round(r["overlap"], 6) for r in similarity.overlap_pairs(spark.createDataFrame(rows, "id int, g string, s array<string>").withColumn("s", F.array_sort("s")), "id", "s", 0.4, ["g"]).collect()}
    want = {}
    for i, g, s in rows:
        for j, h, u in rows:
            if i < j and g == h and s and u and len(set(s) & set(u)) / min(len(s), len(u)) >= 0.4:
                want[i, j] = round(len(set(s) & set(u)) / min(len(s), len(u)), 6)
    assert got == want


def test_overlap_pairs_of_hot_tokens_and_copies(spark, monkeypatch):
    """A token of nearly all sketches is dealt over several tasks; copies and similar sketches of all sizes keep every pair."""
    monkeypatch.setattr(similarity, "DEALT", 5)
    rnd = random.Random(5)
    rows = [(i, ["hot"] + rnd.sample("abcdefghijklmnopqrst", rnd.randint(0, 11))) for i in range(80)] + [(i, ["hot", "x", "y"]) for i in range(80, 90)]
    got = {(r["a"], r["b"]): round(r["overlap"], 6) for r in similarity.overlap_pairs(spark.createDataFrame(rows, "id int, s array<string>"), "id", "s", 0.4).collect()}
    share = {(i, j): round(len({*s} & {*u}) / min(len(s), len(u)), 6) for i, s in rows for j, u in rows if i < j}
    assert got == {p: x for p, x in share.items() if x >= 0.4}


@pytest.mark.parametrize("name", ["overlap_pairs", "clusters", "cluster_rollup"])
def test_sketches_are_never_broadcast(spark, sf, name, monkeypatch):
    """Sketches are small on disk and large in the driver's memory: they are joined by merge joins, whatever their size."""
    plans = []
    monkeypatch.setattr(similarity, "_near", lambda *a, f=similarity._near: plans.append(f(*a)) or plans[-1])
    out = catalogue.QUERIES[name](spark, sf)
    plans += [out] * (name == "overlap_pairs")
    shown = [p._jdf.queryExecution().executedPlan().toString() for p in plans]
    assert shown and all("SortMergeJoin" in p and "Broadcast" not in p for p in shown)


def test_roll_up_of_clusters_has_no_broadcast(spark, sf):
    """Tables of ids are small on disk and large in the driver's memory: from the edges to the roll-up, too, they are joined by merge joins."""
    shown = catalogue.QUERIES["cluster_rollup"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in shown and "Broadcast" not in shown


def test_edges_do_not_grow_with_pairs(spark):
    """400 sketches, all pairs of which are similar: each task gives fewer edges than it has sketches."""
    rnd = random.Random(6)
    rows = [(i, sorted(rnd.sample(range(16), 12))) for i in range(400)] + [(400 + i, sorted(rnd.sample(range(20, 36), 12))) for i in range(9)] + [(500, [90, 91])]
    df = spark.createDataFrame(rows, "id long, s array<int>")
    edges = similarity.similar_edges(df, "id", "s", 0.4)
    assert edges.count() < 4 * len(rows) * max(1, edges.rdd.getNumPartitions())
    got = {r["id"]: r["root"] for r in similarity.clusters(df, "id", edges).collect()}
    assert got == {**dict.fromkeys(range(400), 0), **dict.fromkeys(range(400, 409), 400), 500: 500}


@pytest.mark.parametrize("gathered", [1, 7, 1 << 20])
def test_forest_connects_what_its_edges_connect(monkeypatch, gathered):
    monkeypatch.setattr(graph, "GATHERED", gathered)
    rnd = random.Random(7)
    edges = [(f"n{rnd.randint(0, 60)}", f"n{rnd.randint(0, 60)}") for _ in range(45)] * 3

    def parts(pairs):
        root = {x: {x} for p in edges for x in p}
        for a, b in pairs:
            if root[a] is not root[b]:
                root[a] |= root[b]
                for x in root[b]:
                    root[x] = root[a]
        return {frozenset(x) for x in root.values()}

    batches = [pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in edges[i : i + 10]]) for i in range(0, len(edges), 10)]
    out = [(r["a"], r["b"]) for b in graph.forest_of_task(iter(batches)) for r in b.to_pylist()]
    assert parts(out) == parts(edges) and len(out) == sum(len(p) - 1 for p in parts(edges))
    assert not list(graph.forest_of_task(iter([])))


def test_merges_and_empty_lines(spark):
    cells = spark.createDataFrame([("f", "s", 0, 0, "Head", None), ("f", "s", 0, 1, None, 5.0), ("f", "s", 3, 4, "x", None)], "file string, sheet string, r int, c int, v_str string, v_num double")
    merges = spark.createDataFrame([("f", "s", 0, 1, 0, 1)], "file string, sheet string, r0 int, r1 int, c0 int, c1 int")
    got = {(r["r"], r["c"]): (r["v_str"], r["v_num"]) for r in grid.fill_merges(cells, merges).collect()}
    assert got[1, 1] == ("Head", None) and got[0, 1] == (None, 5.0)
    assert {(r["r"], r["c"]) for r in grid.without_empty_lines(cells).collect()} == {(0, 0), (0, 1), (1, 2)}


def test_named_sheets(spark):
    df = spark.createDataFrame([("a", "Sheet1"), ("a", "Data"), ("b", "Sheet1")], "file string, sheet string")
    assert sorted(map(tuple, grid.named_sheets_only(df).collect())) == [("a", "Data"), ("b", "Sheet1")]


def test_sheet_facts(spark):
    sheet = [["Orders by land, 2019"], ["State", "Sent", None, "Kept"], [None, 2018, 2019, 2019], ["(1)", "(2)", "(3)", "(4)"], ["Zone: North"], ["Northland", 1, 2, 3], ["Total", 1, 2, 3], ["Isle", 4, 5, 6]]
    rows = [("f", "s", r, c, v if isinstance(v, str) else None, float(v) if isinstance(v, int) else None) for r, row in enumerate(sheet) for c, v in enumerate(row) if v is not None]
    got = grid.sheet_facts(spark.createDataFrame(rows, "file string, sheet string, r int, c int, v_str string, v_num double")).collect()
    facts = {(r["entity"], r["label"]): (r["value"], r["context"], r["is_total"]) for r in got}
    assert facts["Northland", "Sent | 2018"] == (1.0, "North", False) and facts["Northland", "Sent | 2019"][0] == 2.0 and facts["Total", "Kept | 2019"] == (3.0, "North", True)
    assert facts["Isle", "Kept | 2019"] == (6.0, None, False) and got[0]["title"] == "Orders by land, 2019"


def sheet_cells(spark, sheets: dict):
    """Cells of sheets given as {name: rows}; texts and figures are told apart by type."""
    rows = [("f", name, r, c, v if isinstance(v, str) else None, None if isinstance(v, str) else float(v)) for name, sheet in sheets.items() for r, row in enumerate(sheet) for c, v in enumerate(row) if v is not None]
    return spark.createDataFrame(rows, "file string, sheet string, r int, c int, v_str string, v_num double")


def test_sheet_facts_of_stacked_tables(spark):
    sheets = {
        # a lower head that looks like one of entities belongs to the head over it; blanks are spanned but in the last header row
        "tall": [["Courts of the land"], ["State", "Courts", None, "Staff"], [None, "District", "City", None], ["East", 4, 5, 6], ["West", "1,204", "-", 7]],
        # the head of the second table comes right after the first table's figures; its title and notes lie between
        "stack": [["First title"], ["Sr. head", "x"], ["Region", "p", "q"], ["A", 1, 2], ["Total", 1, 2], ["Source: office"], ["Second title"], ["Region", "s", "t"], ["B", 3, 4]],
        # figures that may be years make no row of figures; a repeated banner gives no label
        "years": [["Name", "Sales", None], ["", 2001, 2002], ["Zone: up", "Zone: up", "Zone: up"], ["n", 5, 6]],
        "no figures": [["Name", "Sales"], ["a", "b"]],
    }
    got = {}
    for r in grid.sheet_facts(sheet_cells(spark, sheets)).collect():
        got.setdefault(r["sheet"], set()).add((r["title"], r["entity_type"], r["entity"], r["context"], r["label"], r["value"]))
    assert got.pop("tall") == {("Courts of the land", "State", e, None, label, v) for e, label, v in [
        ("East", "Courts | District", 4.0), ("East", "Courts | City", 5.0), ("East", "Staff", 6.0), ("West", "Courts | District", 1204.0), ("West", "Staff", 7.0)]}
    assert got.pop("stack") == {("First title Sr. head", "Region", "A", None, "x | p", 1.0), ("First title Sr. head", "Region", "A", None, "x | q", 2.0), ("First title Sr. head", "Region", "Total", None, "x | p", 1.0),
                                ("First title Sr. head", "Region", "Total", None, "x | q", 2.0), ("Second title", "Region", "B", None, "s", 3.0), ("Second title", "Region", "B", None, "t", 4.0)}
    assert got.pop("years") == {("", "Name", "n", None, "Sales | 2001", 5.0), ("", "Name", "n", None, "Sales | 2002", 6.0)}
    assert not got


def test_sheet_facts_with_nulls_repeats_and_other_columns(spark):
    cells = sheet_cells(spark, {"s": [["Name", "n"], ["a", 1]]})
    nulls = spark.createDataFrame([(None, "s", 0, 0, "Name", None), ("f", None, 0, 0, "Name", None), ("f", "s", 5, 5, None, None), ("f", "s", 6, 0, "  ", float("nan"))], cells.schema)
    twice = cells.unionByName(cells).unionByName(nulls).withColumn("i", F.lit("x")).withColumn("island", F.lit("y"))
    assert [(r["entity"], r["label"], r["value"]) for r in grid.sheet_facts(twice).collect()] == [("a", "n", 1.0)]
    assert grid.sheet_facts(cells.limit(0)).count() == 0


def workbook():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{readers.NS["m"]}" xmlns:r="{readers.NS["r"]}"><sheets><sheet name="Data" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{readers.NS["m"]}"><si><t>State</t></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{readers.NS["m"]}"><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="AB2"><v>4.5</v></c></row></sheetData><mergeCells><mergeCell ref="A1:B2"/></mergeCells></worksheet>')
    return out.getvalue()


def test_xlsx(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook())
    (tmp_path / "b.xlsx").write_bytes(b"no workbook")
    rows = readers.xlsx(spark, str(tmp_path)).collect()
    assert {(r["sheet"], r["r"], r["c"], r["v_str"], r["v_num"]) for r in rows if r["error"] is None} == {("Data", 0, 0, "State", None), ("Data", 1, 27, None, 4.5)}
    assert sum(r["error"] is not None for r in rows) == 1
    assert readers.xlsx_cells(workbook())[1] == [("Data", 0, 1, 0, 1)]


def test_feed(spark):
    xml = "<rss><item><title><![CDATA[A  b]]></title><link>http://h/x?y</link><pubDate>Tue, 05 Mar 2024 10:00:00 GMT</pubDate><description>&lt;p&gt;z&lt;/p&gt;</description></item><item><title>undated</title><link>u</link></item><item>"
    got = readers.feed_items(spark.createDataFrame([(1, xml)], "id int, x string"), "x", ["id"]).collect()
    assert [(r["title"], r["url"], str(r["published"]), r["summary"]) for r in got] == [("A b", "http://h/x", "2024-03-05", "z")]


def test_csv_tsv_zip(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n1,x\n")
    (tmp_path / "a.tsv").write_text('1\t"q\n')
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("m", b"12")
    assert [tuple(r) for r in readers.csv(spark, str(tmp_path / "a.csv"), "k int, v string").collect()] == [(1, "x")]
    assert [tuple(r) for r in readers.tsv(spark, str(tmp_path / "a.tsv"), "k int, v string").collect()] == [(1, '"q')]
    assert [(r["member"], bytes(r["content"])) for r in readers.zip_members(spark, str(tmp_path)).collect()] == [("m", b"12")]


def test_ledger_gains_columns_and_tables_swap(spark, tmp_path):
    p = str(tmp_path / "ledger")
    store.append_ledger(spark.createDataFrame([(1,)], "a int"), p)
    store.append_ledger(spark.createDataFrame([(2, "x")], "a int, b string"), p)
    assert sorted(map(tuple, store.read_ledger(spark, p).collect())) == [(1, None), (2, "x")]
    q = str(tmp_path / "t")
    for v in (1, 2):
        store.replace_table(spark.createDataFrame([(v,)], "a int"), q)
    assert [r["a"] for r in spark.read.parquet(q).collect()] == [2]


def test_resolving_keeps_columns_of_helpers_names(spark):
    df = spark.createDataFrame([("North Shore", 7, 12)], "name string, _n int, _b int")
    look = spark.createDataFrame([("north shore", "N")], "alias string, code string")
    assert resolve.canonical(df, "name", look).collect() == [("North Shore", 7, 12, "N")]
    assert resolve.fuzzy(df, "name", [("north shore", "N")]).select("name", "_n", "_b", "code").collect() == [("North Shore", 7, 12, "N")]
    ranges = spark.createDataFrame([(10, 19, "ten")], "low int, high int, label string")
    assert [r["label"] for r in resolve.range_join(df, "_b", ranges, "low", "high", 5).select("_n", "_b", "label").collect()] == ["ten"]


def test_phrases_of_a_long_list(spark):
    words = spark.createDataFrame([(["in", "the", "old", "town", "hall", "of", "x"],), ([],), (None,)], "w array<string>")
    known = ["old town", "old town hall", "town", *[f"name {i}" for i in range(40)]]
    got = words.select(resolve.phrases(F.col("w"), known).alias("p"))
    assert [r["p"] for r in got.collect()] == [["old town hall"], [], []]
    assert "INSET" in got._jdf.queryExecution().optimizedPlan().toString()


def test_years_outside_ranges(spark):
    from pyspark.sql import functions as F

    from factloom.functions import text

    cases = [("t 1994.xls", ["1994"]), ("t 1994-97 x 1999", ["1999"]), ("a1993_1996b2001", ["2001"]), ("1993 - 94-1998", ["1998"]), ("1994-971", ["1994", "971"]), ("1894-97 12", ["1894", "97", "12"]), ("no", []), ("", []), ("1995-x-96", ["1995", "96"])]
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "i int, c string")
    assert [r["x"] for r in df.select("i", text.runs_outside_ranges(F.col("c")).alias("x")).orderBy("i").collect()] == [w for _, w in cases]
    got = df.select("i", text.years(F.concat("c", F.lit(" 1949 1950 2039 2040 12000"))).alias("y")).orderBy("i").collect()
    assert got[0]["y"] == ["1994", "1950", "2039"] and got[6]["y"] == ["1950", "2039"]
