"""States by evidence and by blocks, case by case."""

import pytest
from pyspark.sql import functions as F

from factloom.operators import inference, places

STATES = [("North Reach", "NR"), ("Eastmark", "EM"), ("Low Isles", "LI"), ("New Vale", "NV")]
PLACES = [("bay", "NR", 900_000, "city"), ("hill", "EM", 300_000, "district"), ("hill", "LI", 900_000, "district"), ("dale", "EM", 10_000, "city"), ("dale", "LI", 90_000, "city"), ("moor", "NV", 10, "district"),
          *[(f"em{i}", "EM", 10, "district") for i in "abcdef"], *[(f"li{i}", "LI", 10, "district") for i in "abcdef"]]
SUCCESSORS = [("NV", 2014, "EM")]
ORDER = ["AA", "BB", "CC", "DD", "EE", "FF"]
COLUMNS = "pos int, file string, sheet string, table_title string, entity_type string, entity string, state_code string, parent_state_code string, is_total boolean, year double"


def inferred(spark, rows):
    """rows: (file, sheet, title, type, entity, parent, total, year) -> (parent, state_code, inferred) in order."""
    df = spark.createDataFrame([(i, f, s, t, k, e, None, p, x, y) for i, (f, s, t, k, e, p, x, y) in enumerate(rows)], COLUMNS).withColumn("c", F.lit(1)).withColumn("top", F.lit(2))
    look = lambda n: places.candidates(n, spark.createDataFrame(PLACES, "name string, state string, population long, kind string"), spark.createDataFrame([("old bay", "bay")], "alias string, name string"), ["west"], ["city"])
    got = inference.infer_states(df, "pos", spark.createDataFrame(STATES, "alias string, code string"), look, SUCCESSORS)
    assert got.columns == [*df.columns, "state_inferred"]
    return [(r["parent_state_code"], r["state_code"], r["state_inferred"]) for r in got.orderBy("pos").collect()]


def test_states_by_evidence(spark):
    row = lambda f, k, e, p=None, t=False, y=2020.0, title="t": (f, "s", title, k, e, p, t, y)
    none = (None, None, False)
    rows = [row("a", "city", "Bay City"), row("a", "district", "Hill"), row("a", "district", "Total", t=True), row("a", "state", "Eastmark"),
            row("b", "city", "Hill"), row("b", "district", "Old Bay"), row("b", "district", "Nowhere"),
            row("c", "district", "Hill", title="Places of Eastmark, 2020 (Eastmark)"), row("c", "district", "emb"),  # six votes by the title
            *[row("d", "district", f"em{i}", "EM") for i in "abcde"], row("d", "district", "Dale"), row("d", "district", "Bay"),  # namesakes of a sheet of one state
            row("e", "district", "Moor", y=2010.0), row("e", "district", "Moor", y=2015.0), row("e", "district", "New Vale"), row(None, "district", "Dale"), row("f", "district", None)]
    want = [("NR", "NR", True), none, none, none, ("LI", "LI", True), ("NR", None, True), none, ("EM", None, True), ("EM", None, True), *[("EM", None, False)] * 5, ("EM", None, True), none,
            ("EM", None, True), ("NV", None, True), ("NV", None, True), ("LI", None, True), none]
    assert inferred(spark, rows) == want


def settled(spark, rows, year=2019.0, **more):
    """rows: (sheet, type, entity, total, parent, inferred) -> (parent, inferred) in order."""
    df = spark.createDataFrame([(i, "f", s, "t", k, e, None, p, x, year, n) for i, (s, k, e, x, p, n) in enumerate(rows)], COLUMNS + ", state_inferred boolean").withColumn("gap", F.lit(1))
    seq = spark.createDataFrame([(c, i) for i, c in enumerate(ORDER)], "code string, place int")
    got = inference.settle_blocks(df, "pos", seq, 2014, 2020, **more)
    assert got.columns == df.columns
    return [(r["parent_state_code"], r["state_inferred"]) for r in got.orderBy("pos").collect()]


def block(sheet, codes, inf=True, kind="district"):
    return [(sheet, kind, f"{sheet}{c}{i}", False, c, inf and c is not None) for i, c in enumerate(codes)] + [(sheet, "district", "Total", True, None, False)]


def test_blocks(spark):
    rows = [*block("s", ["AA", "AA", None]), *block("s", ["BB"] * 4 + ["EE"]), *block("s", ["CC"], False, "state"),  # a single row is enough, and its total follows
            *block("s", ["BB", "EE"]), ("s", "country", "All", False, None, False)]
    want = [("AA", True)] * 4 + [("BB", True)] * 6 + [("CC", False), ("CC", True)] + [("BB", True), ("EE", True), ("DD", True), (None, False)]
    got = settled(spark, rows)
    assert got[:12] == want[:12] and got[12:14] == want[12:14] and got[15] == want[15]
    assert got[14] == (None, False)  # DD, EE and FF are free after CC: no single reading
    printed = [*block("s", ["BB"] * 5 + ["EE"], False)]
    assert settled(spark, printed)[5] == ("EE", False)  # a printed state stays


@pytest.mark.parametrize("year, filled", [(2019.0, True), (2013.0, False), (2020.0, False), (None, False)])
def test_elimination(spark, year, filled):
    rows = [*block("o", ["AA", "AA"]), *block("o", [None, None]), *block("o", ["CC", "CC"])]
    assert settled(spark, rows, year)[3:6] == ([("BB", True)] * 3 if filled else [(None, False)] * 3)


def test_elimination_at_the_ends_and_beside_unknown_codes(spark):
    a = [*block("a", [None]), *block("a", [None, None]), *block("a", ["CC", "CC"]), *block("a", [None]), *block("a", ["EE", "EE"]), *block("a", [None])]
    assert [x[0] for x in settled(spark, a)] == ["AA"] * 2 + ["BB"] * 3 + ["CC"] * 3 + ["DD"] * 2 + ["EE"] * 3 + ["FF"] * 2
    z = [*block("z", ["ZZ", "ZZ"]), *block("z", [None]), *block("z", ["BB", "BB"]), *block("y", ["CC", "CC"]), *block("y", [None]), *block("y", ["BB", "BB"])]
    assert [x[0] for x in settled(spark, z)] == ["ZZ"] * 3 + [None] * 2 + ["BB"] * 3 + ["CC"] * 3 + [None] * 2 + ["BB"] * 3
    used = [*block("u", ["AA", "AA"]), *block("u", [None]), *block("u", ["DD", "DD"]), *block("u", ["CC", "CC"])]
    assert settled(spark, used)[3] == ("BB", True)  # of BB and CC only BB is free


def test_checks_of_blocks_replace_sums(spark):
    rows = [("district", "a", False, "AA", 3.0), ("district", "b", False, "AA", 4.0), ("district", "Total", True, "AA", 7.0), ("district", "c", False, "BB", 5.0), ("district", "Total", True, "BB", 50.0), ("district", "d", False, None, 1.0), ("country", "All", True, None, 1.0)]
    df = spark.createDataFrame([(i, "f", "s", "t", k, e, None, p, x, 2019.0, v, "sum_ok") for i, (k, e, x, p, v) in enumerate(rows)], COLUMNS + ", value double, qc string")
    got = inference.check_blocks(df, ["file", "sheet", "table_title", "year"], "value", F.col("entity") == "rate")
    assert [r["qc"] for r in got.orderBy("pos").collect()] == ["block_ok"] * 3 + ["sum_mismatch"] * 2 + ["unchecked", "sum_ok"]
    assert inference.settle_blocks(df.filter("pos < 0").withColumn("state_inferred", F.lit(False)), "pos", spark.createDataFrame([("AA", 0)], "code string, place int"), 2014, 2020).count() == 0
