"""Composed operators on small hand-made tables: stacked blocks, votes, places, news, files, state."""

import pytest

from factloom.operators import news, order, panels, places
from factloom.sources import sinks, store
from factloom.streaming import files


def test_stacked_blocks_take_their_majority(spark):
    """Two sheets: an unplaced row and the total take the block's code, one inferred outlier yields to four rows, a printed one stays."""
    rows = [("s1", i, c, inf, tot) for i, (c, inf, tot) in enumerate([("A", False, False), ("A", False, False), ("A", True, False), ("A", True, False), ("B", True, False), (None, False, False), (None, False, True),
                                                                     ("C", False, False), ("C", False, False), ("C", False, False), ("C", False, False), ("D", False, False), (None, False, True)])]
    rows += [("s2", 0, "E", True, False), ("s2", 1, None, False, True), ("s2", 2, None, False, False), ("s2", 3, None, False, True)]
    df = spark.createDataFrame(rows, "sheet string, pos int, code string, inferred boolean, total boolean")
    from pyspark.sql import functions as F

    got = {(r["sheet"], r["pos"]): (r["placed"], r["changed"]) for r in panels.label_blocks(df, ["sheet"], ["pos"], "code", F.col("total"), F.col("inferred")).collect()}
    assert [got["s1", i][0] for i in range(7)] == ["A"] * 7 and got["s1", 4] == ("A", True) and got["s1", 0] == ("A", False)
    assert got["s1", 11] == ("D", False) and got["s1", 12] == ("C", True)
    assert [got["s2", i][0] for i in range(4)] == ["E", "E", None, None]
    assert panels.label_blocks(df.limit(0), ["sheet"], ["pos"], "code", F.col("total"), F.col("inferred")).count() == 0


def test_votes_carry_a_row(spark):
    from pyspark.sql import functions as F

    rows = [("k", 1.0, 1, "2020", 1, False), ("k", 1.0, 0, None, 2, False), ("k", 1.0, 0, "2019", 3, True), ("k", 2.0, 0, "2022", 4, False), ("j", 5.0, 1, "2020", 5, False), ("j", 6.0, 0, "2020", 6, False), ("n", None, 0, "2020", 7, True)]
    df = spark.createDataFrame(rows, "key string, value double, pri int, seen string, row int, ok boolean")
    got = {r["key"]: r for r in panels.collapse(df, ["key"], "value", "pri", "seen", "row", F.col("ok")).collect()}
    assert (got["k"]["value"], got["k"]["row"], got["k"]["votes"], got["k"]["checked"], got["k"]["disputed"]) == (1.0, 3, 3, True, True)
    assert (got["j"]["value"], got["j"]["disputed"]) == (6.0, True) and "n" not in got


def test_the_state_of_a_place(spark):
    found = spark.createDataFrame([("one", "X", 5, "city"), ("two", "X", 9, "district"), ("two", "Y", 1, "district"), ("three", "X", 9, "city"), ("three", "Y", 2, "district"), ("near", "X", 9, "city"), ("near", "Y", 8, "city")], "name string, state string, population int, kind string")
    votes = spark.createDataFrame([("one", "Y", 6), ("near", "Y", 5)], "name string, state string, n int")
    names = spark.createDataFrame([("one", 2000, False), ("two", 2000, False), ("two", 2000, True), ("three", 2000, False), ("three", 2020, False), ("near", 2020, False), ("none", 2020, False)], "name string, year int, metro boolean")
    got = {(r["name"], r["year"], r["metro"]): r["state"] for r in places.state_of(names, found, votes, successors=[("X", 2014, "W")]).collect()}
    assert got == {("one", 2000, False): None, ("two", 2000, False): None, ("two", 2000, True): "W", ("three", 2000, False): "W", ("three", 2020, False): "X", ("near", 2020, False): "Y", ("none", 2020, False): None}
    assert places.state_of(names, found, votes, veto=False).filter("name = 'one'").first()["state"] == "X"


def test_a_failing_labeller_costs_only_its_labels(spark):
    df = spark.createDataFrame([("a", "x", "other", "rules"), ("b", None, "other", "rules"), ("c", "y", "other", "model"), ("d", "boom", "other", "rules")], "url string, title string, label string, labeller string")

    def labeller(texts):
        if "boom" in texts:
            raise ValueError
        return ['```json\n{"keep": false, "label": "good"}\n```' for _ in texts]

    got = {r["url"]: (r["label"], r["labeller"], r["dropped"]) for r in news.refine(df, labeller, ["good"], batch=1).collect()}
    assert got == {"a": ("good", "model", True), "b": ("other", "rules", False), "c": ("other", "model", False), "d": ("other", "rules", False)}


def test_a_second_run_takes_new_files_only(spark, tmp_path):
    from pyspark.sql import functions as F

    (tmp_path / "in").mkdir()
    parse = lambda b: b.select(F.regexp_extract("path", "[^/]+$", 0).alias("file"), F.col("content").cast("string").alias("text"))
    run = lambda: files.take_new_files(spark, f"{tmp_path}/in", "*.txt", parse, f"{tmp_path}/out", f"{tmp_path}/state")
    for name, text in (("a.txt", "1"), ("b.txt", "2")):
        (tmp_path / "in" / name).write_text(text)
        run()
    run()
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").select("file", "text").collect())) == [("a.txt", "1"), ("b.txt", "2")]


def test_state_markdown_and_swaps(spark, tmp_path):
    df = spark.createDataFrame([("a|b", 1), (None, 2)], "k string, n int")
    assert sinks.markdown(df.orderBy("n")) == "| k | n |\n| --- | --- |\n| a\\|b | 1 |\n|  | 2 |"
    assert sinks.read_state(spark, f"{tmp_path}/none", "k string").count() == 0
    path = f"file://{tmp_path}/t"
    store.replace_table(df, path)
    (tmp_path / "t").rename(tmp_path / "t.old")  # a run that stopped between its two renames
    store.recover_table(spark, path)
    assert spark.read.parquet(path).count() == 2
    store.replace_table(df.limit(1), path)
    assert spark.read.parquet(path).count() == 1 and not (tmp_path / "t.old").exists()


@pytest.mark.parametrize("name", ["changed", "ends", "carried", "segment", "before", "place", "behind", "free", "is_total_row", "block_rows"])
def test_helper_columns_leave_the_users_alone(spark, name):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "pos int, v string").withColumn(name, F.lit("mine"))
    for out in (order.run_id(df, [], ["pos"], "v"), order.blocks_closed_by(df, [], ["pos"], F.col("pos") == 2), order.carry_down(df, [], ["pos"], F.col("v"), F.col("pos") == 2), order.adjacent_distinct(df, [], ["pos"], "v")):
        assert {r[name] for r in out.collect()} == {"mine"}
    if name != "changed":  # a column that label_blocks adds
        coded = df.withColumn("code", F.when(F.col("pos") != 2, F.col("pos")))
        codes = spark.createDataFrame([(1,), (2,), (3,)], "code int")
        for out in (order.elimination_fill(coded.withColumn("s", F.lit(1)), ["s"], ["pos"], "code", codes.withColumn("s", F.lit(1))), panels.label_blocks(coded.withColumn("s", F.lit(1)), ["s"], ["pos"], "code", F.lit(False), F.lit(False))):
            assert {r[name] for r in out.collect()} == {"mine"}


def test_a_merge_over_a_whole_sheet(spark):
    from factloom.operators import grid

    cells = spark.createDataFrame([("f", "s", 0, 0, "head", None), ("f", "s", 2, 3, None, 1.0)], "file string, sheet string, r int, c int, v_str string, v_num double")
    merges = spark.createDataFrame([("f", "s", 0, 1_048_575, 0, 16_383)], "file string, sheet string, r0 int, r1 int, c0 int, c1 int")
    got = {(r["r"], r["c"]): (r["v_str"], r["v_num"]) for r in grid.fill_merges(cells, merges).collect()}
    assert got == {(r, c): ("head", None) if (r, c) != (2, 3) else (None, 1.0) for r in range(3) for c in range(4)}


def test_streams_continue_with_late_rows(spark, tmp_path):
    """Two runs with one checkpoint: repeats across runs go, closed windows are written once, too late rows are dropped."""
    from factloom.streaming import events

    schema = "ts timestamp, k string, value double"
    drops = [[("2024-01-01 00:10", "a", 1.0), ("2024-01-01 00:20", "a", 2.0), ("2024-01-01 05:00", "b", 3.0)],
             [("2024-01-01 05:10", "b", 4.0), ("2024-01-01 00:30", "a", 9.0), ("2024-01-02 12:00", "c", 5.0)], [("2024-01-03 12:00", "d", 6.0)]]
    (tmp_path / "in").mkdir()

    def run():
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in/*")
        events.closed_windows(stream, "1 hour", ["k"], "1 hour", f"{tmp_path}/w", f"{tmp_path}/ws")
        events.first_within(stream, ["k"], "1 hour", f"{tmp_path}/d", f"{tmp_path}/ds")

    for i, rows in enumerate(drops):
        spark.sql(f"select cast(ts as timestamp) ts, k, cast(value as double) value from values {', '.join(map(str, rows))} as t(ts, k, value)").write.parquet(f"{tmp_path}/in/{i}")
        run()
    run()
    windows = sorted((str(r["start"]), r["k"], r["n"], r["v"]) for r in spark.read.parquet(f"{tmp_path}/w").collect())
    assert windows == [("2024-01-01 00:00:00", "a", 2, 3.0), ("2024-01-01 05:00:00", "b", 2, 7.0), ("2024-01-02 12:00:00", "c", 1, 5.0)]  # that of d is open still
    assert sorted(r["k"] for r in spark.read.parquet(f"{tmp_path}/d").collect()) == ["a", "b", "c", "d"]
