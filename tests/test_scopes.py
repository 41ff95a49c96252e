"""Families and heads of tables, and panels of checked figures."""

import itertools

from pyspark.sql import functions as F

from factloom.operators import scopes

SCHEMA = "pos long, file string, sheet string, table_title string, title_key string, column_label string, entity_type string, entity string, state_code string, parent_state_code string, is_total boolean, " \
         "year double, metric string, qc string, value double, capture string, format string"
count = itertools.count()


def fact(**own):
    base = dict(sheet="s", table_title="t", title_key="ipc crimes against women (head-wise)", column_label="Fraud | I", entity_type="state", entity="Estland", state_code="E", parent_state_code=None, is_total=False,
                year=2019.0, metric="cases_registered", qc="sum_ok", value=10.0, capture="2024", format="xls")
    pos = next(count)
    return {"pos": pos, "file": f"f{pos}", **base, **own}


def frame(spark, rows):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], SCHEMA)


def test_titles_and_labels(spark):
    titles = {"fraud against women (head-wise)": "women", "cases registered under larceny": "", "disposal of cases under larceny": None, "district-wise cyber crimes": "cyber", "district-wise missing": None, "rain": None, None: None}
    got = spark.createDataFrame([(k,) for k in titles], "t string").select("t", scopes.scope(F.col("t"))).collect()
    assert dict(map(tuple, got)) == titles
    labels = {"Table 7 | Fraud (Sec.9) | B) Other | I": "Fraud (Sec.9) | B) Other", "2019 | CR": None, "Fraud | Female": None, "Fraud | 18 years": None, "Source: x | Fraud": "Fraud", "": None, None: None}
    got = spark.createDataFrame([(k,) for k in labels], "l string").select("l", scopes.head(F.col("l"))).collect()
    assert dict(map(tuple, got)) == labels
    heads = {"Cases under larceny for crime against women during 2007-12": "Larceny", "Cases under ipc fraud, in india": "IPC fraud", "under a during x under b during": "B", "none": None, None: None}
    got = spark.createDataFrame([(k,) for k in heads], "t string").select("t", scopes.title_head(F.col("t"))).collect()
    assert dict(map(tuple, got)) == heads
    keys = {"Thefts": "theft", "Fraud (Sec.9 IPC)": "fraud", "Fraud (Total)": "fraud total", "Toll Act, 1999": "toll act 1999", "Toll Act": "toll", None: None}
    got = spark.createDataFrame([(k,) for k in keys], "h string").select("h", scopes.head_key(F.col("h"))).collect()
    assert dict(map(tuple, got)) == keys


def test_state_panel(spark):
    district = dict(entity_type="district", state_code=None, parent_state_code="E", qc="block_ok", title_key="district-wise ipc crimes", column_label="Arson")
    rows = [
        fact(), fact(capture="2023"), fact(column_label="Larceny | I", value=5.0), fact(column_label="Larceny | I", value=7.0), fact(column_label="Larceny | I", value=5.0),  # reported twice; disputed
        fact(column_label="Female | I"), fact(qc="sum_mismatch", column_label="Forgery | I"), fact(entity_type="district", column_label="Riot | I"), fact(title_key="disposal of cases", column_label="Riot"), fact(year=None, column_label="Riot"),
        fact(**district, entity="Total", is_total=True, value=40.0), fact(**district, entity="Esthausen", value=9.0), fact(**{**district, "qc": "unchecked"}, entity="Total", is_total=True, value=1.0),
        fact(file="two", column_label="Perjury", value=3.0), fact(file="two", column_label="Perjury", value=4.0),  # a state printed in two parts
        fact(title_key="cases registered under ipc & sll crimes", column_label="Toll Act"), fact(title_key="cases registered under ipc & sll crimes", column_label="Mischief"),
        fact(table_title="Cases registered under Bribery during 2019", title_key="cases registered under bribery during", column_label="2019 | I"), fact(title_key="cyber crimes (state/ut-wise)", column_label="2019"),
        fact(column_label="Tie", value=1.0), fact(**{**district, "column_label": "Tie", "title_key": "district-wise crimes against women"}, entity="Total", is_total=True, value=0.5)]  # a tie: the printed row wins
    got = scopes.state_panel(frame(spark, rows), "pos").collect()
    assert {(r["head"], r["scope"], r["value"], r["disputed"], r["source"]) for r in got} == {
        ("Fraud", "women", 10.0, False, "state_table"), ("Larceny", "women", 5.0, True, "state_table"), ("Arson", "ipc", 40.0, False, "district_total"), ("Perjury", "women", 7.0, False, "state_table"),
        ("Toll Act", "sll", 10.0, False, "state_table"), ("Mischief", "ipc", 10.0, False, "state_table"), ("Bribery", "ipc", 10.0, False, "state_table"), ("Total Cyber Crimes", "cyber", 10.0, False, "state_table"),
        ("Tie", "women", 1.0, True, "state_table")}
    assert {r["file"] for r in got if r["head"] == "Fraud"} == {rows[0]["file"]} and scopes.state_panel(frame(spark, []), "pos").count() == 0


def test_national_panel(spark):
    national = dict(entity_type="crime_head", state_code=None, qc="unchecked", title_key="ipc crimes (head-wise)")
    rows = [fact(**national, entity="Larceny", column_label="2019 | Cases", value=100.0), fact(entity="Total All India", is_total=True, column_label="Robbery", title_key="cases registered under ipc crimes", value=70.0),
            fact(**{**national, "title_key": "cases registered under ipc crimes in ut of westland during"}, entity="Larceny", column_label="2019", value=25.0), fact(**national, entity="Larceny", column_label="Westland", value=99.0),
            fact(**national, entity="Male", column_label="2019", value=1.0), fact(**{**national, "title_key": "ipc crimes in the city during"}, entity="Fraud", column_label="2019", value=8.0), fact(**{**national, "format": "pdf"}, entity="Riot", column_label="2019")]
    got = scopes.national_panel(frame(spark, rows), spark.createDataFrame([("Westland",), (None,)], "name string"), "pos").collect()
    assert {(r["head"], r["scope"], r["value"], r["checked"]) for r in got} == {("Larceny", "ipc", 100.0, False), ("Robbery", "ipc", 70.0, True), ("Fraud", "ipc", 8.0, False)}
