"""Queries take all rows of their tables: held against SQL without filters on the base tables."""

import shutil

from duck import connect, rows

from factloom.plans import catalogue


def whole(sf, name, cut):
    """The query's SQL without the filter ``cut``, if it has one."""
    return rows(connect(sf).execute(catalogue.ORACLES[name].replace(cut, "")).fetchdf())


def test_candidates_come_from_all_parts(spark, sf):
    got = catalogue.QUERIES["candidate_disambiguate"](spark, sf).toPandas()
    assert rows(got) == whole(sf, "candidate_disambiguate", " where p_partkey % 3 = 0")
    assert got["n_candidates"].sum() == connect(sf).execute("select count(*) from (select distinct p_brand, p_type from part)").fetchone()[0]


def test_every_year_has_a_page(spark, sf):
    got = catalogue.QUERIES["text_table_rows"](spark, sf).toPandas()
    assert rows(got) == whole(sf, "text_table_rows", " where year % 2 = 0")
    assert {y % 2 for y in got["year"]} == {0, 1}


def test_sheets_have_all_years(spark, sf, tmp_path):
    """Orders of 1995 to 1998 move to 1992 to 1995 and those of other years stay, so that years lack in between."""
    for n in ("customer", "nation", "region"):
        shutil.copy(f"{sf}/{n}.parquet", tmp_path)
    moved = "case when year(o_orderdate) < 1999 then o_orderdate - interval 3 years else o_orderdate end"
    connect(sf).execute(f"copy (select * replace (cast({moved} as timestamp) as o_orderdate) from orders) to '{tmp_path}/orders.parquet' (format parquet)")
    got = catalogue.QUERIES["sheet_facts"](spark, str(tmp_path)).toPandas()
    assert rows(got) == whole(str(tmp_path), "sheet_facts", " where year >= 1995")
    assert {x[-4:] for x in got["label"]} == {"1992", "1993", "1994", "1995", "1999", "2000", "2001"}


def test_merges_reach_beyond_the_cells_of_a_sheet(spark, sf):
    """All cells of all ranges have text, those below the last row of a sheet and behind its last column, too."""
    got = {(r["sheet"], r["r"], r["c"]) for r in catalogue.QUERIES["merged_cells"](spark, sf).select("sheet", "r", "c").collect()}
    sheet = "select p_brand, cast(floor(p_partkey / 10) as int) * 2 as r, cast(p_partkey % 10 as int) * 3 as c from part where p_partkey % 3 > 0 and p_partkey % 10 % 2 = 0"
    want = {(b, r + i, c + j) for b, r, c in connect(sf).execute(sheet).fetchall() for i in (0, 1) for j in (0, 1)}
    assert want and want <= got


def test_merges_of_all_columns(spark, sf):
    """The text of every cell that has one is in all four cells of its range, whatever its column."""
    got = catalogue.QUERIES["merged_cells"](spark, sf).toPandas()
    assert rows(got) == whole(sf, "merged_cells", " and c % 2 = 0")
    cell = "select p_brand, cast(floor(p_partkey / 10) as int) * 2 as r, cast(p_partkey % 10 as int) * 3 as c, p_type from part where p_partkey % 3 > 0"
    want = {(b, r + i, c + j, v) for b, r, c, v in connect(sf).execute(cell).fetchall() for i in (0, 1) for j in (0, 1)}
    assert {c % 2 for _, _, c, _ in want} == {0, 1} and want <= {(x.sheet, x.r, x.c, x.v_str) for x in got.itertuples()}
