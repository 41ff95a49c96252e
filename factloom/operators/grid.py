"""Sheets as long cell tables (file, sheet, r, c, v_str, v_num): merges, empty lines, header blocks, facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.text import clean, number
from factloom.operators.names import unused
from factloom.operators.order import adjacent_distinct, blocks_closed_by, carry_down, forward_fill
from factloom.session import written

ENTITY = r"(?i)^\s*(state|district|city|region|country|nation|crime head|head|name)\b"
INDEX = r"^\s*\(?\d{1,2}\)?\s*$"
SERIAL = r"(?i)^\s*(s\.?\s*no\.?|sl\.?\s*no\.?|serial|no\.)\s*$"
TOTAL = r"(?i)^(grand )?total\b"
NOTE = r"(?i)^((source|note)\b|\*)"
#: what names a block of a table in a sheet
BLOCK = ["file", "sheet", "island", "c0"]


def named_sheets_only(sheets: DataFrame) -> DataFrame:
    """(file, sheet): default-named tabs go if the file has a named one."""
    named = ~F.col("sheet").rlike("^Sheet[0-9]+$")
    n, some = unused(sheets.columns, "named", "some_named")
    return sheets.withColumn(n, named).withColumn(some, F.max(n).over(Window.partitionBy("file"))).filter(F.col(n) | ~F.col(some)).drop(n, some)


def fill_merges(cells: DataFrame, merges: DataFrame, clip: bool = True) -> DataFrame:
    """Text of a merged range's first cell, copied to all its cells; figures are not copied.

    With ``clip``, ranges end at the last row and column that the sheet uses, so that one over a whole sheet costs no more
    than these; without it, cells beyond these get the text, too.
    """
    used = cells.groupBy("file", "sheet").agg(F.max("r").alias("last_r"), F.max("c").alias("last_c"))
    end = lambda last, used_to: F.least(last, used_to) if clip else F.col(last)
    anchor = cells.select("file", "sheet", F.col("r").alias("r0"), F.col("c").alias("c0"), F.col("v_str").alias("anchor")).filter("anchor is not null")
    spread = merges.select("file", "sheet", "r0", "r1", "c0", "c1").join(anchor, ["file", "sheet", "r0", "c0"])
    spread = (spread.join(used, ["file", "sheet"]) if clip else spread) \
        .withColumn("r", F.explode(F.sequence("r0", end("r1", "last_r")))).withColumn("c", F.explode(F.sequence("c0", end("c1", "last_c")))) \
        .groupBy("file", "sheet", "r", "c").agg(F.min("anchor").alias("anchor"))
    out = cells.select("file", "sheet", "r", "c", "v_str", "v_num").join(spread, ["file", "sheet", "r", "c"], "full")
    return out.select("file", "sheet", "r", "c", F.when(F.col("v_num").isNull(), F.coalesce("v_str", "anchor")).otherwise(F.col("v_str")).alias("v_str"), "v_num")


def without_empty_lines(cells: DataFrame) -> DataFrame:
    """Rows and columns without any value vanish and the others are numbered anew from 0."""
    full = cells.filter("v_str is not null or v_num is not null")
    (n,) = unused(full.columns, "place")
    for axis in ("r", "c"):
        full = _numbered(full, axis, n).withColumn(axis, F.col(n)).drop(n)
    return full


def _numbered(df: DataFrame, axis: str, name: str) -> DataFrame:
    """Rows (``axis`` r) or columns (c) that hold a value, numbered from 0 within their sheet. Only the distinct lines pass through the window."""
    n = df.select("file", "sheet", axis).distinct().withColumn(name, F.row_number().over(Window.partitionBy("file", "sheet").orderBy(axis)) - 1)
    return df.join(n, ["file", "sheet", axis])


def header_rows(cells: DataFrame, heads: str = ENTITY) -> DataFrame:
    """(file, sheet, h, blocks) of numbered cells (i, j, v): the rows that head columns of entities, with their side-by-side blocks.

    A cell heads such a column if it begins with one of ``heads`` or stands right of a serial-number cell, has at most
    60 letters, is no column index, and its row has another text. ``blocks`` is an array of (c0, c1, type): a block's columns
    run from its entity column to the next one's, or to the sheet's end.
    """
    text = cells.filter("v is not null").select("file", "sheet", "i", "j", "v")
    short = text.filter((F.length("v") <= 60) & ~F.col("v").rlike(INDEX))
    behind = text.filter(F.col("v").rlike(SERIAL)).select("file", "sheet", "i", (F.col("j") + 1).alias("j"))
    found = short.filter(F.col("v").rlike(heads)).unionByName(short.filter(~F.col("v").rlike(heads)).join(behind, ["file", "sheet", "i", "j"], "left_semi"))
    rows = text.groupBy("file", "sheet", "i").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").drop("texts")
    width = cells.groupBy("file", "sheet").agg((F.max("j") + 1).alias("width"))
    h = found.join(rows, ["file", "sheet", "i"], "left_semi").groupBy("file", "sheet", F.col("i").alias("h")).agg(F.array_sort(F.collect_list(F.struct("j", "v"))).alias("s")).join(width, ["file", "sheet"])
    block = lambda x, k: F.struct(x["j"].alias("c0"), F.coalesce(F.get("s", k + 1)["j"], F.col("width")).alias("c1"), x["v"].alias("type"))
    return h.select("file", "sheet", "h", F.transform("s", block).alias("blocks"))


def islands(cells: DataFrame, heads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tables stacked in a sheet: (file, sheet, island, r0, last, blocks), and the rows (file, sheet, i, island, above) that belong to them.

    Header rows with no row of figures between them head one table (a head that spans rows, or a lower head that looks
    like one of entities); the first of them has its blocks. A row of figures has a figure right of a text; whole numbers
    that may be years do not count. A table's rows run to the next table's head; the four rows over its head belong to it too, as ``above``.
    """
    keys = ["file", "sheet"]
    figure = F.col("n").isNotNull() & _year_text().isNull()
    rows = cells.groupBy(*keys, "i").agg(F.min(F.when(F.col("v").isNotNull() & F.col("n").isNull() & ~F.col("v").rlike(INDEX), F.col("j"))).alias("text"), F.max(F.when(figure, F.col("j"))).alias("figure"))
    rows = rows.join(heads.select(*keys, F.col("h").alias("i"), F.col("h")), [*keys, "i"], "left")
    seg = forward_fill(rows, keys, ["i"], "h", "segment").filter("i > segment").groupBy(*keys, F.col("segment").alias("h")).agg(F.bool_or(F.col("figure") > F.col("text")).alias("full"))
    top = blocks_closed_by(heads.join(seg, [*keys, "h"], "left"), keys, ["h"], F.col("full"), "island")
    top = top.groupBy(*keys, "island").agg(F.min("h").alias("r0"), F.max("h").alias("last"), F.min_by("blocks", "h").alias("blocks"))
    at = rows.select(*keys, "i").join(top.select(*keys, F.col("r0").alias("i"), F.struct("island", "r0").alias("t")), [*keys, "i"], "left")
    w = Window.partitionBy(*keys).orderBy("i")
    own, then = F.last("t", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.first("t", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    at = at.select(*keys, "i", own.alias("own"), then.alias("then"))
    mine = F.when(F.col("own").isNotNull(), F.struct(F.col("own.island").alias("island"), F.lit(False).alias("above")))
    next_ = F.when(F.col("then.r0") - F.col("i") <= 4, F.struct(F.col("then.island").alias("island"), F.lit(True).alias("above")))
    return top, at.select(*keys, "i", F.explode(F.array_compact(F.array(mine, next_))).alias("x")).select(*keys, "i", "x.*")


def _year_text() -> Column:
    """The text of a figure that is a year; other figures in a head are column numbers."""
    n = F.col("n")
    return F.when((n == F.floor(n)) & n.between(1950, 2035), n.cast("int").cast("string"))


def _labels(laid: DataFrame, hdr: DataFrame, merged: bool) -> DataFrame:
    """(block, j, label): a column's path of head texts, one level per header row, repeats of the level above left out."""
    hdr = hdr.withColumn("final", F.col("i") == F.max("i").over(Window.partitionBy(*BLOCK))).filter("labels > 0").select(*BLOCK, "c1", "i", "final")
    cells = laid.filter("j > c0").select(*BLOCK, "i", "j", F.coalesce(F.when(F.col("n").isNull(), F.col("v")), _year_text()).alias("t")).filter("t is not null")
    full = hdr.withColumn("j", F.explode(F.sequence(F.col("c0") + 1, F.col("c1") - 1))).join(cells, [*BLOCK, "i", "j"], "left")
    years = F.min(F.coalesce(F.col("t").rlike("^(19|20)[0-9]{2}$"), F.lit(True))).over(Window.partitionBy(*BLOCK, "i"))
    spans = ~F.col("final") & (years if merged else F.lit(True))  # with merges filled in, only strips of years still span
    full = forward_fill(full.withColumn("spans", spans), [*BLOCK, "i"], ["j"], "t", "span").withColumn("t", F.when(F.col("spans"), F.col("span")).otherwise(F.col("t"))).filter("t is not null")
    one = adjacent_distinct(full, [*BLOCK, "j"], ["i"], "t")
    return one.groupBy(*BLOCK, "j").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "t"))), lambda x: x["t"]), " | ").alias("label"))


def sheet_facts(cells: DataFrame, heads: str = ENTITY, merged: bool = False) -> DataFrame:
    """Header blocks to facts, one row per figure: tables stacked in a sheet and side by side, by windows over the long cell table.

    A data row has a text in the block's entity column and figures in at least 0.3 of the others. The head of a block runs
    from its header row to the first data row, without index strips such as (1) (2), rows of one repeated text, and rows that
    fill the entity column only; strips over the header row (of the three rows above) belong to it. The title is made of the
    texts in the four rows above, none before the end of the table above, notes and texts of up to 4 letters left out. The context of a data row is the last
    row without figures (its text behind a colon, if there is one) up to the next total. ``merged``: merged ranges were filled in,
    so that only strips of years span columns.

    Rows without file or sheet are left out; of repeated cells the largest text and figure count. A text that is a printed figure is one. Blocks
    without data rows give nothing, nor does an empty table. Other columns are not read. All row work is by sheet or
    block and spills; joins are by sheet and line, so that the optimiser can split a large sheet.
    """
    keys = ["file", "sheet"]
    v, n = F.max(clean(F.col("v_str"))), F.max(F.nanvl("v_num", F.lit(None).cast("double")))
    one = cells.filter("file is not null and sheet is not null").groupBy(*keys, "r", "c").agg(v.alias("v"), n.alias("n")).withColumn("v", F.when(F.col("v") != "", F.col("v")))
    one = one.withColumn("n", F.coalesce("n", number(F.col("v")))).filter("v is not null or n is not null")
    flat = written(_numbered(_numbered(one, "r", "i"), "c", "j"), "cells")
    top, rows = islands(flat, written(header_rows(flat, heads), "heads"))
    top = written(top, "tables")
    laid = flat.join(rows, [*keys, "i"]).join(top, [*keys, "island"])
    first, j = F.get("blocks", F.lit(0)), F.col("j")
    laid = laid.withColumn("lead", F.col("j") < first["c0"]).withColumn("b", F.when(F.col("lead"), first).otherwise(F.get(F.filter("blocks", lambda b: (b["c0"] <= j) & (j < b["c1"])), F.lit(0))))
    laid = laid.filter("above or not lead").select(*keys, "island", "b.c0", "b.c1", "b.type", "r0", "last", "above", "lead", "i", "j", "r", "c", "v", "n")
    laid = written(laid, "blocks")
    inner = laid.filter("not lead")
    text = F.when(F.col("n").isNull(), F.col("v"))
    line = inner.groupBy(*BLOCK, "c1", "type", "r0", "last", "above", "i").agg(
        F.max(F.when(F.col("j") == F.col("c0"), text)).alias("entity"), F.count(F.when(F.col("j") > F.col("c0"), F.col("n"))).alias("figures"), F.count(F.lit(1)).alias("filled"),
        F.count(F.when(F.coalesce("v", F.format_string("%.0f", "n")).rlike(INDEX), 1)).alias("indices"), F.count(text).alias("texts"), (F.min(text) == F.max(text)).alias("same"),
        F.count(F.when(F.col("j") > F.col("c0"), F.coalesce(text, _year_text()))).alias("labels"), F.max(F.length(text)).alias("longest"))
    line = line.withColumn("banner", (F.col("texts") >= 3) & F.col("same")).withColumn("lone", (F.col("filled") == 1) & F.col("entity").isNotNull())
    wide = F.col("c1") - F.col("c0") - 1
    line = line.withColumn("data", ~F.col("above") & (F.col("i") > F.col("last")) & F.col("entity").isNotNull() & ~F.coalesce(F.col("entity").rlike(INDEX), F.lit(True)) & (F.col("figures") >= F.greatest(F.lit(1), 0.3 * wide)))
    line = written(line, "lines")
    data = line.filter("data")
    begins = data.groupBy(*BLOCK).agg(F.min("i").alias("begin"))
    ends = data.groupBy(*keys, "island").agg(F.max("i").alias("end"))
    before = Window.partitionBy(*keys).orderBy("island").rowsBetween(Window.unboundedPreceding, -1)
    ends = top.select(*keys, "island").join(ends, [*keys, "island"], "left").withColumn("free", F.coalesce(F.max("end").over(before) + 1, F.lit(0))).drop("end")
    line = line.join(begins, BLOCK).join(ends, [*keys, "island"])
    strip = F.col("above") & (F.col("i") >= F.greatest("free", F.col("r0") - 3)) & (F.col("labels") > 0) & (F.coalesce("longest", F.lit(0)) < 80)
    head = ~F.col("above") & (F.col("i") < F.col("begin")) & (F.col("indices") < 2) & (~F.col("lone") | (F.col("i") == F.col("r0")))
    labels = _labels(inner, line.filter((strip | head) & ~F.coalesce("banner", F.lit(False))), merged)
    titles = laid.filter("above").join(ends, [*keys, "island"]).filter((F.col("i") >= F.col("free")) & (F.length(text) > 4) & ~F.col("v").rlike(NOTE))
    titles = titles.groupBy(*BLOCK, "v").agg(F.min(F.struct("i", "lead", "j")).alias("at")).groupBy(*BLOCK).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda x: x["v"]), " ").alias("title"))
    below = line.filter(~F.col("above") & (F.col("i") > F.col("r0")) & ((F.col("i") >= F.col("begin")) | F.col("lone")))
    colon = F.trim(F.regexp_extract("entity", "^[^:]*:(.*)$", 1))
    says = F.when(~F.col("data") & ~F.col("entity").rlike(NOTE) & ~F.col("entity").rlike(INDEX), F.when(F.col("entity").contains(":"), colon).otherwise(F.col("entity")))
    total = F.col("entity").rlike(TOTAL)
    rows = carry_down(below, BLOCK, ["i"], says, F.col("data") & total).filter("data").select(*BLOCK, "i", "entity", "context", F.coalesce(total, F.lit(False)).alias("is_total"))
    facts = inner.filter("not above and j > c0 and n is not null").join(rows, [*BLOCK, "i"]).join(labels, [*BLOCK, "j"], "left").join(titles, BLOCK, "left")
    return facts.select(*keys, F.substring(F.coalesce("title", F.lit("")), 1, 400).alias("title"), F.col("type").alias("entity_type"), "entity", "context", "is_total", F.coalesce("label", F.lit("")).alias("label"),
                        F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c"), F.col("n").alias("value"))


def text_rows(pages: DataFrame, col: str, keys: list[str]) -> DataFrame:
    """Rows `serial? name figures+` of text pages; rows whose number of figures is the page's most frequent stay."""
    line = pages.select(*keys, F.posexplode(F.split(col, "\n")).alias("line", "t"))
    figures = r"((?:\s+(?:-{1,2}|NA|[0-9][0-9,]*(?:\.[0-9]+)?))+)\s*$"
    t = line.select(*keys, "line", F.regexp_extract("t", r"^\s*([0-9]{1,3})[.)]?\s+[A-Za-z]", 1).alias("serial"), F.trim(F.regexp_extract("t", r"^\s*(?:[0-9]{1,3}[.)]?\s+)?([A-Za-z][A-Za-z &().'-]*?)" + figures, 1)).alias("name"),
                    F.split(F.trim(F.regexp_extract("t", r"[A-Za-z)]" + figures, 1)), r"\s+").alias("figures"))
    k, = unused(t.columns, "figures_in_line")
    t = t.filter((F.col("name") != "") & (F.size("figures") > 0)).withColumn(k, F.size("figures"))
    usual = t.groupBy(*keys).agg(F.mode(k, True).alias(k))
    return t.join(usual, [*keys, k]).drop(k).withColumn("serial", F.when(F.col("serial") != "", F.col("serial").cast("int")))


def unpivot(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Figures as rows (keys, label, value); nulls are left out."""
    return df.unpivot(keys, [F.col(c).cast("double").alias(c) for c in columns], "label", "value").filter("value is not null")
