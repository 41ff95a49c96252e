"""Files as DataFrames: CSV and TSV by schema, XLSX and zip by the standard library, feeds as rows."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions.text import clean, feed_date, without_query
from factloom.session import ship

NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships"}


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


def tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tab-separated, quotes are ordinary characters."""
    return spark.read.schema(schema).option("sep", "\t").option("quote", "").csv(path)


def _column(ref: str) -> int:
    n = 0
    for ch in re.match("[A-Z]+", ref)[0]:
        n = 26 * n + ord(ch) - 64
    return n - 1


def xlsx_cells(content: bytes) -> tuple[list[tuple], list[tuple]]:
    """(cells: sheet, r, c, text, number; merges: sheet, r0, r1, c0, c1) of a workbook."""
    cells, merges = [], []
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", NS):
                shared.append("".join(t.text or "" for t in si.iter(f"{{{NS['m']}}}t")))
        rels = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{{{NS['m']}}}sheet"):
            target = rels[s.get(f"{{{NS['r']}}}id")].lstrip("/")
            root = ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}"))
            for c in root.iter(f"{{{NS['m']}}}c"):
                ref, kind, v = c.get("r"), c.get("t"), c.find("m:v", NS)
                row = int(re.search(r"\d+", ref)[0]) - 1
                if kind == "inlineStr":
                    cells.append((s.get("name"), row, _column(ref), "".join(t.text or "" for t in c.iter(f"{{{NS['m']}}}t")), None))
                elif v is not None and v.text is not None:
                    text = shared[int(v.text)] if kind == "s" else v.text if kind in ("str", "b", "e") else None
                    cells.append((s.get("name"), row, _column(ref), text, None if text is not None else float(v.text)))
            for m in root.iter(f"{{{NS['m']}}}mergeCell"):
                a, b = m.get("ref").split(":")
                merges.append((s.get("name"), *(int(re.search(r"\d+", x)[0]) - 1 for x in (a, b)), *(_column(x) for x in (a, b))))
    return cells, merges


def xlsx(spark: SparkSession, path: str, glob: str = "*.xlsx") -> DataFrame:
    """All cells of all workbooks below ``path``; a workbook that cannot be read gives one row with its error."""
    ship(spark)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for file, content in zip(pdf.path, pdf.content, strict=True):
                try:
                    rows = [(file, *c, None) for c in xlsx_cells(content)[0]]
                except (zipfile.BadZipFile, KeyError, ElementTree.ParseError, ValueError) as e:
                    rows = [(file, None, None, None, None, None, repr(e))]
                yield pd.DataFrame(rows, columns=["file", "sheet", "r", "c", "v_str", "v_num", "error"]).astype({"r": "Int32", "c": "Int32", "v_num": "Float64"})

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")
    return files.mapInPandas(work, "file string, sheet string, r int, c int, v_str string, v_num double, error string")


def zip_members(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """(bundle, member, content) of all zip files below ``path``."""
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for file, content in zip(pdf.path, pdf.content, strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in z.namelist():
                        yield pd.DataFrame({"bundle": [file], "member": [name], "content": [z.read(name)]})

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")
    return files.mapInPandas(work, "bundle string, member string, content binary")


def feed_items(feeds: DataFrame, xml: str, keys: list[str], summary_chars: int = 240) -> DataFrame:
    """Entries of feed documents: title, url (query stripped), published (a date), summary (plain, cut).

    Works on the text by patterns, so a malformed document yields its well-formed items; entries without a date go.
    """
    item = feeds.select(*keys, F.posexplode(F.regexp_extract_all(xml, F.lit(r"(?s)<item[ >](.*?)</item>"), 1)).alias("item_no", "_i"))
    field = lambda tag: F.regexp_replace(F.regexp_extract("_i", rf"(?s)<{tag}[^>]*>(.*?)</{tag}>", 1), r"(?s)^\s*<!\[CDATA\[(.*)\]\]>\s*$", "$1")

    def plain(c):
        for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
            c = F.regexp_replace(c, entity, char)
        return c

    t = item.select(*keys, "item_no", clean(plain(field("title"))).alias("title"), without_query(F.trim(plain(field("link")))).alias("url"), feed_date(field("(?:pubDate|dc:date)")).alias("published"),
                    F.substring(clean(F.regexp_replace(plain(field("description")), "<[^>]*>", " ")), 1, summary_chars).alias("summary"))
    return t.filter("published is not null and url <> ''")
