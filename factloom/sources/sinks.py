"""Sinks and state: split Parquet, sorted CSV, JSON state, profiles as Markdown, capture listings, the catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_split(df: DataFrame, predicate: Column, path: str, yes: str = "trusted", no: str = "low") -> None:
    """Two Parquet tables below ``path``: rows for which the predicate holds, and all others (nulls too)."""
    df.withColumn("split_part", F.when(predicate, yes).otherwise(no)).write.mode("overwrite").partitionBy("split_part").parquet(path)


def read_split(spark: SparkSession, path: str, part: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("split_part") == part).drop("split_part")


def write_csv(df: DataFrame, path: str, order: list[str]) -> None:
    """One CSV file with a header in a fixed order; for published tables, which are small by then."""
    df.coalesce(1).sortWithinPartitions(*order).write.mode("overwrite").option("header", True).csv(path)


def write_state(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """State of the runs before; an empty table before the first."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)
    return spark.read.schema(schema).json(path) if there else spark.createDataFrame([], schema)


def markdown(df: DataFrame, rows: int = 25) -> str:
    """The first rows of a small aggregate as a Markdown table."""
    cell = lambda x: "" if x is None else str(x).replace("|", "\\|").replace("\n", " ")
    lines = ["| " + " | ".join(map(cell, df.columns)) + " |", "|" + " --- |" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join(map(cell, r)) + " |" for r in df.limit(rows).collect()])


def undocumented(columns: DataFrame, documented: DataFrame) -> DataFrame:
    """(table, column, problem): columns without documentation, and documented ones that do not exist."""
    on = ["table", "column"]
    return columns.join(documented, on, "left_anti").select(*on, F.lit("undocumented").alias("problem")).unionByName(documented.join(columns, on, "left_anti").select(*on, F.lit("missing").alias("problem")))


def capture_rows(listing: DataFrame, col: str, keep: str, reject: str, largest: int) -> DataFrame:
    """(url, stamp, digest, bytes) of capture listings: a JSON array of [timestamp, original, status, digest, length] rows
    in column ``col``, the first one a header.

    Only status 200 and urls that match ``keep`` and not ``reject``, of at most ``largest`` bytes (a length that is no
    number counts as 0); of captures with one digest the earliest stays.
    """
    t = listing.select(F.posexplode(F.from_json(col, "array<array<string>>")).alias("pos", "r")).filter("pos > 0")
    t = t.select(F.get("r", F.lit(1)).alias("url"), F.get("r", F.lit(0)).alias("stamp"), F.get("r", F.lit(2)).alias("status"), F.get("r", F.lit(3)).alias("digest"), F.coalesce(F.get("r", F.lit(4)).try_cast("long"), F.lit(0)).alias("bytes"))
    t = t.filter((F.col("status") == "200") & F.col("url").rlike(keep) & ~F.col("url").rlike(reject) & (F.col("bytes") <= largest))
    return t.groupBy("digest").agg(F.min(F.struct("stamp", "url", "bytes")).alias("x")).select("x.url", "x.stamp", "digest", "x.bytes")


def permalink(stamp: Column, url: Column, archive: str) -> Column:
    """The archive's address of a capture; null without a stamp."""
    return F.when(F.coalesce(F.length(stamp), F.lit(0)) > 0, F.concat(F.lit(archive), stamp, F.lit("/"), url))


def documents(manifest: DataFrame, facts: DataFrame, archive: str, parsed: list[str]) -> DataFrame:
    """The catalogue: one row per stored file of ``manifest`` (file, url, stamp, publisher): what it is, its captures, and
    what became of it (``facts``: file, trusted)."""
    m = manifest.withColumn("stamp", F.when(F.col("stamp") != "", F.col("stamp")))
    first, last = F.struct(F.coalesce("stamp", F.lit("")), "url"), F.struct(F.coalesce("stamp", F.lit("")), "url")
    g = m.groupBy("file").agg(F.min_by(F.struct("publisher", "url"), first).alias("a"), F.max_by(F.struct("stamp", "url"), last).alias("z"), F.countDistinct("url").alias("n_urls"), F.min("stamp").alias("s0"), F.max("stamp").alias("s1"))
    n = facts.groupBy("file").agg(F.count(F.lit(1)).alias("n_facts"), F.count(F.when(F.col("trusted"), 1)).alias("n_trusted"))
    ext = F.lower(F.element_at(F.split("file", r"\."), -1))
    status = F.when(F.col("n_trusted") > 0, "facts").when(F.col("n_facts") > 0, "facts_low_confidence").when(ext.isin(parsed), "no_tables_found").otherwise("not_parsed")
    return g.join(n, "file", "left").select("file", ext.alias("ext"), F.col("a.publisher").alias("publisher"), F.col("a.url").alias("source_url"), permalink(F.col("z.stamp"), F.col("z.url"), archive).alias("permalink"),
                                            F.substring("s0", 1, 8).alias("first_capture"), F.substring("s1", 1, 8).alias("last_capture"), "n_urls", F.coalesce("n_facts", F.lit(0)).alias("n_facts"), status.alias("status"))
