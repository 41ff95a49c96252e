"""Content-addressed store: ledger, repair plan, catalogue, shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def content_id(content: Column, digits: int = 16) -> Column:
    return F.substring(F.sha2(content.cast("binary"), 256), 1, digits)


def shard(content: Column) -> Column:
    """One of 16 shards, for partitionBy."""
    return F.substring(F.sha2(content.cast("binary"), 256), 1, 1)


def ledger(docs: DataFrame, key: str, content: str) -> DataFrame:
    """One row per stored content: id, references, first key, and whether it is shared or empty."""
    t = docs.withColumn("file", content_id(F.coalesce(content, F.lit("")))).withColumn("_e", F.coalesce(F.length(content), F.lit(0)) == 0)
    g = t.groupBy("file").agg(F.count(F.lit(1)).alias("n_docs"), F.min(key).alias("first_key"), F.bool_or("_e").alias("_e"))
    return g.select("file", "n_docs", "first_key", F.when(F.col("_e"), "empty").when(F.col("n_docs") > 1, "shared").otherwise("single").alias("status"))


def repair_plan(manifest: DataFrame, stored: DataFrame, lost: DataFrame, captured: str, key: str = "file") -> DataFrame:
    """What to fetch again: files of the manifest that are neither stored nor known lost, a captured copy preferred, then the smallest url."""
    missing = manifest.join(stored.select(key).distinct(), key, "left_anti").join(lost.select(key).distinct(), key, "left_anti")
    return missing.groupBy(key).agg(F.min_by("url", F.struct((~F.coalesce(captured, F.lit(False))).alias("x"), "url")).alias("url"), F.bool_or(F.coalesce(captured, F.lit(False))).alias("captured"), F.count(F.lit(1)).alias("n_urls"))


def append_ledger(df: DataFrame, path: str) -> None:
    """Appends; columns that the ledger lacks so far come in with the schema of the new rows (read with mergeSchema)."""
    df.write.mode("append").parquet(path)


def read_ledger(spark, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def recover_table(spark, path: str) -> None:
    """After a swap that did not end: the old table is put back if there is none, else deleted."""
    p = lambda x: spark._jvm.org.apache.hadoop.fs.Path(x)
    fs = p(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(p(f"{path}.old")):
        if fs.exists(p(path)):
            fs.delete(p(f"{path}.old"), True)
        else:
            fs.rename(p(f"{path}.old"), p(path))


def replace_table(df: DataFrame, path: str) -> None:
    """Writes beside the table, then swaps by two renames; for a moment between them there is no table.

    A run that stopped there is mended by the next one (or by ``recover_table``): the old table comes back first. The new
    table is complete before the old one moves, and the old one is deleted last.
    """
    recover_table(df.sparkSession, path)
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf)
    p = lambda x: jvm.org.apache.hadoop.fs.Path(x)
    df.write.mode("overwrite").parquet(f"{path}.new")
    if fs.exists(p(path)):
        fs.rename(p(path), p(f"{path}.old"))
    fs.rename(p(f"{path}.new"), p(path))
    fs.delete(p(f"{path}.old"), True)
