"""Incremental runs over files: only new ones, parsers by version, snapshots."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def take_new_files(spark: SparkSession, folder: str, pattern: str, parse: Callable[[DataFrame], DataFrame], out: str, state: str, at_once: int = 1000) -> None:
    """Parses the files below ``folder`` that no run with the checkpoint ``state`` has taken, and appends to ``out``.

    ``parse`` gets (path, modificationTime, length, content). A run that is stopped goes on where it was, ``at_once``
    files at a time; a file is taken once. Each batch replaces its own folder, so that a repeated batch adds nothing.
    """
    files = spark.readStream.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", at_once)
    stream = files.schema("path string, modificationTime timestamp, length long, content binary").load(folder)
    keep = lambda batch, n: parse(batch).write.mode("overwrite").parquet(f"{out}/batch={n}")
    stream.writeStream.option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()


def stale(parsed: DataFrame, versions: dict[str, int], stored: DataFrame) -> DataFrame:
    """Files (file, ext, version) that a parser of another version has read and that are still stored: to be read again."""
    now = F.create_map(*[F.lit(x) for kv in sorted(versions.items()) for x in kv])
    return parsed.filter(~F.col("version").eqNullSafe(F.try_element_at(now, F.col("ext")))).join(stored.select("file").distinct(), "file", "left_semi")


def without_stale(facts: DataFrame, gone: DataFrame) -> DataFrame:
    """Facts of all files but those that are read again."""
    return facts.join(gone.select("file"), "file", "left_anti")


def due_snapshots(listed: DataFrame, done: DataFrame) -> DataFrame:
    """Snapshots (feed, stamp) whose ledger key feed@stamp is not in ``done`` (key)."""
    return listed.withColumn("key", F.concat_ws("@", "feed", "stamp")).join(done.select("key"), "key", "left_anti")
