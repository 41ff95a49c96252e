"""Structured Streaming over event files: what is available now is processed, the result read back as a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.session import shared_dir


def read_events(spark: SparkSession, sf_dir: str, schema) -> DataFrame:
    """The events table as a stream; its times become instants (UTC), which watermarks need."""
    table = f"{sf_dir}/events.parquet"
    one_file = not spark.read.format("binaryFile").option("pathGlobFilter", "events.parquet").load(sf_dir).isEmpty()
    reader = spark.readStream.schema(schema)
    stream = reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir) if one_file else reader.parquet(table)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def run_now(stream: DataFrame, mode: str) -> DataFrame:
    """Runs to the end of the available input; in complete mode the last table counts."""
    spark = stream.sparkSession
    out, last = shared_dir(spark, "stream-out"), {"n": -1}

    def keep(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={n}" if mode != "complete" else f"{out}/final")
        last["n"] = n

    q = stream.writeStream.outputMode(mode).option("checkpointLocation", shared_dir(spark, "stream-state")).trigger(availableNow=True).foreachBatch(keep).start()
    q.awaitTermination()
    if last["n"] < 0:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(f"{out}/final") if mode == "complete" else spark.read.schema(stream.schema).parquet(*[f"{out}/batch={k}" for k in range(last["n"] + 1)])


def distinct_keys(events: DataFrame, keys: list[str]) -> DataFrame:
    return run_now(events.select(*keys).dropDuplicates(keys), "append")


def tumbling(events: DataFrame, width: str, keys: list[str], late: str = "1 day") -> DataFrame:
    g = events.withWatermark("ts", late).groupBy(F.window("ts", width), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).alias("v"))
    return run_now(g.select(F.col("window.start").alias("start"), *keys, "n", F.col("v").cast("double").alias("v")), "complete")


def sessions(events: DataFrame, gap: str, keys: list[str], late: str = "1 day") -> DataFrame:
    g = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), *keys).agg(F.count(F.lit(1)).alias("n"))
    return run_now(g.select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), *keys, "n"), "complete")


def _continued(stream: DataFrame, out: str, state: str) -> None:
    """Takes what is available now into ``out`` in append mode and goes on where the checkpoint ``state`` stands.

    A batch that is run again after a failure overwrites its own folder, so each batch is there once.
    """
    def keep(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={n}")

    stream.writeStream.outputMode("append").option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()


def first_within(events: DataFrame, keys: list[str], late: str, out: str, state: str) -> None:
    """Events with new ``keys`` go to ``out``; a key is remembered for ``late`` after its time only, so that the state stays bounded.

    ``events`` has ``ts``. Repeats within ``late`` are dropped, whatever batch they come in; rows that are later than the
    watermark are dropped as well. Runs with one ``state`` continue each other.
    """
    _continued(events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys), out, state)


def closed_windows(events: DataFrame, width: str, keys: list[str], late: str, out: str, state: str) -> None:
    """Counts and sums of tumbling windows, written to ``out`` once the watermark has passed a window's end; then its state goes.

    Runs with one ``state`` continue each other. A row later than ``late`` is in no window; a window that is still open at
    the end of the input is written by the run that closes it.
    """
    g = events.withWatermark("ts", late).groupBy(F.window("ts", width), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).alias("v"))
    _continued(g.select(F.col("window.start").alias("start"), *keys, "n", F.col("v").cast("double").alias("v")), out, state)
