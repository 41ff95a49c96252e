"""Sessions: a local one for tests and benches, and shipping the package to executors that lack it."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", memory: str = "8g", shuffle_partitions: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("factloom")
        .config("spark.sql.shuffle.partitions", shuffle_partitions).config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Adds this package to the Python path of the executors, once a session: they need no installation."""
    sc = spark.sparkContext
    if getattr(sc, "_factloom_shipped", False):
        return
    root = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="factloom-"), "factloom.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    sc.addPyFile(path)
    sc._factloom_shipped = True


def shared_dir(spark: SparkSession, tag: str) -> str:
    """A fresh folder's URI below spark.checkpoint.dir; only where that is unset (tests on one machine) a local one is set."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="factloom-shared-")
        sc.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{tag}-{uuid.uuid4().hex[:12]}"


#: whether the shuffle files of a query go when it ends, not when the driver happens to collect its garbage
FILES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage is cut and survives a lost executor. The shuffle files behind it go at once."""
    spark = df.sparkSession
    path = shared_dir(spark, tag)
    before = spark.conf.get(FILES_GO, "false")
    spark.conf.set(FILES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FILES_GO, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes the folder of a table made by ``written`` that nothing will read any more."""
    spark = df.sparkSession
    for name in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(name).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
