"""Tables in the shared folder."""

import time

from pyspark.sql import functions as F

from factloom.session import FILES_GO, written


def test_shuffle_files_go_once_a_table_is_written(spark):
    files = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().toList().mkString("\n").count("shuffle_")
    keep, own = spark.range(1000).repartition(3).localCheckpoint(), spark.range(100_000).groupBy((F.col("id") % 1000).alias("k")).count()
    spark._jvm.System.gc()  # files of other tests
    time.sleep(2)
    before, conf = files(), spark.conf.get(FILES_GO, "false")
    table = written(own, "gone")
    until = time.time() + 20
    while files() > before and time.time() < until:
        time.sleep(0.2)
    assert files() <= before and spark.conf.get(FILES_GO, "false") == conf
    assert table.count() == own.count() == 1000 and keep.count() == 1000
