import pytest


@pytest.fixture
def docs(spark):
    """Rows (doc_id, text) as documents with extra columns, some of clashing names."""
    from pyspark.sql import functions as F

    def make(rows, parts=3):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        return df.select("*", *[F.lit(None).cast("string").alias(c) for c in ("lang", "id", "d", "h", "th", "spans", "source")])

    return make
