"""Exact dedup: group by a 128-bit content hash, compare bytes inside the groups, keep one stable id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import if_small, unused, written

#: repeated hashes up to this count are broadcast when copies are dropped
BROADCAST_GROUPS = 200_000


def _classes(t: DataFrame, best) -> DataFrame:
    """One row per distinct text of ``t`` (id, text, h): compared byte by byte within a hash."""
    return written(
        t.groupBy("h", "text").agg(best("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("h", "keep_id", "group_size", F.unhex(F.sha2("text", 256)).alias("sha")), "exact-classes")


def _clashes(classes: DataFrame) -> bool:
    """Whether two texts share a hash."""
    return not classes.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    The group is the MD5 of the text (128 bits); rows are aggregated by (hash, text), so texts of one hash
    are compared byte by byte and a collision falls apart into classes. Partial aggregation collapses the
    copies of a hot text within each map task. A null text equals the empty text. Null ids are never
    preferred; if a group has only null ids, keep_id is null. Rows that repeat both id and text tie: all of
    them carry kept = true (they are the same row). Extra columns are ignored; an empty table gives none.
    """
    best = {"min": F.min, "max": F.max}[keep]
    t = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    t = t.withColumn("h", F.unhex(F.md5("text")))
    classes = _classes(t, best)
    rows = t.select("id", "h", F.sha2("text", 256).alias("text_sha256"))
    many = classes.filter("group_size > 1")
    if not _clashes(classes):
        found = rows.join(many.select("h", "keep_id", "group_size"), "h", "left")
    else:  # two texts with one MD5: their classes are told apart by a second, independent digest
        found = rows.join(many.withColumn("text_sha256", F.lower(F.hex("sha"))).drop("sha"), ["h", "text_sha256"], "left")
    keep_id = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return found.select(
        F.col("id").alias(id_col), keep_id.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep_id).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """The rows of ``docs``, all columns, but one row of each group of equal texts: that with the best id.

    Rows that repeat both id and text count as one. A row without id stays only if its whole group has none. Null texts
    equal empty ones. Columns of any name are kept as they are; an empty table gives none.
    """
    best = {"min": F.min, "max": F.max}[keep]
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(docs[id_col].alias("id"), text.alias("text")).withColumn("h", F.unhex(F.md5("text")))
    classes = _classes(own, best)
    h, sha, best_id, found_many = unused(docs.columns, "text_hash", "text_digest", "best_id", "has_copies")
    many = classes.filter("group_size > 1").select(F.col("h").alias(h), F.col("sha").alias(sha), F.col("keep_id").alias(best_id), F.lit(True).alias(found_many))
    rows, on = docs.withColumn(h, F.unhex(F.md5(text))), [h]
    if _clashes(classes):
        rows, on = rows.withColumn(sha, F.unhex(F.sha2(text, 256))), [h, sha]
    else:
        many = many.drop(sha)
    found = rows.join(if_small(many, many.count(), BROADCAST_GROUPS), on, "left")
    alone = found.filter(F.col(found_many).isNull())
    kept = found.filter(F.col(found_many) & F.col(id_col).eqNullSafe(F.col(best_id))).dropDuplicates([id_col, *on])
    return alone.unionByName(kept).select(*docs.columns)
