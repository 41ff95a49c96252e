"""URL filters: host-suffix and path-prefix expressions, equi-joined on short hash prefixes (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import if_small

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: rules up to this count are broadcast; beyond it both sides shuffle on the hash prefix
BROADCAST_RULES = 200_000


def url_parts(url):
    """(host, path) columns: host between the first :// and the next / ? # (A-Z lower-cased), then the path up to ? or #."""
    part = lambda pattern: F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))
    return F.translate(part(r"(?s)^.*?://([^/?#]*)"), UPPER, LOWER), part(r"(?s)^.*?://[^/?#]*([^?#]*)")


def rule_table(spark, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules (action, 'host/path...') in order of precedence among equals: columns action, host, path, rank."""
    rows = [(a, *(r.split("/", 1)[0].translate(str.maketrans(UPPER, LOWER)), "/" + r.split("/", 1)[1] if "/" in r else ""), i) for i, (a, r) in enumerate(rules)]
    return spark.createDataFrame(rows, "action string, host string, path string, rank long")


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per input row: id, host, path, rule (null if none fits), verdict.

    Every url is expanded into host suffixes (of label counts that rules have) times path prefixes (of lengths
    that rules have); an expression equals a rule's expression iff the rule fits. Expressions meet rules by an
    equi-join on the first 32 bits of their SHA-256, then the full digest must agree; the longest rule wins, among
    equals the first. A null url, or one without ://, has an empty host and path and gets the default verdict.
    Repeated rows are judged each; extra columns are ignored.
    """
    rules = rules.withColumn("expr", F.concat("host", F.lit("\n"), "path")).withColumn("digest", F.sha2("expr", 256))
    shape = rules.agg(F.count(F.lit(1)).alias("n"), F.collect_set(F.size(F.split("host", r"\."))).alias("labels"), F.collect_set(F.length("path")).alias("lengths")).first()
    host, path = url_parts(F.col(url_col))
    # the rows get a number within their scan task: it only keeps repeated rows apart through the aggregation
    t = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path")).withColumn("row", F.monotonically_increasing_id())
    labels = F.split("host", r"\.")
    suffix = F.transform(
        F.filter(F.array(*[F.lit(x) for x in sorted(shape["labels"])]).cast("array<int>"), lambda k: (k <= F.size(labels)) & (F.col("host") != "")),
        lambda k: F.array_join(F.slice(labels, F.size(labels) - k + 1, k), "."))
    prefix = F.transform(
        F.filter(F.array(*[F.lit(x) for x in sorted(shape["lengths"])]).cast("array<int>"), lambda k: k <= F.length("path")),
        lambda k: F.substring(F.col("path"), F.lit(1), k))
    exprs = F.flatten(F.transform(suffix, lambda s: F.transform(prefix, lambda p: F.concat(s, F.lit("\n"), p))))
    e = t.withColumn("expr", F.explode_outer(exprs)).withColumn("digest", F.sha2("expr", 256)).withColumn("short", F.substring("digest", 1, 8)).drop("expr")
    r = rules.select(F.substring("digest", 1, 8).alias("short"), F.col("digest").alias("r_digest"), "action", "rank",
                     F.concat("host", "path").alias("rule"))
    fit = e.join(if_small(r, shape["n"], BROADCAST_RULES), "short", "left")
    best = F.max(F.when(F.col("digest") == F.col("r_digest"), F.struct(F.length("rule").alias("len"), (-F.col("rank")).alias("first"), "rule", "action")))
    return fit.groupBy("row", "id", "host", "path").agg(best.alias("best")).select(
        F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict"))
