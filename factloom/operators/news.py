"""News items: taking new ones in, and refining their labels by a function that someone else supplies."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.classify import allowed
from factloom.operators.reconcile import upsert


def ingest(new: DataFrame, known: DataFrame, rejected: DataFrame, wanted: Column, label: Column, hide: Column, order: str, key: str = "url", masked: tuple[str, ...] = ("title", "summary")) -> DataFrame:
    """New items (by ``key``) that are wanted and neither rejected nor known, labelled, with the ``masked`` columns withheld
    where ``hide`` (over the columns and ``label``) holds, together with the known ones. Of new items with one key the last
    by ``order`` counts. Masking comes last: label and ``hide`` see the whole text."""
    t = new.join(rejected.select(key), key, "left_anti").join(known.select(key), key, "left_anti").filter(F.coalesce(wanted, F.lit(False))).withColumn("label", label)
    t = t.groupBy(key).agg(F.max_by(F.struct(*[c for c in t.columns if c != key]), F.col(order)).alias("r")).select(key, "r.*")
    secret = F.coalesce(hide, F.lit(False))
    return known.unionByName(t.withColumn("hidden", secret).select(*[c for c in t.columns if c not in masked], "hidden", *[F.when(~F.col("hidden"), F.col(c)).alias(c) for c in masked]), allowMissingColumns=True)


def refine(items: DataFrame, labeller: Callable[[list[str]], list[str | None]], closed: list[str], text: str = "title", label: str = "label", by: str = "labeller", batch: int = 30) -> DataFrame:
    """Labels proposed by ``labeller``: a function from up to ``batch`` texts to one reply each, JSON (in a code fence or
    not) like {"keep": true, "label": "x"}.

    Items that another labeller than ``rules`` has done, or without a text, are left alone. A label is taken only from the
    ``closed`` list; a reply that is missing, broken or raises leaves the rule's label. Adds ``dropped``: whether the
    reply says that the item is not wanted (the caller remembers those as rejected).
    """
    def ask(batches):
        for b in batches:
            texts, out = b.column("asked").to_pylist(), []
            todo = [i for i, x in enumerate(texts) if x is not None]
            replies: dict[int, str | None] = {}
            for k in range(0, len(todo), batch):
                own = todo[k : k + batch]
                try:
                    replies.update(zip(own, labeller([texts[i] for i in own]), strict=True))
                except Exception:  # a labeller that fails costs its labels, never the run
                    continue
            out = [replies.get(i) for i in range(len(texts))]
            yield pa.record_batch([*[b.column(n) for n in b.schema.names if n != "asked"], pa.array(out, pa.string())], [*[n for n in b.schema.names if n != "asked"], "reply"])

    t = items.withColumn("asked", F.when(F.col(by) == "rules", F.col(text)))
    t = t.mapInArrow(ask, ", ".join(f"`{n}` {k}" for n, k in t.drop("asked").dtypes) + ", reply string")
    reply = F.from_json(F.regexp_replace("reply", r"(?s)^\s*```[a-z]*\s*|\s*```\s*$", ""), "keep boolean, label string")
    t = t.withColumn("answer", reply)
    got = allowed(F.col("answer.label"), closed)
    return t.select(*[c for c in items.columns if c not in (label, by)], F.coalesce(got, F.col(label)).alias(label), F.when(got.isNotNull(), "model").otherwise(F.col(by)).alias(by), F.coalesce(~F.col("answer.keep"), F.lit(False)).alias("dropped"))


def relabel_backlog(items: DataFrame, better: DataFrame, key: str = "url", by: str = "labeller") -> DataFrame:
    """Items still labelled by rules take the rows of ``better`` with their key; all others stay."""
    due = items.filter(F.col(by) == "rules").select(key)
    return upsert(items, better.join(due, key, "left_semi"), key)
