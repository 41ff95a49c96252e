"""Language ID by rank-order profiles: a text's most frequent n-grams against each language's, by out-of-place distance."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.llm import textcodes
from factloom.llm.common import ship

#: n-grams of 1 to 3 letters; ranks kept in a profile; documents a language is learned from at most (expected number)
ORDERS, RANKS, SAMPLE = (1, 2, 3), 400, 2500


def gram_counts(codes: np.ndarray, piece: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, counts) of one text's codes (without breaks); long texts are counted piece by piece."""
    parts = []
    for a in range(0, max(1, len(codes)), piece):
        c = codes[a : a + piece + max(ORDERS) - 1]
        last = a + piece >= len(codes)
        g = [textcodes.packed(c, n, 21)[: None if last else piece] for n in ORDERS if len(c) >= n]
        g = np.concatenate(g) if g else np.zeros(0, np.int64)
        parts.append(np.unique(g[g != textcodes.SPACE], return_counts=True))
    if len(parts) == 1:
        return parts[0]
    grams, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return grams, np.bincount(inverse, np.concatenate([p[1] for p in parts])).astype(np.int64)


def ranked(grams: np.ndarray, counts: np.ndarray, ranks: int) -> np.ndarray:
    """The most frequent n-grams, best first; ties by the n-gram."""
    return grams[np.argsort(-counts, kind="stable")[:ranks]]


def fit(train: DataFrame, text_col: str = "text", lang_col: str = "lang", ranks: int = RANKS, sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """Profiles: language -> its ``ranks`` most frequent n-grams.

    Learned from rows with a language and a text, ``sample`` rows a language in expectation (all, where there are
    fewer), chosen by a hash of the row. The driver gets languages x ranks values.
    """
    ship(train.sparkSession)
    t = train.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in t.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return {}
    share = reduce(lambda c, kv: c.when(F.col("lang") == kv[0], int(min(1.0, sample / kv[1]) * 1_000_000)), sorted(sizes.items()), F.when(F.lit(False), 0))
    t = train.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.pmod(F.xxhash64(*train.columns), F.lit(1_000_000)).alias("u")) \
        .filter("text is not null and lang is not null").filter(F.col("u") < share).select("text", "lang")

    def count(batches):
        for b in batches:
            texts, langs, out = b.column(0).to_pylist(), b.column(1).to_pylist(), []
            for lang in sorted(set(langs)):
                own = [x for x, y in zip(texts, langs, strict=True) if y == lang]
                per = []
                for i, j in textcodes.groups(own):
                    codes, bounds = textcodes.stream(own[i:j])
                    per += [gram_counts(codes[p : q - 1]) for p, q in zip(bounds[:-1], bounds[1:], strict=True)]
                grams, inverse = np.unique(np.concatenate([p[0] for p in per]), return_inverse=True)
                n = np.bincount(inverse, np.concatenate([p[1] for p in per])).astype(np.int64)
                out.append(pa.record_batch([pa.array([lang] * len(grams)), pa.array(grams), pa.array(n)], ["lang", "gram", "n"]))
            yield from out

    counts = t.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    top = counts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).filter(F.col("rank") <= ranks)
    profiles: dict[str, list] = {}
    for r in sorted(top.collect(), key=lambda r: (r["lang"], r["rank"])):
        profiles.setdefault(r["lang"], []).append(r["gram"])
    return {k: np.array(v, np.int64) for k, v in profiles.items()}


def classify(docs: DataFrame, profiles: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text", ranks: int = RANKS, extra: dict[str, Column] | None = None) -> DataFrame:
    """One row per input row: id, the extra columns, lang_pred, score = 1 - distance / largest distance.

    ``und`` with score 0 if the text is null or has no letter, or nothing was learned. Of languages at one
    distance the first by name wins. Whole texts count, whatever their length; other columns are ignored.
    """
    langs = sorted(profiles)
    grams = np.unique(np.concatenate([profiles[k] for k in langs])) if langs else np.zeros(0, np.int64)
    place = np.full((len(grams) + 1, max(1, len(langs))), ranks, np.int32)  # the last row: in no profile
    for k, lang in enumerate(langs):
        place[np.searchsorted(grams, profiles[lang]), k] = np.arange(len(profiles[lang]))
    extra = extra or {}

    def predict(batches):
        for b in batches:
            texts, names, scores = b.column("text").to_pylist(), [], []
            for i, j in textcodes.groups(texts):
                codes, bounds = textcodes.stream(texts[i:j])
                for p, q in zip(bounds[:-1], bounds[1:], strict=True):
                    own = codes[p : q - 1]
                    if len(own) < 2 or not langs:
                        names.append("und")
                        scores.append(0.0)
                        continue
                    top = ranked(*gram_counts(own), ranks)
                    at = np.searchsorted(grams, top)
                    at[grams[np.minimum(at, len(grams) - 1)] != top] = len(grams)
                    found = place[at]
                    far = np.where(found == ranks, ranks, np.abs(found - np.arange(len(top), dtype=np.int32)[:, None])).sum(0)
                    k = int(far.argmin())
                    names.append(langs[k])
                    scores.append(1.0 - float(far[k]) / (ranks * len(top)))
            keep = [n for n in b.schema.names if n != "text"]
            yield pa.record_batch([b.column(n) for n in keep] + [pa.array(names, pa.string()), pa.array(scores, pa.float64())], [*keep, "lang_pred", "score"])

    ship(docs.sparkSession)
    t = docs.select(F.col(id_col), *[c.alias(n) for n, c in extra.items()], F.col(text_col).alias("text"))
    schema = ", ".join(f"`{n}` {k}" for n, k in t.drop("text").dtypes)
    return t.mapInArrow(predict, f"{schema}, lang_pred string, score double")
