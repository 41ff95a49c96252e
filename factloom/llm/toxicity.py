"""Toxicity by non-negative positive-unlabelled learning: a numpy classifier from confirmed toxic and unlabelled texts.

Features: which of ``features`` selected grams of 5 and 8 letters (over the lower-cased text, other runs one space) a
text has; selected are those that make a text likelier toxic than not. The risk is class-prior-corrected: prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)); where the second term turns
negative, the step goes against it. The model is fitted on a bounded sample (parameters ``positives`` and
``unlabelled``); every whole text is scored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm import textcodes
from factloom.llm.common import K1, mix, ship, tidy, written

ORDER, BITS, SLOTS = 5, 12, 22
#: rows of each kind that a model is fitted on (expected number), and its features
POSITIVES, UNLABELLED, FEATURES = 2500, 6000, 2048
PARTS = 32
#: weight decay of a model of n positives is SHRINK / n, at least DECAY (from 500 positives on)
SHRINK, DECAY = 0.05, 1e-4


@dataclass
class Model:
    grams: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float


def _slots(g: np.ndarray) -> np.ndarray:
    return (mix(g.astype(np.uint64)) >> np.uint64(64 - SLOTS)).astype(np.int64)


def grams_of(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(grams, where they begin): all of 5 letters, packed, and all of 8, hashed."""
    if len(codes) < ORDER:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    five = textcodes.packed(codes, ORDER, BITS)
    four = textcodes.packed(codes, 4, BITS).astype(np.uint64)
    eight = (mix(four[:-4] * K1 + four[4:]) >> np.uint64(2) | np.uint64(1 << 62)).astype(np.int64)
    return np.concatenate([five, eight]), np.concatenate([np.arange(len(five)), np.arange(len(eight))])


def present(texts: list, grams: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) pairs, each once. ``table``: for each hash slot, whether a feature may be there."""
    docs, feats = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i, j in textcodes.groups(texts):
        codes, bounds = textcodes.stream(texts[i:j])
        if len(codes) < ORDER or not len(grams):
            continue
        g, begin = grams_of(codes)
        at = np.flatnonzero(table[_slots(g)])
        k = np.minimum(np.searchsorted(grams, g[at]), len(grams) - 1)
        ok = grams[k] == g[at]
        pair = np.unique((np.searchsorted(bounds, begin[at[ok]], "right") - 1) * len(grams) + k[ok])
        docs.append(pair // len(grams) + i)
        feats.append(pair % len(grams))
    return np.concatenate(docs), np.concatenate(feats)


def slot_table(grams: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << SLOTS, bool)
    table[_slots(grams)] = True
    return table


def nnpu(x_p: np.ndarray, x_u: np.ndarray, prior: float, steps: int = 400, rate: float = 0.05, decay: float = DECAY) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear model under the non-negative PU risk with the logistic loss, by Adam, deterministic."""
    w, b = np.zeros(x_p.shape[1], np.float32), np.float32(0)
    m, v = np.zeros(len(w) + 1, np.float32), np.zeros(len(w) + 1, np.float32)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for t in range(1, steps + 1):
        zp, zu = x_p @ w + b, x_u @ w + b
        sp, su = sig(zp), sig(zu)
        # mean losses: as positive softplus(-z), as negative softplus(z); their slopes are sig(z) - 1 and sig(z)
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gp, gu = (-prior * sp / len(zp), su / len(zu))
        if negative < 0:
            dp, du = -gp, -gu
        else:
            dp, du = prior * (sp - 1) / len(zp) + gp, gu
        grad = np.append(x_p.T @ dp + x_u.T @ du + decay * w, dp.sum() + du.sum()).astype(np.float32)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], np.float32(b - step[-1])
    return w, float(b)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", train: Column | None = None,
        positives: int = POSITIVES, unlabelled: int = UNLABELLED, features: int = FEATURES, shrink: float = SHRINK) -> Model:
    """A model from ``docs`` and ``labels`` of the rows for which ``train`` (a column over the id) holds.

    A document is confirmed toxic if any of its labels is 1; zeros only enter the class prior. Rows without text,
    id or label are skipped. Without a confirmed toxic text the model scores 0 everywhere.

    Little to learn from: a gram is selected only if 4 sampled positives have it and 20 sampled unlabelled texts would
    have it at the positives' rate. With fewer than 4 positives or 20 unlabelled texts (without copies) there is none,
    and the model scores 0 everywhere and rejects nothing; with n_u unlabelled texts, grams in less than 20 / n_u of the
    positives are not used. A handful of positives can also select grams that say nothing; so weights shrink by ``shrink`` over the
    number of positives, so that a few weak grams hardly lift a text over the threshold; from 500 positives on that changes
    nothing. With the 6 positives of sf0.001 no text gets there, clean or toxic.
    """
    ship(docs.sparkSession)
    none = Model(np.zeros(0, np.int64), np.zeros(0, np.float32), -30.0, 0.0)
    train = F.lit(True) if train is None else train
    lab = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter("id is not null and y is not null").groupBy("id").agg(F.max("y").alias("y"))
    lab = lab.withColumnRenamed("id", id_col).filter(train).withColumnRenamed(id_col, "id")
    shape = lab.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("p")).first()
    t = docs.select(F.col(id_col), F.col(text_col).alias("text")).filter(train).withColumnRenamed(id_col, "id")
    n_docs = t.count()
    if not shape["p"] or not n_docs:
        return none
    prior = min(0.9, max(1e-3, shape["p"] / shape["n"]))
    below = lambda share: F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1_000_000)) < int(min(1.0, share) * 1_000_000)
    ids = lab.filter("y = 1").filter(below(positives / shape["p"])).select("id", F.lit(True).alias("p"))  # bounded by ``positives``
    sample = t.filter("text is not null").join(F.broadcast(ids), "id", "left").withColumn("u", F.pmod(F.xxhash64("id", F.lit(8)), F.lit(1_000_000)) < int(min(1.0, unlabelled / n_docs) * 1_000_000)) \
        .select("text", F.coalesce("p", F.lit(False)).alias("p"), "u").filter("p or u")

    def least(batches):
        """Each text with the least hash of its passages of 25 letters: near copies mostly share it, other texts do not."""
        for b in batches:
            texts, low = b.column(0).to_pylist(), []
            for i, j in textcodes.groups(texts):
                codes, bounds = textcodes.stream(texts[i:j])
                g = textcodes.packed(codes, ORDER, BITS).astype(np.uint64) if len(codes) >= ORDER else np.zeros(0, np.uint64)
                h = g[: max(0, len(g) - 20)].copy()
                for k in (5, 10, 15, 20):
                    h = h * K1 + g[k : k + len(h)]
                h = mix(h) >> np.uint64(1)
                low += [int(h[x : y - 26].min()) if y - x > 26 else -zlib.crc32(t.encode('utf-8', 'surrogatepass')) for x, y, t in zip(bounds[:-1], bounds[1:], texts[i:j], strict=True)]
            yield pa.record_batch([*b.columns, pa.array(low, pa.int64())], ["text", "p", "u", "least"])

    # copies of a text say nothing more than the text: one of each is kept on either side
    sample = sample.mapInArrow(tidy(least, release=True), "text string, p boolean, u boolean, least long").dropDuplicates(["least", "p"]).drop("least")
    sample = written(sample.repartition(PARTS, F.xxhash64("text")), "pu-sample")

    def count(batches):
        """Presence counts of grams, as one blob for each part of the gram space."""
        g, pn, un = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        for b in batches:
            texts, p, u = b.column(0).to_pylist(), np.array(b.column(1)), np.array(b.column(2))
            for i, j in textcodes.groups(texts, 1 << 18):
                codes, bounds = textcodes.stream(texts[i:j])
                own = [np.unique(grams_of(codes[x : y - 1])[0]) for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
                n = [len(x) for x in own]
                # added to the counts so far, so that a task holds each gram once and a group's besides
                g, inverse = np.unique(np.concatenate([g, *own]), return_inverse=True)
                pn = np.bincount(inverse, np.concatenate([pn, np.repeat(p[i:j], n)]), len(g)).astype(np.int32)
                un = np.bincount(inverse, np.concatenate([un, np.repeat(u[i:j], n)]), len(g)).astype(np.int32)
                del own, inverse
        part = _slots(g) % PARTS
        for k in range(PARTS):
            own = part == k
            yield pa.record_batch([pa.array([k], pa.int32()), pa.array([g[own].tobytes()]), pa.array([pn[own].tobytes()]), pa.array([un[own].tobytes()])], ["part", "g", "p", "u"])

    n = sample.agg(F.sum(F.col("p").cast("long")).alias("p"), F.sum(F.col("u").cast("long")).alias("u")).first()
    if not n["p"] or not n["u"]:
        return none

    def best(key, tab):
        g, inverse = np.unique(np.concatenate([np.frombuffer(x, np.int64) for x in tab.column("g").to_pylist()]), return_inverse=True)
        p, u = (np.bincount(inverse, np.concatenate([np.frombuffer(x, np.int32) for x in tab.column(c).to_pylist()]), len(g)) for c in ("p", "u"))
        # a gram is worth keeping if, by Bayes with the class prior, texts that have it are likelier toxic than not, and
        # if so few unlabelled texts would be no accident for a gram that says nothing (20 or more expected)
        likely = prior * (p / n["p"]) / ((u + 0.5) / n["u"])
        worth = np.where((p >= 4) & (p * n["u"] >= 20 * n["p"]) & (likely >= 0.6), p * np.minimum(likely, 1), 0)
        top = np.argsort(-worth, kind="stable")[:features]
        top = top[worth[top] > 0]
        return pa.table({"gram": g[top], "worth": worth[top]})

    got = sample.mapInArrow(tidy(count, release=True), "part int, g binary, p binary, u binary").groupBy("part").applyInArrow(tidy(best, release=True), "gram long, worth double") \
        .orderBy(F.desc("worth"), "gram").limit(features).collect()
    grams = np.sort(np.array([r["gram"] for r in got], np.int64))
    if not len(grams):
        return none
    table = slot_table(grams)

    def mark(batches):
        for b in batches:
            doc, feat = present(b.column(0).to_pylist(), grams, table)
            ends = np.searchsorted(doc, np.arange(b.num_rows + 1))
            rows = [feat[x:y].astype(np.int16).tobytes() for x, y in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.record_batch([b.column(1), b.column(2), pa.array(rows, pa.binary())], ["p", "u", "x"])

    rows = sorted(sample.mapInArrow(tidy(mark, release=True), "p boolean, u boolean, x binary").collect())

    def matrix(kind):
        own = [np.frombuffer(r["x"], np.int16) for r in rows if r[kind]]
        x = np.zeros((len(own), len(grams)), np.float32)
        for i, f in enumerate(own):
            x[i, f] = 1
        return x

    x_p = matrix("p")
    # a fixed normal prior of the weights: its part in a mean loss falls with the number of positives
    w, b = nnpu(x_p, matrix("u"), prior, decay=max(DECAY, shrink / len(x_p)))
    return Model(grams, w, b, prior)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7, extra: dict[str, Column] | None = None, keep: list[str] | None = None) -> DataFrame:
    """One row per input row: id, the extra columns, score, predicted (1 from ``threshold`` on).

    A null or empty text has no feature and gets the model's base score. Whole texts count, whatever their length.
    """
    grams, weights, bias, table = model.grams, model.weights.astype(np.float64), model.bias, slot_table(model.grams)
    ship(docs.sparkSession)
    extra, keep = extra or {}, keep or []

    def predict(batches):
        for b in batches:
            doc, feat = present(b.column("_text").to_pylist(), grams, table)
            z = bias + np.bincount(doc, weights[feat], b.num_rows)
            s = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            names = [n for n in b.schema.names if n != "_text"]
            yield pa.record_batch([b.column(n) for n in names] + [pa.array(s), pa.array((s >= threshold).astype(np.int32))], [*names, "score", "predicted"])

    t = docs.select(F.col(id_col), *keep, *[c.alias(n) for n, c in extra.items()], F.col(text_col).alias("_text"))
    schema = ", ".join(f"`{n}` {k}" for n, k in t.drop("_text").dtypes)
    return t.mapInArrow(tidy(predict, release=True), f"{schema}, score double, predicted int")


def reject(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below the threshold."""
    ship(docs.sparkSession)
    grams, weights, bias, table = model.grams, model.weights.astype(np.float64), model.bias, slot_table(model.grams)

    def below(batches):
        for b in batches:
            doc, feat = present(b.column(text_col).to_pylist(), grams, table)
            z = bias + np.bincount(doc, weights[feat], b.num_rows)
            yield b.filter(pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))) < threshold))

    return docs.mapInArrow(tidy(below, release=True), docs.schema)
