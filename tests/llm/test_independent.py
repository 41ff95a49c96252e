"""Trained operators, the pipeline's stages and the join's regions against computations of their own, in plain Python."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from test_brute import ODD, WORDS, corpus, linked, multiset_similarity, text

import corpus_pipeline
from factloom.llm import decontaminate, ngram_join, toxicity
from factloom.llm.common import table
from factloom.llm.queries import QUERIES


def letters(t):
    """Lower-cased letters, every other run one space, a space at both ends."""
    return " " + " ".join("".join(c if c.isalpha() else " " for c in (t or "").lower()).split()) + " " if any(c.isalpha() for c in (t or "").lower()) else " "


def packed(g, bits):
    n = 0
    for c in g:
        n = n << bits | (ord(c) & ((1 << bits) - 1) if bits < 21 else ord(c))
    return n


def ranks(counts, most=400):
    return [g for g, _ in sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:most]]


def language_grams(t):
    s = letters(t)
    return Counter(packed(s[i : i + n], 21) for n in (1, 2, 3) for i in range(len(s) - n + 1) if s[i : i + n] != " ")


def test_language_id_is_the_out_of_place_distance(spark, sf):
    docs = table(spark, sf, "documents").collect()
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 0
    total = {}
    for r in docs:
        if r["text"] is not None and r["lang"] is not None and not held(r["doc_id"]):
            total.setdefault(r["lang"], Counter()).update(language_grams(r["text"]))
    place = {lang: {g: i for i, g in enumerate(ranks(c))} for lang, c in total.items()}
    got = {r["doc_id"]: r for r in QUERIES["op1_language_id"](spark, sf).collect()}
    for r in docs:
        top = ranks(language_grams(r["text"]))
        far = sorted((sum(abs(p[g] - i) if g in p else 400 for i, g in enumerate(top)), lang) for lang, p in place.items())
        want = (far[0][1], 1 - far[0][0] / (400 * len(top))) if top else ("und", 0.0)
        have = got[r["doc_id"]]
        assert (have["lang_pred"], have["held_out"]) == (want[0], held(r["doc_id"])) and have["score"] == pytest.approx(want[1])


MASK = (1 << 64) - 1


def mixed(h):
    h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 & MASK
    h = (h ^ h >> 27) * 0x94D049BB133111EB & MASK
    return h ^ h >> 31


def toxic_grams(t):
    s = letters(t)
    five = {packed(s[i : i + 5], 12) for i in range(len(s) - 4)}
    return five | {mixed((packed(s[i : i + 4], 12) * 0x9E3779B97F4A7C15 + packed(s[i + 4 : i + 8], 12)) & MASK) >> 2 | 1 << 62 for i in range(len(s) - 7)}


def test_toxicity_selection_and_scores(spark, docs):
    rnd = random.Random(21)
    word = lambda: "".join(rnd.choices("abcdefghijklmnoprst", k=rnd.randint(3, 8)))
    rows = []
    for i in range(160):
        w = [word() for _ in range(40)]
        for x in ("vilest", "scoundrel") if i % 4 == 0 else ("kindly", "gentle"):
            w.insert(rnd.randrange(len(w)), x)
        rows.append((i, " ".join(w)))
    rows += [(500 + i, t) for i, t in enumerate(ODD[:5])]
    lab = {i: int(i % 4 == 0) for i in range(0, 160, 2)}
    df = docs(rows)
    model = toxicity.fit(df, spark.createDataFrame(list(lab.items()), "doc_id long, toxic int"))
    assert model.prior == pytest.approx(sum(lab.values()) / len(lab))
    have = [(toxic_grams(t), lab.get(d) == 1) for d, t in rows if t is not None]
    pos = Counter(g for s, p in have if p for g in s)
    unl = Counter(g for s, _ in have for g in s)
    n_p, n_u = sum(p for _, p in have), len(have)
    worth = {g: p * min(1, q) for g, p in pos.items() for q in [model.prior * (p / n_p) / ((unl[g] + 0.5) / n_u)] if p >= 4 and p * n_u >= 20 * n_p and q >= 0.6}
    best = sorted(worth, key=lambda g: (-worth[g], g))[: toxicity.FEATURES]
    assert model.grams.tolist() == sorted(best) and best
    weight = dict(zip(model.grams.tolist(), model.weights.astype(float).tolist(), strict=True))
    for r in toxicity.score(df, model).collect():
        z = model.bias + sum(weight.get(g, 0) for g in toxic_grams(dict(rows)[r["doc_id"]]))
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-6) and r["predicted"] == int(r["score"] >= 0.7)


def test_risk_is_descended_as_by_hand():
    """The same steps with loops over single values: the prior-corrected risk, and the ascent where its second part is negative."""
    rnd = random.Random(22)
    x_p = [[rnd.random() < 0.8, rnd.random() < 0.3] for _ in range(12)]
    x_u = [[rnd.random() < 0.4, rnd.random() < 0.3] for _ in range(30)]
    for prior in (0.3, 0.9):
        w, m, v = [0.0] * 3, [0.0] * 3, [0.0] * 3
        for t in range(1, 41):
            z = lambda x: w[0] * x[0] + w[1] * x[1] + w[2]
            s = lambda y: 1 / (1 + math.exp(-y))
            negative = sum(math.log1p(math.exp(z(x))) for x in x_u) / len(x_u) - prior * sum(math.log1p(math.exp(z(x))) for x in x_p) / len(x_p)
            g = [0.0] * 3
            for kind, xs in (("p", x_p), ("u", x_u)):
                for x in xs:
                    slope = (s(z(x)) if kind == "u" else -prior * s(z(x))) / len(xs)  # of the second part
                    slope = -slope if negative < 0 else slope + (prior * (s(z(x)) - 1) / len(xs) if kind == "p" else 0)
                    for k, f in enumerate((*x, 1)):
                        g[k] += slope * f
            for k in range(3):
                g[k] += 1e-4 * w[k] if k < 2 else 0
                m[k], v[k] = 0.9 * m[k] + 0.1 * g[k], 0.999 * v[k] + 0.001 * g[k] ** 2
            w = [w[k] - 0.05 * (m[k] / (1 - 0.9**t)) / (math.sqrt(v[k] / (1 - 0.999**t)) + 1e-8) for k in range(3)]
        got, b = toxicity.nnpu(np.array(x_p, np.float32), np.array(x_u, np.float32), prior, steps=40)
        assert [*got.tolist(), b] == pytest.approx(w, abs=2e-3)


def test_stages_keep_and_remove_what_they_should(spark, docs, tmp_path):
    rnd = random.Random(23)
    rows = corpus(24, 150)
    items = [(i, text(rnd, n)) for i, n in enumerate((12, 30, 45))]
    rows += [(1000 + i, f"{text(rnd, 20)} {items[i % 3][1]} {text(rnd, 5)}") for i in range(9)] + [(2000 + i, t) for i, t in enumerate([rows[3][1]] * 3)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df, stages = docs(rows), dict(corpus_pipeline.STAGES)
    kept = lambda name: sorted(r["doc_id"] for r in stages[name](spark, df, str(tmp_path)).collect())
    first = {}
    for d, t in rows:
        first[t or ""] = min(d, first.get(t or "", d))
    assert kept("exact_dedup") == sorted(first.values())
    assert kept("ngram_join") == sorted(d for d, (_, root) in linked(rows, 5, 80, 100).items() if d == root)
    from test_brute import re

    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    cut = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    bad = {d for d, t in rows for _, it in items for own in [cut(words(it))] for s in [cut(words(t))] if any(multiset_similarity(own, s[p : p + len(own)]) >= 0.8 for p in range(len(s)))}
    assert kept("decontamination") == sorted(d for d, _ in rows if d not in bad) and len(bad) == 9


def test_links_come_from_regions(spark):
    """On the documents of sf0.01, links between different texts are distances to pivots, up to a few of what is left."""
    via = Counter(r["via"] for r in ngram_join.jaccard_links(table(spark, "/root/testdata/sf0.01", "documents"), 5, 80, 100).collect())
    assert via["pivot"] > 0 and via["pair"] <= 0.2 * via["pivot"]


def test_large_regions_are_parted_by_all_tasks(docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "CHUNK", 15)
    rnd, rows = random.Random(25), []
    for base in [text(rnd, 120) for _ in range(6)]:
        for _ in range(12):
            w = base.split(" ")
            w[rnd.randrange(len(w))] = rnd.choice(WORDS)
            rows.append((len(rows), " ".join(w)))
    made, part = [], ngram_join._part
    monkeypatch.setattr(ngram_join, "_part", lambda *a: made.append(1) or part(*a))
    schema = "region long, d long, size long, s binary"
    sets = [(7, d, len(s), s.tobytes()) for d, t in rows for s in [np.sort(np.array([zlib.crc32(repr(x).encode()) for x in {tuple(t.split(" ")[i : i + 3]) for i in range(118)}], np.uint64))]]
    spark = docs([]).sparkSession
    links = [(r["a"], r["b"]) for df in ngram_join._region_links(spark.createDataFrame(sets, schema), 80, 100) for r in df.collect()]
    root = {d: d for d, _ in rows}
    for a, b in links:
        x, y = sorted((root[a], root[b]))
        root = {d: x if r == y else r for d, r in root.items()}
    assert made and root == {d: r for d, (_, r) in linked(rows, 3, 80, 100).items()}


def test_simhash_radius_misses_few_pairs_at_the_threshold(spark):
    """At a similarity of 0.8, right at the threshold, at most 2 in 1,000 pairs differ in more bits than are found."""
    rnd, pairs = random.Random(26), []
    for n in (27, 45, 90):
        for _ in range(700):
            same = round(n * 8 / 9)  # same / (2 n - same) >= 0.8
            own = [rnd.getrandbits(63) for _ in range(n)]
            pairs.append((own, own[:same] + [rnd.getrandbits(63) for _ in range(n - same)]))
    from pyspark.sql import functions as F

    df = spark.createDataFrame(pairs, "a array<long>, b array<long>")
    far = [r[0] for r in df.select(F.bit_count(decontaminate.simhash(F.col("a"), 8).bitwiseXOR(decontaminate.simhash(F.col("b"), 8)))).collect()]
    limit = decontaminate.BLOCKS * (decontaminate.BLOCK_RADIUS + 1) - 1
    assert sum(x > limit for x in far) <= 0.002 * len(far) + 3
