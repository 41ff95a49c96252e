"""Language-model scores, phrases and source divergence against plain computations."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from factloom.llm import collocations, divergence, gru, lm, words
from factloom.llm.queries import fold

NAMES = ["the", "of", "a", "wine", "red", "New", "York", "city", "état", "漢字", "x\x00y", "ÀB", "end"]
ODD = [None, "", " ", "\t\n", "one", "...", "a;b", "é" * 300, "new york " * 4000, "Red wine. Red\vwine\rred wine"]
EXTRA = ("n", "word", "rank", "score", "key", "term", "g", "phrase", "a", "l")


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


def corpus(seed, n):
    rnd, out = random.Random(seed), []
    for i in range(n):
        w = [rnd.choices(NAMES, range(len(NAMES), 0, -1))[0] + rnd.choice(["", "", "", ".", ", ", "\n"]) for _ in range(rnd.choice([0, 3, 20, 60]))]
        out.append((i, " ".join(w), rnd.choice(["en", "fr", None]), rnd.choice(["s1", "s1", "s1", "s2", "s3", None])))
    return out + [(n + i, t, "en", "s9") for i, t in enumerate(ODD)] + [out[0], out[0], (None, "red wine", "en", "s1"), (None, None, None, None), (7, "lonely", "eo", "s1")]


@pytest.fixture
def table(spark):
    def make(rows):
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
        return df.select("*", *[F.lit("x").alias(c) for c in EXTRA])

    return make


def test_words_of_bytes():
    texts = ["Ab  cd", None, "", "e", "É x\x0By", "  ", "z"]
    w, bounds, begin = words.words(pa.array(texts), words.BETWEEN_BLANKS)
    assert [w.to_pylist()[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [re.findall(r"[^\x20\x09-\x0D]+", lower(t)) for t in texts]
    assert len(begin) == len(w) and list(words.slices(pa.array(["a" * 9, "b", None, "c" * 30, "d"]), 10)) == [(0, 3), (3, 4), (4, 5)]


def phrases_by_hand(rows, least, first):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            f[lang or "und"].update(tuple(w[i : i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        own = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in own.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in own.items()):
                continue
            score, _, l, r = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:first])]
    return sorted(out)


@pytest.mark.parametrize("least, first, ranked, part, pivot_part", [(5, 2000, 1 << 18, 2_000_000, 250_000), (4, 7, 3, 500, 40), (4, 2000, 0, 700, 40)])
def test_phrases(table, least, first, ranked, part, pivot_part):
    """All words ranked; few or none ranked, small parts, and hot pivots dealt over several."""
    rows = corpus(1, 150)
    got = collocations.collocations(table(rows), min_count=least, first=first, ranked=ranked, part=part, pivot_part=pivot_part)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == phrases_by_hand(rows, least, first)


def test_a_phrase_occurrence_has_one_pivot():
    """Fragments of one text: each phrase occurrence of frequent words lies in exactly one of them, around its rarest word."""
    rnd = random.Random(2)
    text = " ".join(rnd.choices("a a a b b c d e".split(), k=300))
    known = pa.array(["a", "b", "c", "d"])
    pivot, _, before, after, place, _, w = collocations.fragments(pa.array([text]), (known, np.arange(4), np.array([9, 8, 7, 6])), True, 4)
    spans = Counter((p - i, p - i + k) for b, a, p in zip(before, after, place, strict=True) for k in range(2, 5) for i in range(k) if i <= b and k - 1 - i <= a)
    w = w.to_pylist()
    assert spans == Counter({(s, s + k): 1 for k in range(2, 5) for s in range(len(w) - k + 1) if "e" not in w[s : s + k]})
    assert all(w[p] == max(w[p - b : p + a + 1]) for b, a, p in zip(before, after, place, strict=True))


def divergence_by_hand(rows, min_docs, ranks):
    df, n, total, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        w, lang, source = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text)), lang or "", source or ""
        sources[lang].add(source)
        df[lang].update(set(w))
        n[lang, source].update(w)
        total[lang].update(w)
    out = []
    for lang, own in sources.items():
        kept = [t for t, c in df[lang].items() if c >= min_docs]
        share = lambda c: (lambda all_n: {t: 1 + 10**9 * (c[t] + 1) // (all_n + len(kept)) for t in kept})(sum(c[t] for t in kept))  # noqa: B023, E731
        p, q = {s: share(n[lang, s]) for s in own}, share(total[lang])
        for s in own:
            far = sorted((-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode()) for o in own - {s})
            marks = sorted((-((p[s][t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if n[lang, s][t] and p[s][t] > q[t])
            out += [(lang, s, part, x.decode(), -v, i + 1) for part, found in (("pair", far), ("term", marks[:ranks])) for i, (v, x) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("width, ranks, part_bytes", [(1 << 16, 200, 1 << 25), (64, 3, 500)])
def test_divergence(table, width, ranks, part_bytes):
    """A sketch of 64 cells lets nearly every term pass, terms lie in many parts, and nothing changes."""
    rows = corpus(3, 120) + [(900 + i, f"rare{i // 2} thrice{i // 3}", "fr", "s2") for i in range(60)]
    got = divergence.divergence(table(rows), width=width, ranks=ranks, part_bytes=part_bytes)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == divergence_by_hand(rows, 3, ranks)


def test_the_sketch_never_underestimates_and_discards(table):
    """Of terms in two documents hardly one is left; every term in three or more is."""
    letters = lambda k: chr(97 + k % 26) + chr(97 + k // 26)
    rows = [(i, f"twice{letters(i // 2)} thrice{letters(i // 3)} all", "fr", "s2") for i in range(999)]
    t = table(rows).select("text", "lang", "source")
    counts = divergence._counts(t, divergence.possible_terms(t, 3, 1 << 16), 1 << 16, {"fr": 3}, 2)
    left = {r["term"] for r in counts.select(F.explode("terms").alias("term")).collect()}
    assert {f"thrice{letters(i)}" for i in range(333)} | {"all"} <= left
    assert sum(x.startswith("twice") for x in left) < 50  # of 500


def test_gradients_of_the_recurrent_model():
    rnd = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in gru.initial(64, 3, np.log(np.full(64, 1 / 32)), np.log(np.full(5, 0.2))).items()}
    for k in ("c", "w"):
        p[k] += rnd.normal(0, 0.3, p[k].shape)
    tokens, before = rnd.integers(0, 67, (5, 4)), rnd.integers(0, 67, (5, 4))
    keep, h = (rnd.random((5, 4)) > 0.3) * 1.0, rnd.normal(0, 1, (4, gru.STATE))
    g = gru.gradients(p, h, before, tokens, keep, 64)[0]
    rows, own = g["x"]
    g["x"] = np.zeros_like(p["x"])
    g["x"][rows] = own
    for name in p:
        for _ in range(10):
            i = tuple(rnd.integers(0, s) for s in p[name].shape)
            old, ends = p[name][i], []
            for e in (1e-4, -1e-4):
                p[name][i] = old + e
                ends.append(gru.gradients(p, h, before, tokens, keep, 64)[2])
            p[name][i] = old
            assert abs((ends[0] - ends[1]) / 2e-4 - g[name][i]) < 2e-5


def test_scores_of_sequences_carry_the_state_over_windows():
    """Against one token after the other in plain formulas; windows of 8 tokens and of all at once agree."""
    rnd = np.random.default_rng(1)
    p = gru.initial(64, 3, np.log(np.full(64, 1 / 32)), np.log(np.full(5, 0.2)))
    for k in ("c", "w", "u"):
        p[k] += rnd.normal(0, 0.5, p[k].shape).astype(np.float32)
    sizes = [1, 40, 7, 0, 23]
    bounds = np.append(0, np.cumsum(sizes))
    tokens = rnd.integers(0, 67, bounds[-1])
    want = []
    for a, z in zip(bounds[:-1], bounds[1:], strict=True):
        h, last, total = np.zeros(gru.STATE), 0, 0.0
        for t in tokens[a:z]:
            x, u = p["x"][last].astype(float), h @ p["u"].astype(float)
            gate = 1 / (1 + np.exp(-(x[:32] + u[:32])))
            n = np.tanh(x[32:] + gate[16:] * u[32:])
            h = n + gate[:16] * (h - n)
            q = h @ p["c"] + p["cb"]
            c = t // 32 if t < 64 else t - 64 + 2
            total += q[c] - np.log(np.exp(q).sum())
            if t < 64:
                v = h @ p["w"][c] + p["wb"][c]
                total += v[t % 32] - np.log(np.exp(v).sum())
            last = t
        want.append(total)
    for room in (8, 1 << 20):
        assert np.allclose(gru.score(p, tokens, bounds, 64, 0, room), want, atol=1e-3)


@pytest.mark.parametrize("hot", [1 << 17, 4])
def test_base_scores_and_counts(table, hot):
    rows = corpus(4, 150)
    held = fold(5, 1)
    got = lm.lm_scores(table(rows), held, hot=hot)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    out_of = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    own = [(i, re.findall(r"[^\x20\x09-\x0D]+", lower(t)) + [None]) for i, t, *_ in rows]
    c = Counter(w for i, ws in own if not out_of(i) for w in ws)
    total = sum(c.values())
    want = sorted((str(i), out_of(i), len(ws), sum(c[w] > 0 for w in ws), total, round(sum(math.log10((c[w] + 0.5) / (total + 0.5 * (len(c) + 1))) for w in ws), 6)) for i, ws in own)
    have = got.collect()
    assert sorted((str(r[0]), r[1], r[2], r[3], r[4], round(r[5], 6)) for r in have) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in have)


def test_probabilities_of_all_next_words_add_up(spark, table):
    """After a fixed beginning: every known word, the end and the unseen event together have probability 1."""
    rows = [(i, t, lang, s) for i, t, lang, s in corpus(5, 60)] + [(1000 + i, f"once{i} red", "en", "s1") for i in range(40)]
    t = table(rows).select(F.coalesce("text", F.lit("")).alias("text"))
    counts = lm.word_counts(t).cache()
    v = lm.Vocabulary(counts, len(rows), 6)
    p, losses = lm.fit(t, v)
    assert len(losses) == 3 and all(map(math.isfinite, losses))
    n = {r["word"]: r["n"] for r in counts.collect()}
    all_words = [*n, "never-seen"]
    start = "red wine "
    tokens, bounds, w, at = v.tokens(pa.array([start + x for x in all_words] + [start]))
    lp = gru.score(p, tokens, bounds, lm.HEAD, lm.END)
    ends = np.array([gru.score(p, tokens[a : z - 1], np.array([0, z - 1 - a]), lm.HEAD, lm.END)[0] for a, z in zip(bounds[:-1], bounds[1:], strict=True)])
    begin = ends[-1]  # of "red wine" without an end
    within = np.array([v.within[list(v.hot.to_pylist()).index(x)] if x in v.hot.to_pylist() else
                       math.log10((n[x] - lm.DISCOUNT if x in n else lm.DISCOUNT * (v.rare_distinct + 1)) / (v.rare_total + lm.DISCOUNT)) for x in all_words])
    assert abs(np.exp(ends[:-1] - begin + within * math.log(10)).sum() + np.exp(lp[-1] - begin) - 1) < 1e-3


def test_the_model_beats_the_base_on_held_out_texts(spark, sf):
    from factloom.llm.queries import QUERIES

    got = QUERIES["op11_lm_scores"](spark, sf).filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert got["s"] > 0.95 * got["b"]


def test_empty_tables_and_no_training_rows(table, spark):
    none = table([(1, "x", "en", "s")]).filter("doc_id = 2")
    assert collocations.collocations(none).count() == divergence.divergence(none, width=1 << 16).count() == lm.lm_scores(none, fold(5, 1)).count() == 0
    got = lm.lm_scores(table([(1, "a b", "en", "s"), (1, None, "en", "s")]), F.lit(True)).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]
    assert all(r["score"] <= 0 for r in got)
