"""Operators against plain computations, with nulls, empty and repeated rows, ties and empty tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from factloom.llm import decontaminate, exact_dedup, ngram_join, packing, simple8b, suffix_dedup, tokens
from factloom.llm.token_file import TokenFile, read_tokens, write_tokens
from factloom.llm.url_filter import judge_urls, rule_table
from factloom.llm.queries import URL_RULES, tokenizer

ODD = [None, "", " ", "x", "é", "a  b\n", "漢字 " * 40, "the same text", "the same text", "w " * 3000]
WORDS = [f"w{i}" for i in range(400)] + ["é", "漢字", "Ab", "AB"]


def text(rnd, n):
    return " ".join(rnd.choices(WORDS, k=n))


def corpus(seed, n, bases=(8, 15, 40, 80, 150, 150, 300)):
    rnd = random.Random(seed)
    base = [text(rnd, b) for b in bases]
    common, out = text(rnd, 30), []
    for i in range(n):
        r = rnd.random()
        if r < 0.3:
            t = text(rnd, rnd.randint(0, 120))
        elif r < 0.4:
            t = rnd.choice(base)
        else:
            w = rnd.choice(base).split(" ")
            for _ in range(rnd.randint(0, 1 + len(w) // 25)):
                w[rnd.randrange(len(w))] = rnd.choice(WORDS)
            if rnd.random() < 0.4:
                w[rnd.randrange(len(w)) : 0] = common.split(" ")
            t = " ".join(w)
        out.append((i, t))
    return out + [(n + i, t) for i, t in enumerate(ODD)]


def removed(rows, length=100):
    seen, out = set(), {}
    for d, t in sorted(rows):
        x = (t or "").encode()
        hit = np.zeros(len(x) + 1, bool)
        for i in range(len(x) - length + 1):
            w = x[i : i + length]
            if w in seen:
                hit[i : i + length] = True
            seen.add(w)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], hit]).astype(int)) == 1)
        out[d] = (len(x), int(hit.sum()), len(edges), hashlib.sha256(bytes(b for b, h in zip(x, hit, strict=False) if not h)).hexdigest())
    return out


@pytest.mark.parametrize("hot", [5000, 3])
def test_suffix_dedup(docs, hot):
    rows = corpus(1, 60)
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.suffix_dedup(docs(rows), hot=hot).collect()}
    assert got == removed(rows)


def test_suffix_dedup_makes_more_parts_of_more_text(docs, monkeypatch):
    made, dealt = set(), suffix_dedup._dealt
    monkeypatch.setattr(suffix_dedup, "PART", 200)
    monkeypatch.setattr(suffix_dedup, "_dealt", lambda rows, parts: made.add(parts) or dealt(rows, parts))
    rows = corpus(1, 60)
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.suffix_dedup(docs(rows)).collect()}
    assert got == removed(rows) and made == {sum(len((t or "").encode()) for _, t in rows) // 200} and min(made) > 64


def test_suffix_dedup_odd_tables(spark, docs):
    assert suffix_dedup.suffix_dedup(docs([])).collect() == []
    t = "abc " * 60
    got = sorted((str(r["doc_id"]), r["n_removed"]) for r in suffix_dedup.suffix_dedup(docs([(1, t), (1, t), (None, t)])).collect())
    assert got == [("1", 236), ("1", 236), ("None", 240)]  # repeated rows are one document; a null id comes last


def test_long_documents_are_cut_without_loss(monkeypatch):
    rnd = random.Random(2)
    data = np.frombuffer(" ".join(rnd.choices(WORDS, k=4000)).encode(), np.uint8)
    offs = np.array([0, len(data)])
    whole = suffix_dedup.anchors(data, offs)
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    parts = suffix_dedup.anchors(data, offs)
    window = lambda a: {(i, p) for p, s, e in zip(a[1], a[2], a[3], strict=True) for i in range(s, e + 1)}
    assert window(whole) == window(parts)


def test_loser_tree():
    rnd = random.Random(3)
    for _ in range(100):
        runs = [sorted(bytes(rnd.choices(b"ab", k=rnd.randint(1, 8))) for _ in range(rnd.randint(0, 6))) for _ in range(rnd.randint(1, 7))]
        out = list(suffix_dedup.merge([suffix_dedup.decode_run(*suffix_dedup.front_code(r)) for r in runs]))
        assert [k for _, k, _ in out] == sorted(k for r in runs for k in r)
        assert all(h == suffix_dedup.common_prefix(a[1], b[1], 0) for a, b in zip(out, out[1:]) for h in [b[0]])


def shingles(t, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def linked(rows, k, num, den):
    sets, root = [(d, shingles(t, k)) for d, t in rows], {d: d for d, _ in rows}
    for i, (a, s) in enumerate(sets):
        for b, u in sets[:i]:
            if s and u and den * len(s & u) >= num * len(s | u) and root[a] != root[b]:
                x, y = sorted((root[a], root[b]))
                root = {d: x if r == y else r for d, r in root.items()}
    return {d: (len(s), root[d]) for d, s in sets}


@pytest.mark.parametrize(("k", "num", "leaf"), [(3, 90, 4), (5, 80, 48)])
def test_ngram_join(docs, monkeypatch, k, num, leaf):
    monkeypatch.setattr(ngram_join, "LEAF", leaf)
    monkeypatch.setattr(ngram_join, "CHUNK", 20)
    rows = corpus(4, 250)
    got = {r[0]: (r[1], r[2]) for r in ngram_join.jaccard_components(docs(rows), k, num, 100).collect()}
    assert got == linked(rows, k, num, 100)


def test_ngram_join_odd_tables(docs):
    assert ngram_join.jaccard_components(docs([]), 3, 90, 100).collect() == []
    got = sorted(map(str, ngram_join.jaccard_components(docs([(None, "a b c"), (7, "a b c"), (7, "a b c"), (3, "A b C")]), 3, 90, 100).collect()))
    assert [x.count("component_id=3") for x in got] == [1, 1, 1, 0]
    assert ngram_join.one_of_each(docs([(7, "a b c"), (3, "A b C"), (9, None)]), 3, 90, 100).select("doc_id").orderBy("doc_id").collect() == [(3,), (9,)]


def test_keys_are_exchanged_in_eight_bytes():
    """In four of the key and four of the document where the ids allow it; families, documents and equal keys come through."""
    rnd = np.random.default_rng(5)
    h, d = rnd.integers(0, 1 << 63, 20_000).astype(np.uint64), np.sort(rnd.integers(10**12, 10**12 + 10**9, 20_000))
    h[1::2] = h[::2]  # each key twice
    for score, kept in ((True, np.uint32), (False, np.uint64)):
        rows = ngram_join.key_blobs(h, d, 64, score)
        assert sum(len(r[2]) + len(r[3]) for r in rows) <= len(h) * (4 + kept().nbytes) + 8 * 64
        back = sorted((x, p, int(k)) for p, kind, a, b in rows for k, x in zip(np.frombuffer(a, kept), ngram_join.key_documents(kind, b).tolist(), strict=True))
        assert [x for x, _, _ in back] == d.tolist() and sorted(k & 1 for _, _, k in back) == sorted((h & np.uint64(1)).tolist())
        assert len({(p, k) for _, p, k in back}) == len(h) // 2
    far = np.array([-(1 << 63), 0, (1 << 63) - 1])
    (row,) = ngram_join.key_blobs(np.zeros(3, np.uint64), far, 1, True)
    assert ngram_join.key_documents(row[1], row[3]).tolist() == far.tolist()


def test_voronoi_regions_are_exact():
    rnd = random.Random(5)
    base = [set(rnd.sample(range(2000), 60)) for _ in range(4)]
    sets = [np.array(sorted((rnd.choice(base) - set(rnd.sample(range(2000), 60))) | set(rnd.sample(range(2000), rnd.randint(0, 5)))), np.uint64) for _ in range(300)]
    root = list(range(len(sets)))
    for i, s in enumerate(sets):
        for j in range(i):
            both = len(np.intersect1d(s, sets[j]))
            if 10 * both >= 8 * (len(s) + len(sets[j]) - both):
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    block = ngram_join.Block(sets, 8, 10)
    block.join()
    assert len({(a, b) for a, b in zip(root, block.root.tolist(), strict=True)}) == len(set(root)) == len(set(block.root.tolist()))


def test_exact_dedup(docs):
    rows = [*corpus(6, 80), (5, "dup"), (5, "dup"), (9000, "dup"), (None, "dup"), (None, "alone")]
    got = exact_dedup.exact_dedup(docs(rows), keep="max").collect()
    assert len(got) == len(rows)
    by = {}
    for d, t in rows:
        by.setdefault(hashlib.sha256((t or "").encode()).hexdigest(), []).append(d)
    for r in got:
        ids = by[r["text_sha256"]]
        best = max((d for d in ids if d is not None), default=None)
        assert (r["keep_id"], r["group_size"], r["kept"]) == (best, len(ids), r["doc_id"] == best)
    kept = exact_dedup.drop_copies(docs(rows)).collect()
    assert sorted(hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in kept) == sorted(by)
    assert exact_dedup.exact_dedup(docs([])).collect() == [] == exact_dedup.drop_copies(docs([])).collect()


def test_copies_are_dropped_whatever_the_columns_are_called(docs):
    names = ["_h", "_sha", "_keep", "_many", "text_hash", "text_digest", "best_id", "has_copies", "h", "keep_id", "group_size"]
    df = docs([(2, "a"), (1, "a"), (3, None), (4, ""), (5, "b")]).selectExpr("*", *[f"concat('{n}', doc_id) as {n}" for n in names if n != "h"], "1 as text_")
    kept = exact_dedup.drop_copies(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"], r["_h"], r["best_id"], r["text_hash"]) for r in kept.collect()) == [(i, f"_h{i}", f"best_id{i}", f"text_hash{i}") for i in (1, 3, 5)]


def multiset_similarity(a, b):
    from collections import Counter

    x, y = Counter(a), Counter(b)
    return sum((x & y).values()) / sum((x | y).values())


def test_decontamination(spark, docs):
    rnd = random.Random(7)
    items = [(i, text(rnd, n)) for i, n in enumerate((2, 4, 5, 9, 30, 30, 45))] + [(100, None), (101, "")]
    rows = []
    for i in range(60):
        t = text(rnd, rnd.randint(0, 80))
        if i % 2:
            w = rnd.choice(items[:7])[1].split(" ")
            if i % 3 == 0 and len(w) > 20:
                w[rnd.choice([0, len(w) - 1])] = "changed"
            t = f"{t} {' '.join(w)}. {text(rnd, 10)}"
        rows.append((i, t))
    rows += [(200 + i, t) for i, t in enumerate(ODD)]
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    cut = lambda w, k: [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
    want = set()
    for item, it in items:
        w = words(it)
        if not w:
            continue
        k = min(5, len(w))
        own = cut(w, k)
        for d, t in rows:
            s = cut(words(t), k)
            if any(multiset_similarity(own, s[p : p + len(own)]) >= 0.8 for p in range(len(s))):
                want.add((d, item))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(docs(rows), bench).collect()}
    assert set(got) == want and all(r["similarity"] >= 0.8 for r in got.values())
    assert decontaminate.contaminated(docs(rows), bench.filter("item_id >= 100")).collect() == []
    assert decontaminate.contaminated(docs([]), bench).collect() == []


def test_simhash_is_a_majority_vote(spark):
    from pyspark.sql import functions as F

    rnd = random.Random(8)
    for n in (1, 2, 5, 31):
        hs = [rnd.getrandbits(64) - (1 << 63) for _ in range(n)]
        got = spark.createDataFrame([(hs,)], "h array<long>").select(decontaminate.simhash(F.col("h"), 7)).first()[0]
        assert got & (2**64 - 1) == sum((sum(h >> b & 1 for h in hs) > n // 2) << b for b in range(64))


def test_simple8b():
    rnd = np.random.default_rng(0)
    for n in (0, 1, 59, 4096, 4097, 9000):
        for high in (2, 50_000, 1 << 62):
            v = rnd.integers(0, high, n).astype(np.uint64)
            v[10:20] = 2**64 - 1
            words, first = simple8b.encode(v)
            assert (simple8b.decode(words, first, n) == v).all()


HARD_TEXTS = ["a  b", "a   b", " x", "  ", "\n \n a", "a \nb", "a\n b", "a\n \nb", "it's 's  'll", "tab\t x", "it's.\nThe end", "a\u00a0 b", "1 234,5 x2y", "<|endoftext|> x", "don't...", "x\u2028 y"]


def test_pieces_have_the_ids_of_the_whole_text():
    enc = tokens.encoder(tokenizer())
    rnd = random.Random(9)
    texts = HARD_TEXTS + ODD + ["".join(rnd.choices(["a", "b", " ", "\n", "'", "s", ".", "é", "1", "\u00a0"], k=30)) for _ in range(300)]
    ids, bounds = enc.encode(texts, None)
    for t, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
        assert ids[a:b].tolist() == enc.lib.encode(t or "", add_special_tokens=False).ids, t


def test_token_files(spark, docs, tmp_path):
    rows = [*enumerate(HARD_TEXTS + ODD), (None, "null id"), (3, "again")]
    files = write_tokens(docs(rows), tokenizer(), f"file://{tmp_path}")
    got = read_tokens(spark, files).collect()
    enc = tokens.encoder(tokenizer()).lib
    want = sorted((d is not None, d or 0, tuple([*enc.encode(t or "", add_special_tokens=False).ids, 0])) for d, t in rows)
    have = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"], r["ids_crc32"]) for r in got)
    assert have == sorted((a, b, len(c), zlib.crc32(np.array(c, "<u4").tobytes())) for a, b, c in want)
    spans = sorted((r["start"], r["n_tokens"]) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and spans[0][0] == 0
    f = TokenFile.open(files[0][0])
    assert f.ids(1, 3).tolist() == f.ids(0, f.total)[1:3].tolist()
    assert read_tokens(spark, write_tokens(docs([]), tokenizer(), f"file://{tmp_path}/none")).collect() == []


def best_cost(total, ends, sentences, window, sentence, hard, opening):
    """The least cost over all cut sets, by plain dynamic programming over the same places."""
    base = sorted({0, *ends, *sentences})
    pos = sorted({*base, *(x for a, b in zip(base, base[1:]) if b - a > window for x in range(a + window, b, window))})
    pen = {p: 0 if p in set(ends) else sentence if p in set(base) else hard for p in pos}
    best = {0: 0}
    for x in pos[1:]:
        short = [best[y] + (0 if (x - y) & (x - y - 1) == 0 and x - y >= window // 8 else window - (x - y)) for y in best if 0 < x - y <= window]
        double = [best[y] + hard + opening + 2 * window - (x - y) for y in best if window < x - y <= 2 * window]
        best[x] = min(short + double) + pen[x] + opening
    return best[total]


def test_plan_is_optimal():
    rnd = random.Random(10)
    for _ in range(40):
        ends = np.cumsum([rnd.randint(1, 60) for _ in range(rnd.randint(1, 12))])
        total = int(ends[-1])
        sentences = np.array(sorted(rnd.sample(range(1, total + 1), min(total, rnd.randint(1, 20)))))
        cuts = packing.plan(total, ends, sentences, 16, 2, 5, 3)
        n = np.diff(cuts)
        assert cuts[0] == 0 and cuts[-1] == total and n.min() > 0 and n.max() <= 16
        kind = lambda c: 0 if c in ends else 2 if c in sentences else 5
        cost = sum(packing.padding(int(x), 16) + kind(int(c)) + 3 for x, c in zip(n, cuts[1:], strict=True))
        assert cost <= best_cost(total, ends.tolist(), sentences.tolist(), 16, 2, 5, 3)


def test_packing(docs):
    rows = [*enumerate(HARD_TEXTS + ODD), (None, "null id")]
    got = packing.pack(docs(rows), tokenizer()).collect()
    enc = tokens.encoder(tokenizer()).lib
    ids = {d: np.array([*enc.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for d, t in rows}
    cover, seqs = {d: [] for d in ids}, {}
    for r in got:
        assert zlib.crc32(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        cover[r["doc_id"]].append((r["start"], r["length"]))
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts, size in [*((c, len(ids[d])) for d, c in cover.items()), *((s, None) for s in seqs.values())]:
        at = 0
        for a, n in sorted(parts):
            assert a == at
            at += n
        assert at == size if size is not None else at <= 1024
    assert packing.pack(docs([]), tokenizer()).collect() == []


def test_urls(spark):
    urls = ["http://a.example.com/en/7x?q", "HTTP://EXAMPLE.COM/en/8", "http://com/en/", "http://xcom/en/", "http://example.net/de/88#f", "http://b.example.net/de/9", "http://org/es", "http://o.org/es/", "no url", None, "", "x://y://com/en/", "http://u@example.com:80/en/7", "http://com?/en/"]
    df = spark.createDataFrame([*enumerate(urls), (2, "http://com/en/")], "page_id long, url string").selectExpr("*", "1 as host", "2 as rank", "3 as row")
    rules = [(a, r.split("/")[0], "/" + r.split("/", 1)[1]) for a, r in URL_RULES]
    got = sorted(map(str, judge_urls(df, rule_table(spark, URL_RULES)).collect()))

    def judge(i, u):
        rest = u.partition("://")[2] if u and "://" in u else ""
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
        fit = [(len(h + p), a, h + p) for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, default=(0, "allow", None))
        return f"Row(page_id={i}, host={host!r}, path={path!r}, rule={best[2]!r}, verdict={best[1]!r})"

    assert got == sorted([judge(i, u) for i, u in enumerate(urls)] + [judge(2, "http://com/en/")])
    assert judge_urls(df.filter("page_id < 0"), rule_table(spark, URL_RULES)).collect() == []
