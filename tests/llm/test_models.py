"""Trained operators, archives and the pipeline."""

import hashlib
import random
import zlib

import numpy as np

import corpus_pipeline
from factloom.llm import language, toxicity, warc
from factloom.llm.common import table
from factloom.llm.queries import QUERIES

EN, DE = "the and that with thing other then there".split(), "der die und nicht schon über eine durch".split()


def test_language_profiles(spark, docs):
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choices(EN if i % 2 else DE, k=rnd.randint(3, 60)))) for i in range(200)]
    df = docs(rows).drop("lang").selectExpr("doc_id", "text", "case when doc_id % 2 = 1 then 'en' else 'de' end as lang")
    model = language.fit(df.filter("doc_id < 150"), sample=60)
    odd = spark.createDataFrame([(500, None), (501, ""), (502, "12 %"), (503, "der " * 50_000), (503, "THE and"), (None, "und")], "doc_id long, text string")
    got = language.classify(df.drop("lang").unionByName(odd), model).collect()
    want = {500: "und", 501: "und", 502: "und"}
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] < 200:
            assert r["lang_pred"] == ("en" if r["doc_id"] % 2 else "de")
        elif r["doc_id"] in want:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        assert 0 <= r["score"] <= 1
    assert sorted(r["lang_pred"] for r in got if r["doc_id"] == 503) == ["de", "en"]
    assert language.fit(df.filter("doc_id < 0")) == {}
    assert {r["lang_pred"] for r in language.classify(df, {}).collect()} == {"und"}


def test_long_texts_are_counted_whole():
    codes = np.array([97, 98, 32, 99, 97, 98] * 50, np.uint32)
    whole, parts = language.gram_counts(codes), language.gram_counts(codes, 7)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_risk_is_class_prior_corrected():
    rnd = np.random.default_rng(2)
    y = rnd.random(4000) < 0.3
    x = np.zeros((4000, 6), np.float32)
    x[:, 0] = np.where(y, rnd.random(4000) < 0.9, rnd.random(4000) < 0.02)
    x[:, 1:] = rnd.random((4000, 5)) < 0.3
    w, b = toxicity.nnpu(x[y][:400], x, 0.3)
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert p[x[:, 0] == 1].mean() > 0.8 and p[x[:, 0] == 0].mean() < 0.25


def test_toxicity(spark, docs):
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choices(EN + DE, k=40) + (["vilest", "scoundrel"] if i % 5 == 0 else []))) for i in range(400)] + [(900, None), (901, ""), (902, "x " * 60_000), (902, "vilest scoundrel vilest")]
    lab = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(0, 400, 2)] + [(None, 1), (1, None), (0, 0)], "doc_id long, toxic int")
    df = docs(rows)
    model = toxicity.fit(df, lab)
    got = toxicity.score(df, model).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        if r["doc_id"] < 400:
            assert r["predicted"] == int(r["doc_id"] % 5 == 0), r
    left = toxicity.reject(df, model)
    assert left.columns == df.columns and {r["doc_id"] for r in left.collect()} >= {1, 2, 900, 901}
    none = toxicity.fit(df, lab.filter("toxic = 0"))
    assert {r["predicted"] for r in toxicity.score(df, none).collect()} == {0}
    assert toxicity.score(docs([]), model).collect() == [] == toxicity.reject(docs([]), model).collect()


def test_archives(spark, tmp_path):
    big, small = "é<p>" * 40, "small"
    rows = [(3, "http://b.example.com/x", big), (1, "http://a.example.com/y", big), (2, None, big), (4, "http://b.example.com/x", small), (5, "http://b.example.com/x", small), (6, "odd\r\nurl %0A", None), (6, "odd\r\nurl %0A", None), (None, "http://c/", big), (7, "", "")]
    rows += [(100 + i, f"http://h{i % 7}.org/{i}", "p" * i) for i in range(600)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4).selectExpr("*", "'k' as key", "1 as id", "2 as digest")
    folder = f"file://{tmp_path}"
    index = warc.build_index(warc.write_archives(df, folder), folder)
    got = sorted(map(str, (tuple(r)[:5] for r in warc.read_back(df, index).collect())))
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        first = 1 if h == big and i is not None and i > 1 else None
        want.append(str((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if first else "response", first)))
    assert got == sorted(want)
    assert sorted(map(str, ((r["page_id"], r["url"]) for r in warc.read_back(df, index).collect()))) == sorted(map(str, ((r[0], r[1]) for r in rows)))
    reader = warc.Reader(index)
    assert [reader.record(*c)["url"] for c in reader.captures("com,example,b)/x", 4)] == ["http://b.example.com/x"]
    assert reader.captures("zz", 1) == [] == reader.captures("", 12345)
    assert warc.archive_and_read(df.filter("page_id < 0"), folder=f"{folder}/none").collect() == []


def test_records_name_the_url_as_it_is():
    raw = zlib.decompress(warc.record(1, "http://x/a%20b", b"", "d", None), 31)
    assert b"\r\nWARC-Target-URI: http://x/a%20b\r\n" in raw and b"\r\nWARC-Record-ID: <urn:page:1>\r\n" in raw
    digest = hashlib.sha256(b"p").hexdigest()
    for url in ("http://x/a%0Ab", "a\nb%0A", "\r", "", None):
        got = warc.parse(warc.record(None, url, b"p", digest, None, spare="3-1-0"))
        assert (got["url"], got["page_id"]) == (url, None)
    assert b"WARC-Record-ID: <urn:capture:3-1-0>" in zlib.decompress(warc.record(None, None, b"", "d", None, spare="3-1-0"), 31)


def test_clean_documents_stay(spark):
    """On a table with some dozens of toxic texts to learn from; the smallest table has a handful."""
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents").filter("doc_id is not null")
    left = {r["doc_id"] for r in dict(corpus_pipeline.STAGES)["toxicity"](spark, docs, sf).select("doc_id").collect()}
    toxic = {r["doc_id"]: r["toxic"] for r in table(spark, sf, "labels").join(docs, "doc_id").collect()}
    clean, bad = {d for d, t in toxic.items() if t == 0}, {d for d, t in toxic.items() if t == 1}
    assert len(clean - left) <= 0.05 * len(clean) and len(bad - left) >= 0.7 * len(bad)


def test_pipeline_stages(spark, sf):
    docs = table(spark, sf, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "ngram_join", "decontamination", "packing"]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = docs
    for name in list(stages)[:-1]:
        kept = stages[name](spark, kept, sf)
        assert kept.columns == docs.columns
        kept = spark.createDataFrame(kept.collect(), docs.schema)
        ids = {r["doc_id"] for r in kept.collect()}
        if name == "exact_dedup":
            assert len({texts[i] for i in ids}) == len(ids)
    from test_brute import linked

    mine = linked([(r["doc_id"], r["text"]) for r in kept.collect()], 5, 80, 100)
    assert all(root == d for d, (_, root) in mine.items())
    packed = stages["packing"](spark, kept, sf)
    assert {r["doc_id"] for r in packed.collect()} == ids


def test_queries_run(spark, sf):
    n = table(spark, sf, "documents").count()
    for name in ("op1_language_id", "op4_toxicity", "op10_ngram_join", "op5_suffix_dedup"):
        assert QUERIES[name](spark, sf).count() == n
