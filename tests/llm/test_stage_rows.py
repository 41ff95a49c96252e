"""Stages lose no rows that they should keep."""

import corpus_pipeline
from factloom.llm.common import table
from factloom.llm.queries import fold


def test_clean_documents_without_or_with_shared_ids_stay(spark, docs, tmp_path):
    item = " ".join(f"word{i}" for i in range(40))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, f"before {item} after"), (None, "a clean text"), (None, None), (7, item), (7, "another clean text"), (8, "one more"), (9, "")]
    df = docs(rows)
    left = dict(corpus_pipeline.STAGES)["decontamination"](spark, df, str(tmp_path))
    assert left.columns == df.columns
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in left.collect()))) == sorted(map(str, (r for r in rows if item not in (r[1] or ""))))


def test_toxicity_keeps_clean_documents_of_the_smallest_table(spark, sf):
    ids = {r["doc_id"] for r in dict(corpus_pipeline.STAGES)["toxicity"](spark, table(spark, sf, "documents"), sf).select("doc_id").collect()}
    clean = {r["doc_id"] for r in table(spark, sf, "labels").filter("toxic = 0").filter(~fold(3, 1)).collect()}
    assert len(clean - ids) <= 0.05 * len(clean)


def test_pipeline_keeps_only_the_last_stage_table(spark, sf):
    from pathlib import Path
    from urllib.parse import urlparse

    from factloom.session import shared_dir

    root = Path(urlparse(shared_dir(spark, "x")).path).parent
    old = {p.name for p in root.glob("stage-*")}
    assert corpus_pipeline.run(spark, sf).count()
    assert [p.name.rsplit("-", 1)[0] for p in root.glob("stage-*") if p.name not in old] == ["stage-decontamination"]


def test_workers_give_memory_back_after_a_task(monkeypatch):
    from factloom.llm import common

    seen = []
    monkeypatch.setattr(common, "trim", lambda release=False: seen.append(release))
    assert list(common.tidy(lambda batches: (seen.append(b) or b for b in batches), release=True)([1, 2])) == [1, 2]
    assert common.tidy(lambda key, tab: seen.append(tab) or tab)(0, 3) == 3
    assert seen == [True, 1, 2, False, False, 3, False]
