"""The pipeline's stages one after the other, held against what each is asked to do."""

import pytest

import corpus_pipeline
from test_decontaminate import brute as windows_hit
from test_jaccard_join import brute as classes


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_on_the_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    stages = dict(corpus_pipeline.STAGES)
    good = corpus_pipeline.written(spark, stages["quality"](spark, docs, sf), "t1")
    left = set(ids(good))
    clean = [i for i, q in labels.items() if q == 1]
    assert good.columns == docs.columns and sum(i in left for i in clean) >= 0.97 * len(clean)

    one = corpus_pipeline.written(spark, stages["near_duplicates"](spark, good, sf), "t2")
    assert one.columns == docs.columns
    assert ids(one) == sorted({c for c, _, _ in classes([(r["doc_id"], r["text"]) for r in good.collect()]).values()})

    cut = corpus_pipeline.written(spark, stages["decontaminate"](spark, one, sf), "t3")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    before = windows_hit([(r["doc_id"], r["text"]) for r in one.collect()], items)
    after = windows_hit([(r["doc_id"], r["text"]) for r in cut.collect()], items)
    assert any(h for _, h, _ in before.values()) and not any(h for _, h, _ in after.values())
    assert set(after) == {i for i, (n, h, _) in before.items() if not h or h < n}
    texts = {r["doc_id"]: r["text"] for r in one.collect()}
    assert all(r["text"] == texts[r["doc_id"]] for r in cut.collect() if not before[r["doc_id"]][1])
    assert all(r["n_chars"] == len(r["text"]) for r in cut.collect())

    mixed = corpus_pipeline.written(spark, stages["mix"](spark, cut, sf), "t4")
    assert mixed.columns == docs.columns and set(ids(mixed)) <= set(ids(cut))
    assert max(r["count"] for r in mixed.groupBy("doc_id").count().collect()) <= 2

    last = stages["shard"](spark, mixed, sf)
    counts = [r["count"] for r in last.groupBy("shard").count().collect()]
    assert ids(last) == ids(mixed) and max(counts) - min(counts) <= 1


@pytest.mark.parametrize("stage", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_extra_columns_odd_rows_and_empty_tables(spark, sf, stage):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (2, "", "en", "a", 0), (None, "some words here", "en", "a", 15), (3, "w " * 9000, "en", "b", 18000)]
    df = spark.createDataFrame([(*r, 1, "k", 2, 3, "x") for r in rows],
                               "doc_id long, text string, lang string, source string, n_chars long, size int, key string, shard int, node long, items string")
    run = dict(corpus_pipeline.STAGES)[stage]
    out = run(spark, df, sf)
    assert set(out.columns) >= set(df.columns) and out.count() >= 1
    assert run(spark, df.limit(0), sf).count() == 0


def test_registered(spark, sf):
    from __spark_entry__ import queries
    assert queries()["pipeline"] is corpus_pipeline.run
