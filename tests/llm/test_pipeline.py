"""The pipeline as a whole: each stage's decisions take effect and clean documents stay."""

import corpus_pipeline
from compdict.llm import contamination, jaccard
from tests.llm import brute

FOLDER = "/root/testdata/sf0.01"


def test_run(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    toxic = {r[0] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").filter("toxic = 1").collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        kept = stage(spark, docs, FOLDER).checkpoint()
        assert kept.columns == docs.columns
        before, after = ({r["doc_id"]: r["text"] for r in df.collect()} for df in (docs, kept))
        gone = set(before) - set(after)
        if i == 0:
            assert len(gone & toxic) > 0.8 * len(toxic) and len(gone - toxic) < 0.2 * len(before)
        if i == 2:
            label = {k: c for (k, _, c) in brute.components(list(before.items()))}
            assert gone == {k for k in before if label[k] != k}
        if i == 3:
            assert gone == {d for d, _ in brute.leaks(list(before.items()), items)}
        docs = kept
    last = corpus_pipeline.STAGES[4][1](spark, docs, FOLDER)
    assert last.count() == docs.count()


def test_stages_of_nothing_and_of_odd_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame([(1, None, None, None, None), (1, None, None, None, None), (None, "a b", "en", "s", 3), (2, "", "en", "s", 0)], docs.schema)
    for df in (docs.filter("false"), odd):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, df, FOLDER).count() <= df.count()
