import corpus_pipeline
from corpuskb.llm.store import materialize


def test_stages_keep_columns_and_lose_nothing_else(spark):
    base = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{base}/documents.parquet")
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = materialize(stage(spark, docs, base), f"test-{name}")
        sizes.append(docs.count())
        if name != "packing":
            assert docs.columns == before.columns
    assert docs.select("doc_id").distinct().count() == before.count()
    pieces = docs.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert all(r[1] == r[2] for r in pieces)
    assert sizes[0] >= sizes[1] == sizes[2] == sizes[3] > 0
