"""The pipeline: each stage keeps the columns, takes effect, and the whole equals its parts."""

import corpus_pipeline
from checks.against_oracle import connect, difference
from ferrytally.llm import decontaminate, quality_rules, simhash_neardup
from ferrytally.llm import queries as llm
from ferrytally.llm.common import table


def test_stages(spark, sf):
    docs = table(spark, sf, "documents")
    good = corpus_pipeline.quality(spark, docs, sf).checkpoint()
    kept = {r["doc_id"] for r in quality_rules.judge(docs, table(spark, sf, "labels")).filter("kept").collect()}
    assert {r["doc_id"] for r in good.collect()} == kept
    once = corpus_pipeline.near_duplicates(spark, good, sf).checkpoint()
    assert {r["doc_id"] for r in once.collect()} < kept
    # Taken again, nothing near is left.
    assert simhash_neardup.one_of_each(once).count() == once.count()
    clean = corpus_pipeline.decontamination(spark, once, sf).checkpoint()
    held = {r["doc_id"] for r in decontaminate.leaks(once, table(spark, sf, "benchmark")).collect()}
    assert held and {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in once.collect()} - held
    for frame in (good, once, clean, corpus_pipeline.mix(spark, clean, sf)):
        assert frame.columns == docs.columns


def test_run(spark, sf):
    got = corpus_pipeline.run(spark, sf)
    docs = table(spark, sf, "documents")
    assert got.columns == [*docs.columns, "shard", "slot"]
    sizes = [r["count"] for r in got.groupBy("shard").count().collect()]
    assert max(sizes) - min(sizes) <= 1
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(r["text"] == texts[r["doc_id"]] for r in got.collect())


def test_queries_with_sql(spark, sf):
    for key, sql in llm.ORACLES.items():
        assert difference(spark, connect(sf), sf, llm.QUERIES[key], sql) is None


def test_every_operator_is_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in llm.QUERIES) == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5
