import pytest
from pyspark.sql import functions as F
from test_dedup import brute_near, normal

import corpus_pipeline
from linkloom.llm._common import read, stage
from linkloom.llm.quality_rules import quality_verdicts
from linkloom.llm.source_mixing import mixture


@pytest.fixture
def planted_dir(spark, sf_dir, tmp_path):
    """The table with near copies added: of the table's own, none outlast the first two stages at the smallest size."""
    docs = read(spark, sf_dir, "documents")
    copies = docs.filter(F.size(F.split("text", " ")) > 60).withColumn("doc_id", F.col("doc_id") + 1_000_000).withColumn("text", F.concat("text", F.lit(" und so on")))
    docs.unionByName(copies).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_each_stage_works_on_its_predecessor(spark, planted_dir):
    sf_dir = planted_dir
    docs = read(spark, sf_dir, "documents")
    columns = docs.columns
    kept = docs
    for name, function in corpus_pipeline.STAGES[:-1]:
        before = kept
        kept = stage(function(spark, before, sf_dir), "test")
        assert kept.columns == columns, name
        old, new = {r.doc_id: r.text for r in before.collect()}, {r.doc_id: r.text for r in kept.collect()}
        assert new.items() <= old.items()
        if name == "quality rules":
            expected = {r.doc_id for r in quality_verdicts(before).filter("kept").collect()}
        elif name == "exact dedup":
            first = {}
            for i, t in sorted(old.items()):
                first.setdefault(normal(t), i)
            expected = set(first.values())
        elif name == "near dedup":
            expected = {i for i, _, _, stays in brute_near(list(old.items())) if stays}
        else:
            copies = mixture(before, share=corpus_pipeline.MIX_SHARE, max_epochs=corpus_pipeline.MIX_EPOCHS)
            expected = {r.doc_id for r in copies.filter("copies > 0").collect()}
        assert set(new) == expected and len(expected) < len(old), name
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in out} == set(new) and all(r.n_tokens >= 2 for r in out)


def test_an_empty_table_passes(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").limit(0)
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, sf_dir)
    assert docs.count() == 0
