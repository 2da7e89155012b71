"""The pipeline, stage by stage, on the small corpus."""

import re

import corpus_pipeline
from ledgerlake.llm import packing

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, columns = {}, docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "secret_scan", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = corpus_pipeline.written(stage(spark, docs, SF), "test-stage")
        assert docs.columns == columns
        kept[name] = (before, docs.count())
    assert all(0 < after <= before for before, after in kept.values())
    assert kept["secret_scan"][0] == kept["secret_scan"][1]
    assert kept["quality_rules"][1] < kept["quality_rules"][0] and kept["near_duplicates"][1] < kept["near_duplicates"][0]
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert not any(re.search(r"token = \"[0-9a-f]{24,}", t) for t in texts.values())
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {p.doc_id for p in pieces} == set(texts)
    assert all(p.offset + p.length <= packing.CAPACITY for p in pieces)


def test_a_rows_columns_may_be_null(spark):
    docs = spark.createDataFrame([(None, None, None, None, None), (1, "a b " * 60, None, None, 5), (2, " ".join(f"w{k}" for k in range(80)), "en", "s", None)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert {r.doc_id for r in docs.collect()} == {2}
