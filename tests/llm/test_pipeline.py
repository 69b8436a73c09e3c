"""The stages in order, over a small table."""

import pytest

import corpus_pipeline
from ledgerspark.llm import bpe, dedup, queries
from ledgerspark.scratch import materialise
from tests.oracle_check import compare, duck


def test_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, docs
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near duplicates", "mixing", "bpe"]
    for name, stage in corpus_pipeline.STAGES:
        after = materialise(stage(spark, before, folder), "test-stage")
        if name != "bpe":
            assert after.columns == columns
        if name in ("toxicity", "quality", "near duplicates"):
            assert after.join(before, columns, "left_anti").isEmpty()
        if name == "near duplicates":
            assert dedup.near_duplicates(after).filter("not kept").isEmpty()
        if name == "bpe":
            codec = bpe.codec(queries.vocabulary_path())
            texts = {(r.doc_id, r.text) for r in before.collect()}
            assert {(r.doc_id, codec.decode(r.ids)) for r in after.collect()} == texts
        before = after


@pytest.mark.parametrize("name", ["op5_exact_top_k", "op10_url_rules", "op11_hard_negatives"])
def test_queries_equal_their_sql(spark, name):
    import __spark_entry__ as contract

    folder = "/root/testdata/sf0.01"
    assert compare(contract.queries()[name](spark, folder), duck(folder), contract.oracle_sql()[name]) is None


def test_every_operator_has_a_query():
    names = queries.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
