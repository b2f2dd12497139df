"""The pipeline's stages on planted cases, and the registered queries."""

import os

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from caselume.llm.queries import QUERIES

DATA = contract.SMOKE_DIR


def test_every_operator_is_registered():
    names = contract.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in QUERIES) == 1 for i in range(1, 14)) and set(QUERIES) <= set(names) and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_dedup", "suffix_dedup", "decontaminate", "byte_bpe"]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables are not here")
def test_stages_keep_columns_and_decisions_take_effect(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    n = docs.count()
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, DATA).cache()
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        assert out.select("doc_id").distinct().count() == out.count() <= n
        if name != "toxicity":
            assert out.count() > 0.8 * docs.count(), name
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert last.count() == docs.count() and {"n_tokens", "ids", "decoded_sha256"} <= set(last.columns)
