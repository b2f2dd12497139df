"""From raw documents to token ids: the training-data operators as one pipeline.

Each stage gets all rows that the one before has kept, with the columns of ``documents``; its
output is written as Parquet to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caselume.llm.bpe import encode_documents
from caselume.llm.common import stage, table
from caselume.llm.decontaminate import without_leaks
from caselume.llm.repeats import without_repeats
from caselume.llm.simhash import without_near_duplicates
from caselume.llm.toxicity import without_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the calibrated trees score below 0.7."""
    return without_toxic(docs, table(spark, sf_dir, "labels"), threshold=0.7)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: five-word shingles, similarity 0.8 or more."""
    return without_near_duplicates(docs, words=5, similarity=0.8)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 200 bytes that also start elsewhere."""
    return without_repeats(docs, least=200)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, with their digests, in place of the text."""
    import public_tokenizers as public

    return encode_documents(docs, public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN, keep_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("decontaminate", drop_leaks),
    ("byte_bpe", encode),
]

#: Trained scores and token ids can't be expressed in SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        docs = stage(docs) if i < len(STAGES) - 1 else docs
    return docs
