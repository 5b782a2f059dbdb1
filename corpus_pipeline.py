"""The text pipeline: documents through the operators, stage by stage.

Each stage gets what the one before kept, written as Parquet and read again.
All but the last return the columns of ``documents``; the last one returns the
result of byte-level BPE per document of the mix.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tripflow.llm import bpe, exact, mixing, neardup, toxicity
from tripflow.llm.common import stored, table

# The classifier, the shingle hashes and the tokenizer are beyond SQL: the stages
# are tested one by one.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays."""
    return exact.drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five words, 80 %."""
    return neardup.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each document of the mix, and the text they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_decode_digests(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{number}")
    return docs
