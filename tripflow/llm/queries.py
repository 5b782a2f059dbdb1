"""One query per operator, over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers

from tripflow.llm import (
    bpe,
    exact,
    html_text,
    lm,
    mixing,
    neardup,
    pair_index,
    repair,
    toxicity,
    trie,
    urls,
    variants,
    winnow,
)
from tripflow.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def _exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def _mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def _url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def _byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode_digests(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def _token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.write_and_index(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
    )


def _pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.pseudo_likelihood(table(spark, sf_dir, "documents"))


def _fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.edited_fingerprints(table(spark, sf_dir, "documents"))


def _html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def _near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=2, similar=80)


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_index.encode_decode_digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )


def _prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie_nodes(table(spark, sf_dir, "conversations"))


def _spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_pseudo_likelihood": _pseudo_likelihood,
        "op2_html_text": _html_text,
        "op3_exact_dedup": _exact_dedup,
        "op4_source_mixing": _mixing,
        "op5_fingerprints": _fingerprints,
        "op6_byte_bpe": _byte_bpe,
        "op7_token_shards": _token_shards,
        "op8_toxicity": _toxicity,
        "op9_near_duplicates": _near_duplicates,
        "op10_url_filter": _url_filter,
        "op11_word_bpe": _word_bpe,
        "op12_prefix_trie": _prefix_trie,
        "op13_spelling_variants": _spelling_variants,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_exact_dedup": """
            SELECT doc_id,
                   max(doc_id) OVER same AS keep_id,
                   count(*) OVER same AS group_size,
                   doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
                   sha256(coalesce(text, '')) AS text_sha256
            FROM documents
            WINDOW same AS (PARTITION BY coalesce(text, ''))
        """,
        "op4_source_mixing": mixing.SQL,
        "op10_url_filter": urls.SQL,
        "op12_prefix_trie": trie.SQL,
        "op13_spelling_variants": variants.SQL,
    }
