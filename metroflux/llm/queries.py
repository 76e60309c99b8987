"""Registered queries of the training-data operators: one per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from metroflux.llm import (op1_language, op2_bpe, op3_packing, op4_minhash, op5_quality, op6_embedding_dedup, op7_token_counts, op8_pii,
                           op9_html, op10_sharding, op11_prefix_trie, op12_licenses, op13_spelling, oracle)
from metroflux.llm.common import read_table

Builder = Callable[[SparkSession, str], DataFrame]


def op1_language_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by the string-kernel classifier."""
    return op1_language.identify(read_table(spark, sf_dir, "documents"))


def op2_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text by speculate-and-verify BPE, decoded back, as digests."""
    return op2_bpe.digests(read_table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces packed into sequences of 2048 tokens."""
    return op3_packing.pack(read_table(spark, sf_dir, "documents"))


def op4_hamming_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return op4_minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op5_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word, line and compression measures of every text, with the verdict."""
    return op5_quality.quality(read_table(spark, sf_dir, "documents"))


def op6_sorted_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return op6_embedding_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op7_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every text before and after a revision, re-encoding only what it touches."""
    return op7_token_counts.counts(read_table(spark, sf_dir, "documents"))


def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced by surrogates."""
    return op8_pii.report(read_table(spark, sf_dir, "documents"))


def op9_consensus_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page at its host's winning container path."""
    return op9_html.main_text(read_table(spark, sf_dir, "pages"))


def op10_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt over 8 shards along a Hilbert curve."""
    return op10_sharding.sharded(read_table(spark, sf_dir, "documents"))


def op11_prefix_trie_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    return op11_prefix_trie.rebuilt_trie(read_table(spark, sf_dir, "conversations"))


def op12_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of every whole text by ordered signature rules."""
    return op12_licenses.licenses(read_table(spark, sf_dir, "documents"))


def op13_pivotal_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all texts, with their most frequent form."""
    return op13_spelling.spelling_variants(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Builder]:
    return {
        "op1_language_kernel": op1_language_kernel,
        "op2_bpe_encode_decode": op2_bpe_encode_decode,
        "op3_best_fit_packing": op3_best_fit_packing,
        "op4_hamming_near_dedup": op4_hamming_near_dedup,
        "op5_compression_bands": op5_compression_bands,
        "op6_sorted_projections": op6_sorted_projections,
        "op7_edit_token_counts": op7_edit_token_counts,
        "op8_surrogates": op8_surrogates,
        "op9_consensus_paths": op9_consensus_paths,
        "op10_hilbert_shards": op10_hilbert_shards,
        "op11_prefix_trie_rollup": op11_prefix_trie_rollup,
        "op12_license_rules": op12_license_rules,
        "op13_pivotal_grams": op13_pivotal_grams,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_hamming_near_dedup": oracle.NEAR_DUPLICATES,
        "op6_sorted_projections": oracle.EMBEDDING_LINKS,
        "op11_prefix_trie_rollup": oracle.PREFIX_TRIE,
        "op13_pivotal_grams": oracle.SPELLING_VARIANTS,
    }
