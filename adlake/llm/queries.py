"""The registered queries of the text operators, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm import (
    byte_bpe, fingerprints, html_extract, language_id, lm_scoring, mixing, quality_classifier, quality_rules, simhash, spelling, token_counts, url_filter, whitening)
from adlake.llm.common import read_table

RANKS = "byte_bpe_50k.tiktoken"
WORD_TOKENIZER = "word_bpe_49k.json"


def domain_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled table of domains: the language of the documents that ``labels`` covers."""
    return docs.select("doc_id", F.col("lang").alias("domain")).join(labels.select("doc_id").distinct(), "doc_id", "left_semi")


def bpe_digests(docs: DataFrame, keep_ids: bool = False) -> DataFrame:
    """Encode and decode whole texts; (doc_id, n_tokens, ids_sha256, decoded_sha256)."""
    coded = byte_bpe.round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), *(["token_ids"] if keep_ids else []))


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op2_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return mixing.rates(docs, domain_labels(docs, read_table(spark, sf_dir, "labels")))


def op3_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))


def op4_isolation_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_crf_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(read_table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages"), url_filter.labelled_urls(spark))


def op8_cotraining_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_bottom_k_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(read_table(spark, sf_dir, "documents"))


def op10_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(read_table(spark, sf_dir, "documents"), order=3, min_count=1)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(read_table(spark, sf_dir, "documents"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read_table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_simhash_near_dedup, op2_soft_mixing, op3_prefix_token_counts, op4_isolation_rules, op5_crf_html_extraction, op6_byte_bpe,
        op7_url_filter, op8_cotraining_quality, op9_bottom_k_fingerprints, op10_stupid_backoff,
        op11_spelling_variants, op12_language_id, op13_embedding_whitening)}

#: None is given SQL: hashes, trained models, tokenizers and iterations that DuckDB has no counterpart of. Tests in
#: tests/llm compare them with brute force, the tokenizers' libraries or held-out rows.
ORACLES: dict[str, str] = {}
