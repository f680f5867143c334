"""The operators applied to the whole test tables, one query each, with the columns that are asked for."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    blocks, bloom_lm, filter_audit, importance, jaccard, metric_join, mixing, oracles, quality_rules, target_resampling,
    tokens, toxicity, trie_bpe, url_tree,
)

#: (verdict, host, path): the host and all its subdomains, paths that begin so.
RULES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark, sf_dir):
    return tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_exact_dedup(spark, sf_dir):
    return blocks.exact_groups(table(spark, sf_dir, "documents"))


def op3_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_near_vectors(spark, sf_dir):
    return metric_join.near_vectors(table(spark, sf_dir, "embeddings"))


def digests(encoded: DataFrame) -> DataFrame:
    """Counts and digests of encoded texts."""
    return encoded.select(
        "doc_id", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op5_word_bpe(spark, sf_dir):
    return digests(trie_bpe.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def op6_mixing(spark, sf_dir):
    return mixing.mixed(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"), (F.col("__size") * F.col("__copies")).alias("taken"))


def op7_bloom_lm(spark, sf_dir):
    return bloom_lm.scored(table(spark, sf_dir, "documents"))


def op8_url_templates(spark, sf_dir):
    judged = url_tree.verdicts(table(spark, sf_dir, "pages"), RULES)
    return judged.withColumn("purity", F.round("purity", 6))


def op9_ngram_jaccard(spark, sf_dir):
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents"))


def op10_importance(spark, sf_dir):
    return importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_filter_audit(spark, sf_dir):
    return filter_audit.audited(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_target_resampling(spark, sf_dir):
    return target_resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_quality_rules(spark, sf_dir):
    return quality_rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_token_counts, op2_exact_dedup, op3_toxicity, op4_near_vectors, op5_word_bpe, op6_mixing, op7_bloom_lm,
        op8_url_templates, op9_ngram_jaccard, op10_importance,
        op11_filter_audit, op12_target_resampling, op13_quality_rules)}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_exact_dedup": oracles.EXACT, "op6_mixing": oracles.MIX, "op8_url_templates": oracles.urls(RULES),
        "op11_filter_audit": oracles.AUDIT,
    }
