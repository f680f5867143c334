"""A training corpus from raw documents: five stages, each one of the operators of `rubrica.llm`.

A stage reads what its predecessor kept and returns documents with the columns of
`documents`; the last returns digests of their encoding.  Between stages documents are
written as Parquet to the scratch folder that the cluster names, and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rubrica.llm import blocks, jaccard, mixing, queries, toxicity, trie_bpe
from rubrica.llm.common import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.5 or more go; empty texts stay."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document of largest id stays."""
    return blocks.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document of smallest id stays."""
    return jaccard.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    return mixing.taken(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text, one row per document of the mix."""
    return queries.digests(trie_bpe.encoded(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("ngram_jaccard", drop_near_copies),
    ("mixing", mix_sources), ("bpe", encode),
]

#: SQL cannot express toxicity, Jaccard components or BPE; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
