"""The registered queries of the training-data operators: each applies its operator, with
production parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe_codec, cover_tree, decontaminate, jaccard_join, kd_shards, language_id, periodic_runs, quality_rules, secret_scan, small_world, substring_dedup, token_counts, toxicity
from tidemark.llm.common import documents
from tidemark.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text by the multilingual ranks, and the round trip back to bytes."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    return bpe_codec.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text, learned from the labelled documents outside fold 0."""
    return language_id.identify(documents(spark, sf_dir, "doc_id", "text", "lang"))


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every whole text by the byte-level BPE tokenizer file."""
    return token_counts.over_limit(documents(spark, sf_dir, "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text, learned from the labels outside fold 0."""
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "toxic"])
    return toxicity.toxicity(documents(spark, sf_dir, "doc_id", "text"), labels)


@query
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of the links of all documents by 5-word shingles at 80 percent."""
    return jaccard_join.jaccard_components(documents(spark, sf_dir, "doc_id", "text"))


@query
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in all documents: a row per contaminated document and benchmark item."""
    benchmark = read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    return decontaminate.contaminated(documents(spark, sf_dir, "doc_id", "text"), benchmark)


@query
def op7_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards by a k-d tree over their metadata."""
    return kd_shards.eight_shards(documents(spark, sf_dir, "doc_id", "text"))


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and the cascade's verdict of every whole text."""
    return quality_rules.quality(documents(spark, sf_dir, "doc_id", "text"))


ORACLE["op2_quality_rules"] = quality_rules.ORACLE_SQL


@query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents after false-positive removal, a row each."""
    return secret_scan.scan(documents(spark, sf_dir, "doc_id", "text"))


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that documents share, a row per document and passage."""
    return substring_dedup.repeated_passages(documents(spark, sf_dir, "doc_id", "text"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every whole text, the texts with the contract's loops in them."""
    return periodic_runs.run_digests(documents(spark, sf_dir, "doc_id", "text"))


@query
def op11_small_world(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest by cosine, of all embeddings, for every row whose id 50 divides."""
    return small_world.five_nearest(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives out of all embeddings for the positives of every row whose id 100 divides."""
    return cover_tree.mined(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"]))
