"""The corpus pipeline: documents in, encoded training texts out.

Five stages, each a function of (spark, docs, sf_dir). ``docs`` has the columns of ``documents``
(doc_id, text, lang, source, n_chars); all stages but the last return them. Columns beyond these are not
carried on. Each stage works on all rows its predecessor kept, and its result is written before the next one reads it.

1. ``language``: documents without a recognised language go (no letter, or a score below ``MIN_LANGUAGE_SCORE``).
2. ``near_duplicates``: of each group of 5-word-shingle neighbours (80 percent) the smallest id stays; documents
   without words are in no group and stay. Rows that repeat an id stay or go together; null ids stay.
3. ``decontamination``: documents with a benchmark passage go.
4. ``secrets``: secrets are replaced by a mark; no document goes, ``n_chars`` follows a changed text.
5. ``encoding``: token ids of every text, and the digests of ids and of the bytes they decode to.

No SQL can state stages 1 to 4 (learned models, a transitive closure over hashed sets), so
``ORACLE_SQL`` is None; tests/llm holds every stage against a plain version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe_codec, decontaminate, jaccard_join, language_id, secret_scan
from tidemark.llm.common import crc_fold, documents, materialize
from tidemark.sources.tables import read_table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
MIN_LANGUAGE_SCORE = 0.25


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    model = language_id.fit(docs.select("doc_id", "text", "lang").where(crc_fold() != 0))
    if model is None:  # nothing to learn from: only texts without a letter go
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    told = language_id.predict(docs, model)
    return told.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    groups = jaccard_join.jaccard_components(docs.select("doc_id", "text"))
    gone = groups.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs.select(*COLUMNS), read_table(spark, sf_dir, "benchmark", ["item_id", "text"]))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    clean = secret_scan.redact(docs.withColumn("_before", F.length("text")))
    n_chars = F.when(F.length("text") == F.col("_before"), F.col("n_chars")).otherwise(F.length("text").cast("bigint"))
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(n_chars)).select(*COLUMNS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    vocab = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = bpe_codec.encode(docs.select("doc_id", "text"), vocab, public_tokenizers.PATTERN, round_trip="decoded_sha256")
    return out.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.col("ids").alias("token_ids"), bpe_codec.ids_digest().alias("ids_sha256"), "decoded_sha256")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("encoding", encoding),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each one keeps is a table in the shared folder."""
    docs = documents(spark, sf_dir, *COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
