"""The corpus pipeline on the smallest table: every stage against a plain version of its decision."""

import os

import pytest
from llm_data import SF, awkward, empty
from pyspark.sql import functions as F

import corpus_pipeline as C
from tidemark.llm import decontaminate
from tidemark.llm.jaccard_join import jaccard_components

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data missing")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = {r["doc_id"]: r for r in docs.collect()}
    kept = [docs]
    for name, stage in C.STAGES:
        out = stage(spark, kept[-1], SF).persist()
        assert {r[0] for r in out.select("doc_id").collect()} <= {r[0] for r in kept[-1].select("doc_id").collect()}
        if name != "encoding":
            assert out.columns == list(C.COLUMNS)
        kept.append(out)
    language, near, clean, secret, encoded = kept[1:]
    assert all(any(map(str.isalpha, r["text"])) for r in language.collect()) and language.count() >= 0.98 * docs.count()
    groups = jaccard_components(language).collect()
    assert {r["doc_id"] for r in near.collect()} == {r["component_id"] for r in groups}
    bench = [tuple(decontaminate.words_of(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    whole = {r["doc_id"] for r in near.collect() if any(" ".join(b) in " ".join(decontaminate.words_of(r["text"])) for b in bench)}
    assert whole and not whole & {r["doc_id"] for r in clean.collect()}
    assert secret.count() == clean.count()
    changed = [r for r in secret.collect() if r["text"] != first[r["doc_id"]]["text"]]
    assert all("[SECRET]" in r["text"] and r["n_chars"] == len(r["text"]) for r in changed)
    import hashlib
    texts = {r["doc_id"]: r["text"] for r in secret.collect()}
    for r in encoded.collect():
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest() and r["n_tokens"] == len(r["token_ids"])


def test_awkward_and_empty(spark):
    for docs in (awkward(spark), empty(spark)):
        for name, stage in C.STAGES:
            docs = stage(spark, docs.withColumn("extra", F.lit(1)) if name != "encoding" else docs, SF)
        docs.collect()
