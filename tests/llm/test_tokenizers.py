"""op4 against tiktoken, op8 against the tokenizers library, the pre-token transducer against the pattern."""

import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import regex
from llm_data import awkward, empty, prose

from pyspark.sql import functions as F

from tidemark.llm import bpe_codec, pretokens, token_counts

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
COUNTS = P.path("byte_bpe_50k.json")


def reference():
    import tiktoken
    raw = open(RANKS, "rb").read()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pretokens_equal_the_pattern():
    r = random.Random(3)
    texts = ["".join(r.choices("ab strvmldeSR1²½'’\n\t \r  !?é日　\x1c\x85_", k=r.randint(0, 600))) for _ in range(300)]
    texts += ["".join(r.choices("  '''srtvel\n1!", k=r.randint(0, 40))) for _ in range(2000)] + ["", " " * 1000]
    pieces, counts = pretokens.split(texts)
    find, at = regex.compile(P.PATTERN).findall, 0
    for t, n in zip(texts, counts.tolist(), strict=True):
        assert pieces[at:at + n] == find(t)
        at += n


@pytest.mark.parametrize("pattern", [P.PATTERN, r"\s+|\S+"])
def test_codec_round_trip_and_ids(spark, pattern):
    import tiktoken
    enc = reference()
    if pattern != P.PATTERN:
        enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=enc._mergeable_ranks, special_tokens={})
    docs = awkward(spark)
    got = bpe_codec.encode(docs, RANKS, pattern)
    assert got.columns == [c for c in docs.columns if c != "ids"] + ["ids"]
    for r in bpe_codec.decode(got, RANKS).join(got.select("doc_id", "ids", "text").withColumnsRenamed({"doc_id": "d", "text": "t"}),
                                               F.expr("doc_id <=> d and text <=> t")).collect():
        assert r["ids"] == enc.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    assert bpe_codec.digests(empty(spark), RANKS, pattern).count() == 0


def test_digests(spark):
    enc = reference()
    rows = awkward(spark)
    want = sorted((r["doc_id"] if r["doc_id"] is not None else -1, len(i := enc.encode_ordinary(r["text"] or "")), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(),
                   hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in rows.collect())
    got = sorted((r[0] if r[0] is not None else -1, *r[1:]) for r in bpe_codec.digests(rows, RANKS, P.PATTERN).collect())
    assert got == want


def test_token_counts_equal_the_library(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(COUNTS)
    rows = awkward(spark)
    want = sorted((r["doc_id"] if r["doc_id"] is not None else -1, len((r["text"] or "").encode()), n := len(tok.encode(r["text"] or "", add_special_tokens=False).ids), n > 1024) for r in rows.collect())
    got = sorted((r[0] if r[0] is not None else -1, *r[1:]) for r in token_counts.over_limit(rows, COUNTS).collect())
    assert got == want
    assert token_counts.over_limit(empty(spark), COUNTS).count() == 0


def test_transducer_random_strings_and_refill(monkeypatch):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(COUNTS)
    t = token_counts.Transducer(open(COUNTS, "rb").read())
    r = random.Random(2)
    texts = ["".join(r.choices("etaoinshrdlu  THE'0123#{}\n", k=200)) for _ in range(300)] + ["a" * 3000, " <|endoftext|>  <|endoftext|>y  ", prose(4, 300, "ción ñ de los ü ß")]
    monkeypatch.setattr(token_counts, "MAX_TRANSITIONS", 1 << 14)  # the table is compiled afresh on the way
    for part in (texts[:100], texts[100:200], texts[200:], texts):
        assert t.count(part)[1].tolist() == [len(tok.encode(x, add_special_tokens=False).ids) for x in part]


def test_transitions_are_compiled_afresh_within_a_text(monkeypatch):
    with open(COUNTS, "rb") as f:
        raw = f.read()
    r = random.Random(5)
    texts = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3000)), " ".join("".join(r.choice("etaoin") for _ in range(r.randint(1, 20))) for _ in range(400)), "", None]
    want = [x.tolist() for x in token_counts.Transducer(raw).count(texts)]
    monkeypatch.setattr(token_counts, "MAX_TRANSITIONS", 64)
    few = token_counts.Transducer(raw)
    assert [x.tolist() for x in few.count(texts)] == want
    assert few.filled <= 3 * 64
