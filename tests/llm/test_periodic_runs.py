"""op12 against a plain search over all periods, and the query against plain Python on whole tables."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
from llm_data import SF, awkward, empty, prose

from tidemark.llm import periodic_runs
from tidemark.llm.common import documents


def plain_runs(x):
    """Every maximal stretch of equal words q apart, for every q, smallest first."""
    n, out = len(x), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, length, q) for (s, length), q in out.items()), key=lambda r: (r[0], r[2]))


def test_runs_equal_a_search_over_all_periods():
    r = random.Random(7)
    for _ in range(1500):
        x, n = [], r.randint(0, 70)
        while len(x) < n:
            unit = [r.randrange(r.randint(1, 4)) for _ in range(r.randint(1, 8))]
            x += unit * r.randint(1, 7)
        x = x[:n]
        got = list(zip(*(v.tolist() for v in periodic_runs.find_runs(np.array(x, dtype=np.int64))), strict=True))
        assert got == plain_runs(x), x


def test_texts_named_together_do_not_meet():
    runs, collapsed = periodic_runs.runs_of_texts(["x x x", "x x x", None, "", "a b " * 4, "q " * 6])
    assert [r.tolist() for r in runs] == [[], [], [], [], [[0, 8, 2]], [[0, 6, 1]]]
    assert collapsed == ["x x x", "x x x", "", "", "a b", "q"]


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


NAMES = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def check(docs):
    got = periodic_runs.run_digests(docs).collect()
    want = sorted((str(r["doc_id"]), *map(str, plain_row(r["doc_id"], r["text"]))) for r in docs.select("doc_id", "text").collect())
    assert sorted((str(r["doc_id"]), *(str(r[n]) for n in NAMES)) for r in got) == want
    return got


def test_query_equals_plain_python(spark):
    short = documents(spark, SF, "doc_id", "text").where("length(text) < 4000")
    assert sum(r["n_runs"] > 0 for r in check(short)) > 5
    r = random.Random(3)
    loops = [(i, " ".join((prose(i, r.randint(1, 9)) + " ") * r.randint(1, 9) + prose(i + 1, 5) for _ in range(3))) for i in range(150)]
    check(spark.createDataFrame(loops, "doc_id bigint, text string"))


def test_awkward_rows(spark):
    docs = awkward(spark)
    check(docs.where("text is null or length(text) < 3000"))
    out = periodic_runs.periodic_runs(docs)
    assert out.columns[:len(docs.columns)] == docs.columns and out.count() == docs.count()
    clash = periodic_runs.periodic_runs(docs.withColumnRenamed("ids", "runs"))
    assert dict(clash.dtypes)["runs"].startswith("array<struct")
    assert periodic_runs.run_digests(empty(spark)).count() == 0


def test_a_very_long_loop():
    runs, collapsed = periodic_runs.runs_of_texts([prose(1, 50) + " " + (prose(2, 1000) + " ") * 60])
    assert len(runs[0]) >= 1 and max(r[1] for r in runs[0].tolist()) >= 60_000 and len(collapsed[0].split()) <= 1060
