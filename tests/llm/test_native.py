"""op2, op6, op7 against plain Python, and that their plans hold no Python."""

import os
import random
import re
import zlib

import pytest
from llm_data import SF, awkward, empty, prose
from pyspark.sql import functions as F

from tidemark.llm import kd_shards, quality_rules, secret_scan

PYTHON = re.compile("Python|Pandas|ArrowEval|MapInArrow")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- op2 -------------------------------------------------------------------------------------

def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen = {}
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i:i + 3]), []).append(i)
    covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def quality_texts():
    r = random.Random(4)
    texts = [None, "", " \n ", "a b", "a a a a a", "x y z x y z x y", "a b c a b", "é\x0bö # | <x>\x0c\x1c \x85 \xa0", "l\nl\n l\n\nl", prose(1, 80), prose(2, 3000),
             prose(3, 60).upper(), " ".join(w + "!!" for w in prose(4, 60).split()), " ".join(w + "$$$" for w in prose(5, 60).split()), "1 2 3 4 " * 40, "\n".join([prose(6, 12)] * 10)]
    return texts + [" ".join(r.choices("abcd", k=r.randint(0, 60))) for _ in range(60)]


def test_measures_equal_plain_python(spark):
    texts = quality_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    out = quality_rules.quality(docs)
    assert not PYTHON.search(plan(out))
    got = {r["doc_id"]: r for r in out.collect()}
    for i, t in enumerate(texts):
        r, want = got[i], plain_measures(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, t
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r["base_failed"] == failed and (not failed or not r["kept"])
    assert got[9]["kept"] and got[10]["kept"] and not any(got[i]["kept"] for i in (11, 12, 13, 14, 15))


def test_verdict_does_not_depend_on_the_order(spark):
    docs = spark.createDataFrame(list(enumerate(quality_texts())), "doc_id bigint, text string")
    measured = docs.withColumn("_m", quality_rules.base_measures(F.col("text"))).select("doc_id", "text", "_m.*")
    names = list(quality_rules.RULES)
    a, b = (measured.select("doc_id", quality_rules.cascade(measured, quality_rules.RULES, o).alias("kept")).orderBy("doc_id").collect() for o in (names, names[::-1]))
    assert a == b


def test_clashing_hash_parts_take_the_exact_path(spark):
    # Six hashes that agree in all but their low bits, laid so that equal ones are not neighbours.
    h = [8, 9, 8, 10, 9, 11]
    df = spark.createDataFrame([(h,)], "h array<bigint>")
    fast = df.select(quality_rules._repeated_fast(F.col("h"), F.lit(15).cast("bigint")).alias("x")).first()["x"]
    exact = df.select(quality_rules._repeated_exact(F.col("h")).alias("x")).first()["x"]
    assert fast is None and exact == [0, 1, 2, 4]


def test_quality_awkward(spark):
    assert quality_rules.quality(awkward(spark)).count() == awkward(spark).count()
    assert quality_rules.quality(empty(spark)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data missing")
def test_quality_oracle(spark):
    from oracle_harness import compare, duck
    got = quality_rules.quality(spark.read.parquet(f"{SF}/documents.parquet")).toPandas()
    ok, why = compare(got, duck(SF).execute(quality_rules.ORACLE_SQL).fetchdf())
    assert ok, why


# --- op6 -------------------------------------------------------------------------------------

def test_secrets_found_and_false_positives_left(spark):
    r = random.Random(2)

    def hexa(n):
        return "".join(r.choices("0123456789abcdef", k=n))

    rows, want = [], {}
    for i in range(200):
        words = prose(i, 40).split()
        kind = i % 8
        put = {0: f"password={hexa(18)}", 1: f'token = "{hexa(40)}"', 2: "AKIA" + "".join(r.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=16)),
               3: f"{r.randint(1, 250)}.{r.randint(1, 250)}.{r.randint(10, 250)}.{r.randint(10, 250)}", 4: f"joe{i}.{r.randint(10, 99)}@mail{i % 9}.example.com",
               5: str(r.randint(10**15, 10**16)), 6: "2021-03-04T10:20", 7: ""}[kind]
        words.insert(r.randrange(len(words)), put)
        rows.append((i, " ".join(words)))
        if kind < 3:
            want[i] = re.split(r"[= ]", put)[-1].strip('"')
    rows += [(900, None), (901, ""), (902, "-----BEGIN RSA PRIVATE KEY-----\nMIIabc123\n+/=\n-----END RSA PRIVATE KEY-----")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = secret_scan.scan(docs)
    assert not PYTHON.search(plan(out))
    assert {x["doc_id"] for x in out.collect()} == {*want, 902}
    clean = {x["doc_id"]: x["text"] for x in secret_scan.redact(docs).collect()}
    texts = dict(rows)
    for i, t in texts.items():
        if i in want:
            assert clean[i] == t.replace(want[i], "[SECRET]")
        elif i != 902:
            assert clean[i] == t
    assert "MIIabc123" not in clean[902]


def test_secrets_without_digits_and_key_blocks(spark):
    """Formats and names make findings without a digit; key blocks with headers, and without an END line."""
    r = random.Random(3)
    letters = "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=16))
    lines = "\n".join("".join(r.choices("ABCDEFGHIJKLMNOPabcdefghijklmnop+/", k=64)) for _ in range(6))
    rows, gone = [], {}
    for i in range(240):
        words = prose(i, 40).split()
        value = "".join(r.choices("0123456789abcdef", k=20))
        put, secret = [(f"password={value}", value), ("".join(r.choices("0123456789", k=12)), None), ("the key: understanding", None), ("secret:somebody", None),
                       (f"passwd = {'Aa'.join(r.choices(['Horse', 'Staple', 'Battery', 'Paper'], k=2))}!{'Bb'.join(r.choices(['Pen', 'Cup'], k=2))}", True), (f"joe@mail{i}.org", None)][i % 6]
        words.insert(r.randrange(len(words)), put)
        rows.append((i, " ".join(words)))
        if secret:
            gone[i] = put.split("=")[1].strip()
    special = {900: f"sk_live_{letters}", 901: f"ghp_{letters}{letters}{letters}", 902: "password = CorrectHorse!Battery", 903: '"password":"CorrectHorse!Battery"',
               904: f"-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A1B\n\n{lines}\n-----END RSA PRIVATE KEY-----", 905: f"-----BEGIN PRIVATE KEY-----\n{lines}"}
    rows += [(i, f"{prose(i, 20)} {t}\n{prose(i + 100, 20)}") for i, t in special.items()]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    clean = {x["doc_id"]: x["text"] for x in secret_scan.redact(docs).collect()}
    texts = dict(rows)
    for i in range(240):
        assert (clean[i] == texts[i]) == (i not in gone), texts[i]
        assert i not in gone or gone[i] not in clean[i]
    for i, held in {900: letters, 901: letters, 902: "CorrectHorse", 903: "CorrectHorse", 904: lines[:64], 905: lines[-64:]}.items():
        assert held not in clean[i] and clean[i].startswith(prose(i, 20)) and clean[i].endswith(prose(i + 100, 20)), clean[i]


def test_a_long_text_after_an_unclosed_key_stays(spark):
    text = "see -----BEGIN PRIVATE KEY----- in the manual - " + prose(1, 30_000) + " a-b" * 5000
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert secret_scan.redact(docs).first()["text"] == text


def test_forest_reads_as_spark_predicts(spark):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector
    r = random.Random(8)
    rows = [(float(k % 2 if r.random() < 0.8 else 1 - k % 2), r.random() + 0.3 * (k % 2), r.random() * (1 + k % 2), float(r.randint(0, 3))) for k in range(600)]
    frame = spark.createDataFrame(rows, "label double, a double, b double, c double").withColumn("features", array_to_vector(F.array("a", "b", "c")))
    forest = RandomForestClassifier(numTrees=secret_scan.TREES, maxDepth=secret_scan.DEPTH, seed=1).fit(frame)
    votes = secret_scan.forest_score(forest.toDebugString, [F.col("a"), F.col("b"), F.col("c")])
    trees = frame.select("features", votes.alias("votes")).collect()
    assert len({x["votes"] for x in trees}) > 5
    for x in trees:
        assert x["votes"] == sum(t.predict(x["features"]) for t in forest.trees) / secret_scan.TREES


def test_printed_forest_reads_back():
    text = ("RandomForestClassificationModel: uid=x, numTrees=2, numClasses=2, numFeatures=2\n  Tree 0 (weight 1.0):\n    If (feature 0 <= 0.5)\n     Predict: 0.0\n"
            "    Else (feature 0 > 0.5)\n     If (feature 1 <= 2.0)\n      Predict: 1.0\n     Else (feature 1 > 2.0)\n      Predict: 0.0\n  Tree 1 (weight 1.0):\n    Predict: 1.0\n")
    from pyspark.sql import SparkSession
    df = SparkSession.getActiveSession().createDataFrame([(0.0, 1.0), (1.0, 1.0), (1.0, 3.0)], "a double, b double")
    got = [r[0] for r in df.select(secret_scan.forest_score(text, [F.col("a"), F.col("b")])).collect()]
    assert got == [0.5, 1.0, 0.5]


def test_secret_awkward(spark):
    assert secret_scan.redact(awkward(spark)).columns == awkward(spark).columns
    assert secret_scan.redact(awkward(spark)).count() == awkward(spark).count()
    assert secret_scan.scan(empty(spark)).count() == 0


# --- op7 -------------------------------------------------------------------------------------

def shard_check(docs_rows, got, shards=8):
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((i is None, i or 0) for i, _ in docs_rows)
    for k in range(shards):
        assert sorted(r["slot"] for r in got if r["shard"] == k) == list(range(sum(r["shard"] == k for r in got)))
    assert all(0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None for r in got)


def test_shards_are_near_equal_and_keep_groups(spark):
    r = random.Random(1)
    texts = [prose(i, r.randint(1, 400)) for i in range(600)]
    rows = [(i, texts[i % 500]) for i in range(900)]
    r.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = kd_shards.eight_shards(docs)
    assert not PYTHON.search(plan(out))
    got = out.collect()
    shard_check(rows, got)
    of = dict(rows)
    size = {i: len(t.encode()) + 1 for i, t in rows}
    assert all(x["size"] == size[x["doc_id"]] and x["text_crc32"] == zlib.crc32(of[x["doc_id"]].encode()) for x in got)
    total = [sum(x["size"] for x in got if x["shard"] == k) for k in range(8)]
    assert max(total) - min(total) <= 0.1 * sum(total) / 8
    homes = {}
    for x in got:
        homes.setdefault(of[x["doc_id"]], set()).add(x["shard"])
    assert sum(len(h) > 1 for h in homes.values()) <= 7  # only a group across a cut may be divided


def test_a_heavy_group_is_divided(spark):
    rows = [(i, "same text again" if i < 500 else prose(i, 12)) for i in range(900)]
    got = kd_shards.eight_shards(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    shard_check(rows, got)
    total = [sum(x["size"] for x in got if x["shard"] == k) for k in range(8)]
    assert max(total) - min(total) <= 0.1 * sum(total) / 8


def test_shards_awkward(spark):
    docs = awkward(spark)
    shard_check([(r["doc_id"], r["text"]) for r in docs.collect()], kd_shards.eight_shards(docs).collect())
    assert kd_shards.eight_shards(empty(spark)).count() == 0
    one = spark.createDataFrame([(5, None)], "doc_id bigint, text string")
    assert [tuple(r)[:4] for r in kd_shards.eight_shards(one).collect()] == [(5, 1, 0, "bytes")]
