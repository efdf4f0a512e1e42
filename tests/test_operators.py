"""Distributed rank / ntile / pages, the skew-safe lag, and MERGE on snapshots."""

import random

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.merge import merge_update_only, merge_upsert
from tidemark.operators.ordered import lag_within
from tidemark.operators.ranking import assign_pages, distributed_ntile, distributed_rank


@pytest.mark.parametrize("n", [1, 3, 4, 5, 9, 50])
def test_distributed_ntile_equals_window_ntile(spark, n):
    data = [(i, float(random.Random(n * 100 + i).randint(0, 3))) for i in range(n)]   # many ties
    df = spark.createDataFrame(data, "id bigint, v double")
    order = [F.col("v").desc(), F.col("id").asc()]
    got = distributed_ntile(df, order, 4, "t", num_partitions=3)
    expect = df.withColumn("t", F.ntile(4).over(Window.orderBy(*order)))
    assert rows(got, "id", "t") == rows(expect, "id", "t")


def test_distributed_rank_is_dense_and_total(spark):
    df = spark.range(0, 1000).withColumn("v", (F.col("id") * 7919) % 1000)
    r = distributed_rank(df, [F.col("v"), F.col("id")], num_partitions=7)
    got = r.select("_rank", "_total").collect()
    assert sorted(x._rank for x in got) == list(range(1000))
    assert {x._total for x in got} == {1000}


@pytest.mark.parametrize("n,pages", [(0, 0), (1, 1), (500, 1), (501, 2)])
def test_pages_partition_the_table(spark, n, pages):
    df = spark.range(0, n).withColumnRenamed("id", "k")
    p = assign_pages(df, [F.col("k")], 500).collect()
    assert len(p) == n
    assert {r.total_pages for r in p} <= {pages}
    if n:
        assert max(r.page for r in p) == pages
        # page order follows key order, and each page holds at most `limit` rows
        by_key = sorted(p, key=lambda r: r.k)
        assert [r.page for r in by_key] == sorted(r.page for r in by_key)
        assert max(sum(1 for r in p if r.page == q) for q in range(1, pages + 1)) <= 500


def test_pages_per_group(spark):
    df = spark.createDataFrame([(d, k) for d in ("a", "b") for k in range(5 if d == "a" else 2)], "dt string, k int")
    p = rows(assign_pages(df, [F.col("k")], 2, group_by=["dt"]), "dt", "k", "page", "total_pages")
    assert p == [("a", 0, 1, 3), ("a", 1, 1, 3), ("a", 2, 2, 3), ("a", 3, 2, 3), ("a", 4, 3, 3),
                 ("b", 0, 1, 1), ("b", 1, 1, 1)]


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_lag_within_equals_window_lag_with_hot_key(spark, parts):
    rnd = random.Random(parts)
    # key 0 holds half of all rows; some null keys and values
    data = [(0 if rnd.random() < 0.5 else rnd.choice([1, 2, 3, None]), rnd.randint(0, 50), i,
             rnd.choice(["x", "y", None])) for i in range(400)]
    df = spark.createDataFrame(data, "k bigint, t int, id int, v string")
    got = lag_within(df, ["k"], ["t", "id"], {"v": "prev_v", "t": "prev_t"}, num_partitions=parts)
    w = Window.partitionBy("k").orderBy("t", "id")
    expect = df.select("*", F.lag("v").over(w).alias("prev_v"), F.lag("t").over(w).alias("prev_t"))
    assert rows(got) == rows(expect)


def _mart(spark, data):
    return spark.createDataFrame(data, "id bigint, name string, total double, tier string")


def test_merge_upsert_updates_listed_columns_and_inserts(spark):
    target = _mart(spark, [(1, "keep", 1.0, "a"), (2, "untouched", 2.0, "b")])
    source = _mart(spark, [(1, "new name", 10.0, "z"), (3, "fresh", 3.0, "c")])
    out = merge_upsert(target, source, ["id"], ["total", "tier"])
    assert rows(out) == [(1, "keep", 10.0, "z"), (2, "untouched", 2.0, "b"), (3, "fresh", 3.0, "c")]


def test_merge_update_only_never_inserts(spark):
    target = _mart(spark, [(1, "keep", 1.0, "a"), (2, "untouched", 2.0, "b")])
    source = spark.createDataFrame([(1, "Gold"), (3, "Silver")], "id bigint, tier string")
    out = merge_update_only(target, source, ["id"], ["tier"])
    assert rows(out) == [(1, "keep", 1.0, "Gold"), (2, "untouched", 2.0, "b")]
