"""Versioned commits, change feed, snapshots and marks."""

import json
import os

from conftest import rows
from pyspark.sql import functions as F

from tidemark.sources import lake as L

SCHEMA = "k bigint, v string"


def _df(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_commits_feed_and_replay(spark, tmp_path):
    path = str(tmp_path / "t")
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    assert L.read_table(spark, path, schema).count() == 0             # missing table → empty, typed
    L.commit_append(_df(spark, [(1, "a"), (2, "b")]), path, 0, quarantine=_df(spark, [(9, "bad")]))
    L.commit_append(_df(spark, [(3, "c")]), path, 1)
    assert rows(L.read_table(spark, path, schema), "k", "commit_version") == [(1, 0), (2, 0), (3, 1)]
    assert rows(L.read_table(spark, path, schema, sink="quarantine"), "k") == [(9,)]
    assert rows(L.read_table(spark, path, schema, upto=0), "k") == [(1,), (2,)]
    feed = L.change_feed(spark, path, schema, 1, 1, with_metadata=True)
    assert rows(feed, "k", "_change_type", "_commit_version") == [(3, "insert", 1)]
    assert rows(L.change_feed(spark, path, schema, 0), "k") == [(1,), (2,), (3,)]
    # replaying commit 0 replaces it (rows and quarantine), other commits untouched
    L.commit_append(_df(spark, [(1, "a2")]), path, 0)
    assert rows(L.read_table(spark, path, schema), "k", "v") == [(1, "a2"), (3, "c")]
    assert L.read_table(spark, path, schema, sink="quarantine").count() == 0


def test_feed_filter_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    for v in range(3):
        L.commit_append(_df(spark, [(v, "x")]), path, v)
    plan = L.change_feed(spark, path, schema, 2, 2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "commit_version" in plan


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "mart")
    assert L.read_snapshot(spark, root, 0) is None
    L.write_snapshot(_df(spark, [(1, "a")]), root, 0)
    L.write_snapshot(_df(spark, [(2, "b")]), root, 1)
    assert rows(L.read_snapshot(spark, root, 0)) == [(1, "a")]
    assert rows(L.read_snapshot(spark, root, 1)) == [(2, "b")]


def test_marks_and_pending(spark, tmp_path):
    root = str(tmp_path)
    assert L.mark_of(spark, root, "silver", "orders") == -1
    L.advance_marks(spark, root, [("bronze", "orders", 0, "ok"), ("silver", "orders", 0, "ok")])
    L.advance_mark(spark, root, "bronze", "orders", 1)
    L.advance_mark(spark, root, "bronze", "orders", 2, "rejected")
    assert L.mark_of(spark, root, "bronze", "orders") == 2
    assert L.mark_of(spark, root, "silver", "orders") == 0
    cases = spark.createDataFrame([(2, 0), (1, 1), (0, 3)], "up int, down int")
    got = rows(cases.select("up", *L.pending_versions(F.col("up"), F.col("down"))))
    assert got == [(0, "conflict", None, None), (1, "up_to_date", None, None), (2, "pending", 1, 2)]
