"""One-pass routing: overlaps, reasons, the gate counted while a commit is written, rejected batches, plans of one scan."""

import datetime as dt
import re

from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from tidemark.operators import routing as R
from tidemark.plans import bronze as B
from tidemark.plans import flow
from tidemark.plans import pipeline as P
from tidemark.plans import silver as S
from tidemark.schemas import CORRUPT, ORDER_STATUS_LOG
from tidemark.sources import lake as L


def test_a_row_goes_to_every_sink_it_meets(spark):
    df = spark.createDataFrame([(1, 5), (2, -1), (3, None), (4, 0)], "k int, n int")
    out = R.route(df, "here", [("main", None, F.col("n") >= 0), ("quarantine", "low", F.col("n") <= 0), ("quarantine", F.when(F.col("k") > 2, "late"), F.col("k") > 3)])
    assert rows(out, "k", "sink", "reason", "layer") == sorted(
        [(1, "main", None, None), (4, "main", None, None), (2, "quarantine", "low", "here"), (4, "quarantine", "low", "here"), (4, "quarantine", "late", "here")],
        key=lambda t: tuple((x is None, str(x)) for x in t))


def test_flags_and_null_keys(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (1,)], "k int")
    ref = spark.createDataFrame([(1,), (1,), (None,), (9,)], "r int")
    assert rows(R.flag_known(df, "k", ref, "r", "f")) == [(1, True), (1, True), (2, False), (None, False)]
    assert rows(R.flag_known(df, "k", None, "r", "f"), "f") == [(False,)] * 4


def test_rejected_rows_by_key(spark):
    tagged = spark.createDataFrame([(1, True, None), (1, False, "a"), (2, False, "b"), (None, True, None), (None, False, "c")], "k int, _ok boolean, reason string")
    out = R.reject_by_key(tagged, ["k"], "silver", "test")
    assert set(rows(out, "k", "sink", "reason")) == {(1, "main", None), (2, "quarantine", "b"), (None, "main", None), (None, "quarantine", "null_key"), (None, "quarantine", "c")}


def test_corrupt_rows_count_against_the_gate_and_are_quarantined(spark):
    batch = spark.createDataFrame([(1, None), (2, None), (3, None), (None, "{half"), (None, None)], f"oid bigint, {CORRUPT} string")
    landed = B.ingest(batch, "orders")
    gate = landed.gate.first()
    assert (gate["rows"], gate["bad_rows"], gate["passed"]) == (5, 2, False)
    routed = B.split(batch, "orders")
    assert rows(routed.where("sink = 'quarantine'"), "reason", CORRUPT) == [("corrupt_record", "{half"), ("null_key", None)]


def logs(spark, ids):
    t = dt.datetime(2026, 7, 1)
    return spark.createDataFrame([(i, 1, None, "pending", t, None, None) for i in ids], ORDER_STATUS_LOG)


def test_gate_is_counted_while_the_commit_is_written(spark, tmp_path):
    paths, report = P.Paths(str(tmp_path)), P.RunReport(0)
    bronze = paths.table("bronze", "order_status_log")
    assert P.ingest_batch(spark, paths, "order_status_log", logs(spark, [1, 2, 3, None]), 0, report) == 4
    assert L.read_table(spark, bronze, ORDER_STATUS_LOG).count() == 4                     # a half-null row is accepted as well
    lost = L.read_quarantine(spark, bronze, ORDER_STATUS_LOG).collect()
    assert [(r["log_id"], r["reason"], r["layer"]) for r in lost] == [(None, "null_key", "bronze")]
    assert P.ingest_batch(spark, paths, "order_status_log", logs(spark, [4, None]), 1, report) == 2
    assert P.ingest_batch(spark, paths, "order_status_log", logs(spark, []), 2, report) == 0
    assert P.ingest_batch(spark, paths, "order_status_log", L.empty(spark, ORDER_STATUS_LOG), 3, report) == 0
    assert [s[2] for s in report.statuses] == ["ok", "rejected", "empty", "empty"]
    assert L.read_table(spark, bronze, ORDER_STATUS_LOG).where("commit_version > 0").count() == 0
    assert L.read_quarantine(spark, bronze, ORDER_STATUS_LOG).where("commit_version > 0").count() == 0


def test_a_rejected_batch_leaves_an_empty_commit_in_the_flow(spark):
    landed = flow.landed(spark, SF_SMALL, "order_status_log")
    gate = {r["commit_version"]: r["passed"] for r in landed.gate.collect()}
    assert gate == {0: True, 1: False, 2: True}
    assert {r[0] for r in landed.routed.select("commit_version").distinct().collect()} == {0, 2}


def test_every_reject_path_carries_rows(spark):
    """The views' faults reach the quarantine of each bronze table and each reason of the silver steps."""
    for name in P.SILVER_ORDER:
        assert flow.landed(spark, SF_SMALL, name).quarantined.count() > 0, name
    lake, seen = flow.replay_lake(spark, SF_SMALL), {}
    for name in P.SILVER_ORDER:
        seen[name] = {r["reason"] for r in lake.cleaned(name).routed.where("sink = 'quarantine'").select("reason").distinct().collect()}
    assert seen["customers"] == seen["products"] == {"already_loaded"}
    assert seen["order_items"] == {"already_loaded", "bad_number", "unknown_product"}
    assert seen["orders"] == {"already_loaded", "no_items", "unknown_customer"}
    assert seen["inventory"] >= {"already_loaded", "bad_number", "unknown_product"}
    assert seen["order_status_log"] >= {"already_loaded", "null_key"}


def test_one_scan_of_the_batch_per_step(spark, tmp_path):
    """Items: the rows are scanned once; the two other scans of the batch read only the key that they look up."""
    from tidemark.schemas import ENTITIES
    L.commit_append(L.empty(spark, ENTITIES["order_items"]), str(tmp_path / "batch"), 0)
    batch = L.read_table(spark, str(tmp_path / "batch"), ENTITIES["order_items"])
    before = spark.createDataFrame([], ENTITIES["order_items"])
    out = S.silver_order_items(batch, before, spark.createDataFrame([(1,)], "pid bigint"))
    plan = out.routed._jdf.queryExecution().optimizedPlan().toString()
    scans = re.findall(r"Relation \[[^\]]*order_item_id[^\]]*\] parquet", plan)
    wide = re.findall(r"Project \[[^\]]*line_total[^\]]*\]\n[^\n]*(?:Filter[^\n]*\n[^\n]*)?Relation", plan)
    assert len(scans) <= 3 and len(wide) <= 1
