"""Order histories as a stream's state: equal to the batch in any split, commits that touch only their buckets."""

import datetime as dt
import random

import pytest
from conftest import rows

from tidemark.plans.checks import status_transitions
from tidemark.schemas import ORDER_STATUS_LOG
from tidemark.sources import lake as L
from tidemark.streaming import order_history
from tidemark.streaming.order_history import OrderHistory, follow

STATES = ["pending", "confirmed", "shipped", "delivered", "returned", "cancelled"]


def some_logs(n=300, seed=1):
    """Logs of 30 orders, a third of them of one order; times mostly advance; nulls, a repeated row, an order without an id."""
    r = random.Random(seed)
    day = dt.datetime(2026, 1, 1)
    out, state = [], {}
    for i in range(1, n + 1):
        order = 7 if r.random() < 0.34 else r.choice([*range(30), None])
        new = r.choice(STATES)
        at = None if r.random() < 0.05 else day + dt.timedelta(minutes=i + r.choice([0, 0, 0, -9]))
        out.append((i, order, state.get(order), new, at, "x", None))
        state[order] = new
    return [*out, out[20], (None, 3, "pending", "cancelled", day, None, None)]


@pytest.mark.parametrize("split", ["in order", "mixed", "backwards"])
def test_history_equals_the_batch_in_any_split(spark, tmp_path, monkeypatch, split):
    monkeypatch.setattr(order_history, "SPAN", 16)  # most orders lie in many spans
    logs = some_logs()
    r = random.Random(4)
    parts = {"in order": [logs[:90], logs[90:200], logs[200:]], "backwards": [logs[200:], logs[90:200], logs[:90]]}.get(split)
    if parts is None:
        r.shuffle(logs)
        parts = [logs[:100], [], logs[100:130], logs[130:]]
    path, history = str(tmp_path / "logs"), OrderHistory(spark, str(tmp_path / "state"), n=4)
    for v, part in enumerate(parts):
        L.commit_append(spark.createDataFrame(part, ORDER_STATUS_LOG).repartition(2), path, v)
        follow(spark, path, history, str(tmp_path / "ckpt"))
        so_far = [x for p in parts[:v + 1] for x in p if x[0] is not None]
        assert rows(history.transitions()) == rows(status_transitions(spark.createDataFrame(so_far, ORDER_STATUS_LOG)))
    assert history.transitions().count() > 50
    before = rows(history.transitions())
    history.step(len(parts) - 1, spark.createDataFrame(parts[-1], ORDER_STATUS_LOG))  # a commit taken twice
    assert rows(history.transitions()) == before


def test_several_commits_in_one_micro_batch(spark, tmp_path):
    logs = some_logs(seed=2)
    path, history = str(tmp_path / "logs"), OrderHistory(spark, str(tmp_path / "state"), n=4)
    for v in range(3):
        L.commit_append(spark.createDataFrame(logs[v::3], ORDER_STATUS_LOG), path, 2 * v)
    follow(spark, path, history, str(tmp_path / "ckpt"))
    whole = spark.createDataFrame([x for x in logs if x[0] is not None], ORDER_STATUS_LOG)
    assert history.last_version() == 4 and rows(history.transitions()) == rows(status_transitions(whole))
    assert OrderHistory(spark, str(tmp_path / "none")).transitions().count() == 0


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    history = OrderHistory(spark, str(tmp_path / "state"), n=16)
    history.step(0, spark.createDataFrame(some_logs(), ORDER_STATUS_LOG))
    history.step(1, spark.createDataFrame([(1000, 5, "pending", "confirmed", dt.datetime(2026, 3, 1), None, None)], ORDER_STATUS_LOG))
    for table in (history.logs, history.edges):
        held = table.map(1)
        assert sum(v == 1 for v in held.values()) == 1 and all(table.map(0)[b] == v for b, v in held.items() if v == 0)
