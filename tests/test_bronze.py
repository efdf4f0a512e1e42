"""Landing split and bad-row gate (keys_single, keys_pair, empty batch)."""

from conftest import rows

from tidemark.plans import bronze as B


def _orders(spark, ids):
    return spark.createDataFrame([(i, 1) for i in ids], "oid bigint, customer_id bigint")


def test_single_key_split_and_gate(spark):
    landed = B.ingest(_orders(spark, [1, 2, None, 3]), "orders")       # 1/4 bad → passes
    g = landed.gate.first()
    assert (g["rows"], g["bad_rows"], g["passed"]) == (4, 1, True)
    assert rows(landed.accepted, "oid") == [(1,), (2,), (3,)]
    assert rows(landed.quarantined, "oid") == [(None,)]


def test_gate_at_30_percent_is_inclusive_except_products(spark):
    ids = [1, 2, 3, 4, 5, 6, 7, None, None, None]                       # 3/10 bad
    assert B.ingest(_orders(spark, ids), "orders").gate.first()["passed"] is False
    assert B.ingest(_orders(spark, ids), "orders").accepted.count() == 0
    prods = spark.createDataFrame([(i,) for i in ids], "pid bigint")
    landed = B.ingest(prods, "products")                                 # strict: 3 > 3 is false
    assert landed.gate.first()["passed"] is True
    assert landed.accepted.count() == 7 and landed.quarantined.count() == 3


def test_empty_batch_is_rejected_under_inclusive_gate(spark):
    g = B.ingest(_orders(spark, []), "orders").gate.first()
    assert (g["rows"], g["bad_rows"], g["passed"]) == (0, 0, False)
    g = B.ingest(spark.createDataFrame([], "pid bigint"), "products").gate.first()
    assert g["passed"] is True


PAIRS = [(1, 1), (None, 1), (1, None), (None, None)]


def test_composite_keys_overlap_gap_and_complement(spark):
    items = spark.createDataFrame(PAIRS * 3 + [(2, 2)] * 30, "order_item_id bigint, order_id bigint")
    landed = B.ingest(items, "order_items")
    assert set(rows(landed.accepted)) == {(1, 1), (None, 1), (1, None), (2, 2)}
    assert set(rows(landed.quarantined)) == {(None, 1), (1, None), (None, None)}

    logs = spark.createDataFrame(PAIRS * 3 + [(2, 2)] * 10, "log_id bigint, order_id bigint")
    landed = B.ingest(logs, "order_status_log")
    assert set(rows(landed.accepted)) == {(1, 1), (None, 1), (1, None), (2, 2)}
    assert set(rows(landed.quarantined)) == {(None, 1)}            # all-null row goes nowhere

    inv = spark.createDataFrame(PAIRS + [(2, 2)] * 10, "inventory_id bigint, product_id bigint")
    landed = B.ingest(inv, "inventory")
    acc, quar = rows(landed.accepted), rows(landed.quarantined)
    assert len(acc) + len(quar) == 14 and not set(acc) & set(quar)  # exact complement
