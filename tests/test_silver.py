"""Cleaning steps V1–V6 on hand-written rows (dup_batch, product_ranges, item_ranges,
order_enrich, log_repair) and the key-join operators."""

import datetime as dt
from decimal import Decimal

from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import cleaning as C
from tidemark.plans import silver as S
from tidemark.schemas import CUSTOMERS, INVENTORY, ORDER_ITEMS, ORDER_STATUS_LOG, ORDERS, PRODUCTS

D = dt.date(2026, 7, 1)


def test_customers_one_survivor_and_repeat_quarantined(spark):
    batch = spark.createDataFrame([(1, "bob", None, "x", "y", D), (1, "al", None, "x", "y", D),
                                   (2, "cy", None, "x", "y", D)], CUSTOMERS)
    before = spark.createDataFrame([(2, "old", None, "x", "y", D)], CUSTOMERS)
    out = S.silver_customers(batch, before)
    assert rows(out.accepted, "customer_id", "name") == [(1, "al")]      # smallest row survives
    assert rows(out.quarantined, "customer_id", "name") == [(2, "cy")]


def test_products_ranges_and_repair(spark):
    mk = lambda pid, price, stock, name="p": (pid, name, None, "s", "b", price, 0.0, stock, None, D)
    batch = spark.createDataFrame([mk(1, 0.0, 1), mk(2, 1.0, 5, None), mk(3, 1.0, -1), mk(4, 1.0, 0),
                                   mk(5, None, 1), mk(4, 1.0, 0)], PRODUCTS)
    out = S.silver_products(batch, None)
    assert rows(out.accepted, "pid", "product_name", "category", "supplier") == [
        (2, "N/A", "N/A", "N/A"), (4, "p", "N/A", "N/A")]


def _item(iid, oid, pid, qty, price, disc):
    p = None if price is None else Decimal(str(price))
    d = None if disc is None else Decimal(str(disc))
    return (iid, oid, pid, qty, p, d, p, None)


def test_items_or_accept_or_reject_overlap(spark):
    products = spark.createDataFrame([(1,)], "pid bigint")
    batch = spark.createDataFrame([
        _item(10, 1, 1, 0, 5, 0),        # qty 0, price 5: accepted (price>0) AND quarantined (qty<=0)
        _item(11, 1, 1, -1, -1, -1),     # every number bad: quarantined only
        _item(12, 1, 9, 1, 5, 0),        # unknown product: quarantined only
        _item(13, 1, 1, None, None, None),   # all-null numbers: neither predicate holds
        _item(14, 1, 1, 2, 3, 1),        # clean
    ], ORDER_ITEMS)
    out = S.silver_order_items(batch, None, products)
    assert rows(out.accepted, "order_item_id") == [(10,), (14,)]
    assert rows(out.quarantined, "order_item_id") == [(10,), (11,), (12,)]


def test_items_repeat_against_silver_is_quarantined(spark):
    products = spark.createDataFrame([(1,)], "pid bigint")
    before = spark.createDataFrame([_item(14, 1, 1, 2, 3, 1)], ORDER_ITEMS)
    batch = spark.createDataFrame([_item(14, 1, 1, 2, 3, 1), _item(15, 1, 1, 2, 3, 1)], ORDER_ITEMS)
    out = S.silver_order_items(batch, before, products)
    assert rows(out.accepted, "order_item_id") == [(15,)]
    assert rows(out.quarantined, "order_item_id") == [(14,)]


def test_orders_enriched_rejected_and_amounts_replaced(spark):
    customers = spark.createDataFrame([(7, "c", None, None, None, D)], CUSTOMERS)
    items = spark.createDataFrame([
        (1, 100, 1, 2, Decimal("10.00"), Decimal("10.00"), Decimal("18.00"), Decimal("20.00")),
        (2, 100, 1, 1, Decimal("5.00"), Decimal("0.00"), Decimal("5.00"), Decimal("5.00")),
        (3, 102, 1, 1, Decimal("5.00"), Decimal("5.00"), Decimal("4.75"), Decimal("5.00")),
        (4, 103, 1, 1, Decimal("5.00"), Decimal("5.00"), Decimal("4.75"), Decimal("5.00")),
    ], ORDER_ITEMS)
    o = lambda oid, cid, status=None: (oid, cid, D, status, "UPI", None, 0.0, 0.0, 0.0)
    batch = spark.createDataFrame([o(100, 7), o(101, 7, "x"), o(102, 8), o(103, 7), o(100, 7)], ORDERS)
    before_rows = [(103, 7, D, "s", "UPI", "a", Decimal("5.00"), Decimal("5.000000"), Decimal("4.75"))]
    before = spark.createDataFrame(before_rows, "oid bigint, customer_id bigint, order_date date, order_status string, "
                                   "payment_method string, shipping_address string, total_amount decimal(18,2), "
                                   "discount_applied decimal(12,6), final_amount decimal(18,2)")
    out = S.silver_orders(batch, before, customers, items)
    acc = out.accepted.collect()
    assert len(acc) == 1
    r = acc[0]
    assert (r.oid, r.order_status, r.shipping_address) == (100, "Unknown", "Unknown")
    assert (r.total_amount, r.discount_applied, r.final_amount) == (Decimal("25.00"), Decimal("5.000000"), Decimal("23.00"))
    # 101 has no items, 102 an unknown customer, 103 is already loaded
    assert rows(out.quarantined, "oid") == [(101,), (102,), (103,)]


def test_inventory_and_logs_repair_and_reject(spark):
    products = spark.createDataFrame([(1,)], "pid bigint")
    inv = spark.createDataFrame([(1, 1, None, 5, 10, D), (2, 9, "w", 5, 10, D), (3, 1, "w", -1, 10, D)], INVENTORY)
    out = S.silver_inventory(inv, None, products)
    assert rows(out.accepted, "inventory_id", "warehouse_location") == [(1, "N/A")]
    assert rows(out.quarantined, "inventory_id") == [(2,), (3,)]

    orders = spark.createDataFrame([(100,)], "oid bigint")
    ts = dt.datetime(2026, 7, 1, 10, 0)
    logs = spark.createDataFrame([(1, 100, None, None, ts, None, None), (2, 555, "a", "b", ts, "x", "r"),
                                  (3, 100, "pending", "confirmed", ts, "u", "ok")], ORDER_STATUS_LOG)
    before = spark.createDataFrame([(3, 100, "pending", "confirmed", ts, "u", "ok")], ORDER_STATUS_LOG)
    out = S.silver_order_status_log(logs, before, orders)
    assert rows(out.accepted) == [(1, 100, "Unknown", "Unknown", ts, "Unknown", "N/A")]
    assert rows(out.quarantined, "log_id") == [(2,), (3,)]


keys = st.lists(st.one_of(st.none(), st.integers(0, 30)), max_size=40)


@settings(max_examples=8, deadline=None)
@given(batch=keys, existing=keys)
def test_shrink_then_anti_equals_plain_anti(spark, batch, existing):
    b = spark.createDataFrame([(k, i) for i, k in enumerate(batch)], "k bigint, i int")
    e = spark.createDataFrame([(k,) for k in existing], "k bigint")
    got_new = rows(C.new_rows_anti(b, e, ["k"]))
    got_dup = rows(C.dup_rows_semi(b, e, ["k"]))
    ex = {k for k in existing if k is not None}
    assert got_new == sorted([(k, i) for i, k in enumerate(batch) if k not in ex],
                             key=lambda t: tuple((x is None, str(x)) for x in t))
    assert got_dup == sorted([(k, i) for i, k in enumerate(batch) if k in ex],
                             key=lambda t: tuple((x is None, str(x)) for x in t))


def test_dedup_by_key_is_row_number_first(spark):
    from pyspark.sql import Window
    data = [(1, "b", 2), (1, "a", 9), (1, "a", 3), (2, None, 1), (2, "z", 0), (None, "q", 1), (None, "p", 5)]
    df = spark.createDataFrame(data, "k bigint, s string, n int")
    w = Window.partitionBy("k").orderBy(F.col("s").asc_nulls_first(), F.col("n").asc_nulls_first())
    expect = df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    assert rows(C.dedup_by_key(df, ["k"])) == rows(expect)
