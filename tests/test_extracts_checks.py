"""Paged extracts (date bounds, pages) and the consistency checks."""

import datetime as dt

from conftest import rows

from tidemark.plans import checks as K
from tidemark.plans import extracts as X

D = lambda d: dt.date(2026, 7, d)


def _orders(spark):
    return spark.createDataFrame([(i, 1, D(i)) for i in range(1, 6)], "oid bigint, customer_id bigint, order_date date")


def test_date_bounds(spark):
    o = _orders(spark)
    ids = lambda df: [r[0] for r in rows(df, "oid")]
    assert ids(X.orders_between(o)) == [1, 2, 3, 4, 5]
    assert ids(X.orders_between(o, from_date="2026-07-04")) == [4, 5]
    assert ids(X.orders_between(o, to_date="2026-07-02")) == [1, 2]
    assert ids(X.orders_between(o, "2026-07-02", "2026-07-03")) == [2, 3]
    assert ids(X.orders_between(o, "2026-07-04", "2026-07-02")) == []


def test_pages_of_child_rows_by_parent_date(spark):
    items = spark.createDataFrame([(10, 1), (11, 2), (12, 2), (13, 3)], "order_item_id bigint, order_id bigint")
    got = X.page_order_items(items, _orders(spark), on_date="2026-07-02", limit=1)
    assert rows(got, "order_item_id", "page", "total_pages") == [(11, 1, 2), (12, 2, 2)]
    assert rows(X.page(got, 2), "order_item_id") == [(12,)]
    c = X.page_counts(items, "order_items", 3).first()
    assert (c.rows, c.total_pages) == (4, 2)


def test_transitions(spark):
    t = lambda h: dt.datetime(2026, 7, 1, h)
    logs = spark.createDataFrame([
        (1, 7, None, "pending", t(1)), (2, 7, "pending", "confirmed", t(2)),
        (3, 7, "confirmed", "delivered", t(3)),     # illegal jump
        (4, 7, "delivered", "returned", t(2)),      # legal but earlier than the previous log
        (5, 8, "shipped", "returned", t(5)),
    ], "log_id bigint, order_id bigint, old_status string, new_status string, changed_at timestamp")
    got = rows(K.status_transitions(logs), "log_id", "illegal_transition", "not_after_previous")
    assert got == [(3, True, False), (4, False, True)]


def test_restock(spark):
    products = spark.createDataFrame([(1, D(1)), (2, D(1)), (3, D(20))], "pid bigint, created_at date")
    inv = spark.createDataFrame([(2, D(5)), (3, D(9)), (3, D(7)), (3, None)],
                                "product_id bigint, last_restocked_at date")
    got = rows(K.product_last_restock(products, inv))
    assert got == [(1, D(1)), (2, D(5)), (3, D(7))]


def test_eligible_customers_and_orphans(spark):
    customers = spark.createDataFrame([(1, D(1)), (2, D(3)), (3, D(3)), (4, D(9))], "customer_id bigint, join_date date")
    orders = spark.createDataFrame([(1, 1, D(2)), (2, 1, D(3)), (3, 1, D(30))], "oid bigint, customer_id bigint, order_date date")
    assert rows(K.eligible_customers(customers, orders)) == [(D(2), 1), (D(3), 3), (D(30), 4)]
    items = spark.createDataFrame([(1,), (1,), (3,)], "order_id bigint")
    assert rows(K.orders_without_items(orders, items), "oid") == [(2,)]


def test_date_equality_filters(spark):
    customers = spark.createDataFrame([(1, D(1)), (2, D(2)), (3, D(2))], "customer_id bigint, join_date date")
    assert rows(X.page_customers(customers, on_date="2026-07-02", limit=1), "customer_id", "page") == [(2, 1), (3, 2)]
    products = spark.createDataFrame([(1, D(1)), (2, D(2))], "pid bigint, created_at date")
    assert rows(X.page_products(products, on_date=D(1)), "pid", "total_pages") == [(1, 1)]
    inv = spark.createDataFrame([(7, 1, D(3)), (8, 1, D(4))], "inventory_id bigint, product_id bigint, last_restocked_at date")
    assert rows(X.page_inventory(inv, on_date="2026-07-04 10:00:00"), "inventory_id") == [(8,)]
    assert X.page_inventory(inv, on_date="2026-07-05").count() == 0
