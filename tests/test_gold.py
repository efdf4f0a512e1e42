"""Marts on hand-written rows: churn edges, tiers, product gaps, category ties, and the
incremental (k commits) ≡ one batch invariants."""

import datetime as dt
from decimal import Decimal

from conftest import rows
from pyspark.sql import functions as F

from tidemark.plans import gold as G

D0 = dt.date(2026, 7, 1)


def as_of():
    return F.to_timestamp(F.lit("2026-08-01 00:00:00"))


def test_churn_edges(spark):
    from tidemark.functions.labels import churn_label
    asof = dt.date(2026, 8, 1)
    gaps = [15, 16, 30, 31, None]
    df = spark.createDataFrame([(g, None if g is None else asof - dt.timedelta(days=g)) for g in gaps],
                               "gap int, last date")
    got = rows(df.select("gap", churn_label(F.lit(asof), F.col("last")).alias("c")))
    assert got == [(15, "Low"), (16, "Medium"), (30, "Medium"), (31, "High"), (None, "Low")]


def _orders(spark, data):
    return spark.createDataFrame(
        [(oid, cid, d, Decimal(str(amt))) for oid, cid, d, amt in data],
        "oid bigint, customer_id bigint, order_date date, final_amount decimal(18,2)")


def _customers(spark, ids):
    return spark.createDataFrame([(i, f"c{i}", None, "x", "y", D0) for i in ids],
                                 "customer_id bigint, name string, email string, city string, country string, join_date date")


def test_tiers_with_equal_totals_and_small_counts(spark):
    for n in (1, 3, 4, 5, 9):
        orders = _orders(spark, [(i, i, D0, 10) for i in range(n)])
        mart = G.customer_360(None, orders, orders, _customers(spark, range(n)), as_of())
        got = [r.customer_tier for r in mart.orderBy("customer_id").collect()]
        labels = ["Platinum", "Gold", "Silver", "bronze"]
        q, m = divmod(n, 4)
        sizes = [q + (1 if i < m else 0) for i in range(4)]
        expect = [lab for lab, s in zip(labels, sizes) for _ in range(s)]
        assert got == expect, n


def test_customer_360_upsert_keeps_untouched_rows(spark):
    o1 = _orders(spark, [(1, 1, D0, 10), (2, 2, D0, 30)])
    m1 = G.customer_360(None, o1, o1, _customers(spark, [1, 2]), F.to_timestamp(F.lit("2026-07-05 00:00:00")))
    batch = _orders(spark, [(3, 1, dt.date(2026, 7, 10), 50)])   # 22 days before as-of
    all_orders = o1.unionByName(batch)
    m2 = G.customer_360(m1, all_orders, batch, _customers(spark, [1, 2]), as_of())
    got = {r.customer_id: r for r in m2.collect()}
    assert got[1].total_order_value == Decimal("60.00") and got[1].total_orders == 2
    assert got[1].customer_tier == "Platinum" and got[2].customer_tier == "Gold"
    assert str(got[2].updated_at) == "2026-07-05 00:00:00"        # untouched: keeps its own time
    assert got[2].churn_risk_score == "Low" and got[1].churn_risk_score == "Medium"


def _dps(spark, days, pid=1, cat="c", name="p"):
    return spark.createDataFrame(
        [(pid, name, cat, "s", "b", 1.0, D0 + dt.timedelta(days=d), 1, Decimal("10.00")) for d in days],
        "pid bigint, product_name string, category string, sub_category string, brand string, base_price double, "
        "order_date date, sales_count bigint, total_sales_amount decimal(28,2)")


def test_product_gaps_use_rows_not_days(spark):
    days = [1, 2] + list(range(10, 18))
    perf = G.product_performance(_dps(spark, days)).orderBy("order_date").collect()
    assert perf[0].prev_day_sales == 0 and perf[0].prev_day_order_cnt == 0
    assert perf[2].prev_day_sales == Decimal("10.00")              # day 10 follows day 2
    assert [r.last_7_day_sales for r in perf][6:] == [Decimal("70.00")] * 4
    assert perf[3].last_7_day_sales == Decimal("40.00")             # 4 rows, though 11 days apart
    assert {r.overall_sales for r in perf} == {Decimal("100.00")}
    assert [r.rolling_total for r in perf] == [Decimal(10 * i) for i in range(1, 11)]


def test_category_ties_keep_all_and_merge_names(spark):
    lines = spark.createDataFrame([
        (1, 1, Decimal("5.00"), 1, "c", "a"), (2, 2, Decimal("5.00"), 2, "c", "b"),
        (3, 3, Decimal("2.00"), 3, "c", "x"), (4, 4, Decimal("3.00"), 3, "c", "x"),
    ], "order_id bigint, product_id bigint, line_total decimal(12,2), customer_id bigint, category string, product_name string")
    top = rows(G.category_top_product(G.category_product_revenue(lines)), "category", "product_name")
    assert top == [("c", "a"), ("c", "b"), ("c", "x")]             # x: two pids, one name, 5.00
    assert rows(G.category_unique_customers(lines)) == [("c", 3)]


def test_two_commits_same_day_exact_mean(spark):
    o = lambda oid, disc: (oid, D0, Decimal("1.00"), Decimal(disc), Decimal("1.00"))
    schema = "oid bigint, order_date date, total_amount decimal(18,2), discount_applied decimal(12,6), final_amount decimal(18,2)"
    c1 = spark.createDataFrame([o(1, "1"), o(2, "2")], schema)
    c2 = spark.createDataFrame([o(3, "6")], schema)
    state = G.merge_daily_sales(G.merge_daily_sales(None, G.daily_sales_batch(c1)), G.daily_sales_batch(c2))
    r = G.publish_daily_sales(state).first()
    assert r.order_count == 3 and r.total_amount == 3.0
    assert r.avg_discount_per_order == 3.0                          # exact (1+2+6)/3, not mean of means


def test_k_batches_equal_one_batch_for_product_days(spark):
    orders = spark.createDataFrame([(i, D0 + dt.timedelta(days=i % 3), i % 2) for i in range(12)],
                                   "oid bigint, order_date date, commit_version int")
    items = spark.createDataFrame([(i % 12, i % 4, 1 + i % 3, Decimal("2.50")) for i in range(40)],
                                  "order_id bigint, product_id bigint, quantity bigint, gross_amount decimal(12,2)")
    products = spark.createDataFrame([(p, f"p{p}", "c", "s", "b", 1.0) for p in range(4)],
                                     "pid bigint, product_name string, category string, sub_category string, brand string, base_price double")
    one = G.compact_product_days(G.product_day_partials(orders, items, products))
    parts = None
    for v in (0, 1):
        p = G.product_day_partials(orders.filter(F.col("commit_version") == v), items, products)
        parts = p if parts is None else parts.unionByName(p)
    assert rows(G.compact_product_days(parts)) == rows(one)
