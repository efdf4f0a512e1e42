"""Marts kept commit by commit equal a recomputation over all history, from bounded reads."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.catalog import publish
from tidemark.operators import cuts
from tidemark.plans import gold as G
from tidemark.plans import incremental as I
from tidemark.sources.buckets import Buckets

DAY = dt.date(2026, 7, 1)


# ---- quartile cuts ---------------------------------------------------------------------------


@pytest.mark.parametrize("seed,n", [(1, 500), (2, 3), (3, 1), (4, 64)])
def test_tiles_by_cuts_equal_ntile(spark, seed, n):
    r = random.Random(seed)
    values = [None, Decimal("0.00"), Decimal("9999999999999999.99"), Decimal("-9999999999999999.99")] + [Decimal(r.randint(-50, 50)) / 4 for _ in range(9)]
    df = spark.createDataFrame([(k * (-1) ** k * 10**15, r.choice(values)) for k in range(1, n + 1)], "customer_id bigint, total_order_value decimal(18,2)")
    want = df.withColumn("t", F.ntile(4).over(Window.orderBy(F.col("total_order_value").desc(), "customer_id")))
    got = df.withColumn("t", G.spend_tile(df))
    assert rows(got) == rows(want)
    assert "RangePartitioning" not in got._jdf.queryExecution().executedPlan().toString().replace("rangepartitioning", "RangePartitioning")


def test_cuts_of_an_empty_table(spark):
    df = spark.createDataFrame([], "customer_id bigint, total_order_value decimal(18,2)")
    assert df.withColumn("t", G.spend_tile(df)).count() == 0
    assert cuts.tile_ends(10, 4) == [3, 6, 8] and cuts.tile_ends(2, 4) == [1, 2, 2]


# ---- buckets -----------------------------------------------------------------------------------


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    schema = spark.createDataFrame([], "k bigint, v string").schema
    table = Buckets(spark, str(tmp_path), ("k",), schema, 8)
    both = lambda held, more: held.join(more.select("k"), "k", "left_anti").unionByName(more)
    table.change(0, -1, spark.createDataFrame([(k, "a") for k in range(100)], schema), both)
    table.change(3, 0, spark.createDataFrame([(5, "b"), (500, "c")], schema), both)
    touched = table.touched(spark.createDataFrame([(5, ""), (500, "")], schema))
    files = lambda v: {b: table.read(v, {b}).inputFiles() for b in table.map(v)}
    before, after = files(0), files(3)
    assert 1 <= len(touched) <= 2 and all((before[b] == after[b]) == (b not in touched) for b in after)
    assert rows(table.read(3)) == sorted([(k, "b" if k == 5 else "a") for k in range(100)] + [(500, "c")], key=lambda t: tuple((x is None, str(x)) for x in t))
    assert rows(table.read(0)) == rows(spark.createDataFrame([(k, "a") for k in range(100)], schema))
    table.change(3, 0, spark.createDataFrame([(7, "d")], schema), both)      # a version written again replaces itself
    assert table.read(3).where("v = 'c'").count() == 0 and table.read(3).where("v = 'd'").count() == 1
    table.change(4, 3, spark.createDataFrame([], schema), both)
    assert table.map(4) == table.map(3) and table.read(99).count() == 0
    with pytest.raises(ValueError):
        Buckets(spark, str(tmp_path), ("k",), schema, 4).change(5, 4, spark.createDataFrame([(1, "x")], schema), both)


# ---- product marts --------------------------------------------------------------------------------


def product_days(spark, cells):
    return spark.createDataFrame([(p, f"p{p}", f"c{p % 2}", "s", "b", 1.0, DAY + dt.timedelta(days=d), n, a) for (p, d), (n, a) in sorted(cells.items())], I.PRODUCT_DAYS)


def commits(seed):
    """Product-days that arrive in order, late, and on a day that is already there; one without an amount."""
    r = random.Random(seed)
    out = []
    for v in range(4):
        cells = {}
        for _ in range(25):
            late = r.random() < 0.25
            day = r.randint(0, 9 * v + 8) if late else r.randint(9 * v, 9 * v + 8)
            cells[(r.randint(0, 4 + v), day)] = (r.randint(1, 9), None if r.random() < 0.08 else Decimal(r.randint(0, 9999)) / 100)
        out.append(cells)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_performance_by_suffixes_equals_recomputation(spark, tmp_path, seed):
    table, days, history = Buckets(spark, str(tmp_path), ("pid",), I.PERFORMANCE, 4), None, None
    for v, cells in enumerate(commits(seed)):
        added = product_days(spark, cells)
        if history is not None:  # rows that are framed: from the first changed day on, and six before it
            held = table.read(v - 1)
            first = {}
            for p, d in cells:
                first[p] = min(first.get(p, d), d)
            fed = I.suffix_rows(held, added).groupBy("pid", "_seed").count().collect()
            assert {r["pid"] for r in fed} == set(first) and all(r["count"] <= 6 for r in fed if r["_seed"])
            late = sum(1 for r in history.collect() if r["pid"] in first and r["order_date"] >= DAY + dt.timedelta(days=first[r["pid"]]))
            assert sum(r["count"] for r in fed if not r["_seed"]) <= late + len(cells)
        history = added if history is None else G.compact_product_days(history.unionByName(added))
        table.change(v, v - 1, added, I.product_performance_step)
        assert rows(publish(table.read(v))) == rows(publish(G.product_performance(history)).select(*I.PERFORMANCE.fieldNames())), v


def test_category_states_equal_recomputation(spark, tmp_path):
    r = random.Random(5)
    products = spark.createDataFrame([(p, f"n{p % 5}", f"c{p % 3}", 0) for p in range(8)], "pid bigint, product_name string, category string, commit_version int")
    order_rows, item_rows = [], []
    for v in range(3):
        order_rows += [(100 * v + k, r.randint(0, 6), DAY + dt.timedelta(days=r.randint(0, 5)), v) for k in range(12)]
        # items come with their order, or after it, or before it
        item_rows += [(100 * r.choice([v, v, v, max(0, v - 1), min(2, v + 1)]) + r.randint(0, 11), r.randint(0, 7), Decimal(r.randint(0, 500)) / 4, v) for _ in range(30)]
    orders = spark.createDataFrame(order_rows, "oid bigint, customer_id bigint, order_date date, commit_version int")
    items = spark.createDataFrame(item_rows, "order_id bigint, product_id bigint, line_total decimal(12,2), commit_version int")
    states, days = I.CategoryStates(spark, str(tmp_path / "s"), 4), Buckets(spark, str(tmp_path / "d"), ("pid",), I.PRODUCT_DAYS, 4)
    history = None
    for v, cells in enumerate(commits(9)[:3]):
        cells = {(p % 8, d): x for (p, d), x in cells.items()}
        added = product_days(spark, cells).withColumn("category", F.concat(F.lit("c"), (F.col("pid") % 3).cast("string")))
        upto = lambda df: df.where(F.col("commit_version") <= v)  # noqa: E731, B023
        states.step(v, v - 1, I.new_lines(upto(orders), upto(items), products, v, v), I.product_day_changes(days.read(v - 1), added))
        days.change(v, v - 1, added, I.add_product_days)
        history = added if history is None else G.compact_product_days(history.unionByName(added))
        want = G.category_trends(history, upto(orders), upto(items), products)
        assert rows(publish(states.publish(v))) == rows(publish(want)), v


def test_customer_step_equals_the_step_over_history(spark):
    r = random.Random(3)
    rows_ = [(k, r.randint(0, 9), DAY + dt.timedelta(days=r.randint(0, 30)), Decimal(r.randint(0, 9999)) / 100, k % 3) for k in range(90)]
    orders = spark.createDataFrame(rows_, "oid bigint, customer_id bigint, order_date date, final_amount decimal(18,2), v int")
    customers = spark.createDataFrame([(c, f"n{c}", None, "x", "y", DAY) for c in range(8)], "customer_id bigint, name string, email string, city string, country string, join_date date")
    whole = step = None
    for v in range(3):
        as_of = F.lit(f"2026-08-0{v + 1}").cast("timestamp")
        batch, upto = orders.where(f"v = {v}").drop("v"), orders.where(f"v <= {v}").drop("v")
        whole = G.customer_360(whole, upto, batch, customers, as_of)
        step = G.customer_360_step(step, batch, customers, as_of)
        assert rows(step) == rows(whole)
