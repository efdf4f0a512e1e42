"""

    python tests/measure_baseline.py [sf_dir] [cores]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def timed(fn, runs=3):
    out = []
    for _ in range(runs):
        t0 = time.time()
        fn()
        out.append(time.time() - t0)
    return round(statistics.median(out), 3)


def exchanges(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum(1 for line in plan.split("\n") if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line
               or "Exchange SinglePartition" in line)


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cores = sys.argv[2] if len(sys.argv) > 2 else "8"
    from tidemark.operators.cleaning import new_rows_anti
    from tidemark.operators.ranking import distributed_ntile
    from tidemark.plans import flow
    from tidemark.plans import gold as G
    from tidemark.session import local_session
    from tidemark.sources import lake as L

    spark = local_session(cores=cores, shuffle_partitions=16)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="measure-ckpt-"))
    out = {"sf": sf, "cores": cores}
    lake = flow.fresh_lake(spark, sf)
    items = lake.silver("order_items").drop("commit_version")
    orders = lake.silver("orders").drop("commit_version")

    # distributed rank vs single-partition window ntile (all items by line total)
    order = [F.col("line_total").desc(), F.col("order_item_id"), F.col("order_id"), F.col("product_id"),
             F.col("quantity"), F.col("unit_price_at_order"), F.col("discount_at_order"), F.col("gross_amount")]
    dist = distributed_ntile(items, order, 4, "t")
    single = items.withColumn("t", F.ntile(4).over(Window.orderBy(*order)))
    out["ntile_distributed_s"] = timed(lambda: noop(dist))
    out["ntile_single_partition_s"] = timed(lambda: noop(single))
    out["ntile_single_partition_tasks_in_window_stage"] = 1

    # shrink-then-anti vs plain anti: a 1% batch against all silver items
    batch = items.sample(fraction=0.01, seed=7).persist()
    n = batch.count()
    shrink = new_rows_anti(batch, items, ["order_item_id"])
    plain = batch.join(items.select("order_item_id"), "order_item_id", "left_anti")
    out["anti_batch_rows"] = n
    out["anti_shrink_s"] = timed(lambda: noop(shrink))
    out["anti_plain_s"] = timed(lambda: noop(plain))
    out["anti_shrink_shuffles"] = exchanges(shrink)
    out["anti_plain_shuffles"] = exchanges(plain)

    # incremental commit vs full recompute, 10 commits split by order date
    root = tempfile.mkdtemp(prefix="measure-")
    deciles = orders.withColumn("c", F.ntile(10).over(Window.orderBy("order_date", "oid"))).persist()
    deciles.count()
    state_root = f"{root}/dss"
    parts_path = f"{root}/dps_parts"
    products = lake.silver("products")
    t_inc_dss, t_inc_dps = [], []
    for v in range(1, 11):
        batch_o = deciles.filter(F.col("c") == v).drop("c")
        t0 = time.time()
        prev = L.read_snapshot(spark, state_root, v - 1)
        L.write_snapshot(G.merge_daily_sales(prev, G.daily_sales_batch(batch_o)), state_root, v)
        t_inc_dss.append(time.time() - t0)
        t0 = time.time()
        parts = G.product_day_partials(batch_o, items, products)
        L.commit_append(parts, parts_path, v)
        noop(G.compact_product_days(L.read_table(spark, parts_path, parts.schema).drop("commit_version")))
        t_inc_dps.append(time.time() - t0)
    out["daily_sales_incremental_commit_s"] = round(statistics.median(t_inc_dss), 3)
    out["daily_sales_full_recompute_s"] = timed(lambda: noop(G.daily_sales_batch(orders)))
    out["daily_product_sales_incremental_commit_s"] = round(statistics.median(t_inc_dps), 3)
    out["daily_product_sales_full_recompute_s"] = timed(
        lambda: noop(G.product_day_partials(orders, items, products)))
    customers = lake.silver("customers")
    last = deciles.filter(F.col("c") == 10).drop("c")
    mart9 = G.customer_360(None, deciles.filter(F.col("c") <= 9).drop("c"), deciles.filter(F.col("c") <= 9).drop("c"),
                           customers, flow.as_of_col())
    L.write_snapshot(mart9, f"{root}/c360", 9)
    prev = L.read_snapshot(spark, f"{root}/c360", 9)
    out["customer_360_incremental_commit_s"] = timed(
        lambda: noop(G.customer_360(prev, orders, last, customers, flow.as_of_col())))
    out["customer_360_full_recompute_s"] = timed(
        lambda: noop(G.customer_360(None, orders, orders, customers, flow.as_of_col())))
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
