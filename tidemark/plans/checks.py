"""Consistency checks and helper relations of the shop data (re-aimed generator queries).

Fixed values: legal status transitions
  pending -> confirmed, pending -> cancelled, confirmed -> shipped, confirmed -> cancelled,
  shipped -> delivered, shipped -> returned, delivered -> returned
(returned and cancelled are terminal).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ordered import lag_within
from tidemark.schemas import MONEY, PCT

# The legal transitions, in the order listed above.
LEGAL_TRANSITIONS = [
    ("pending", "confirmed"), ("pending", "cancelled"),
    ("confirmed", "shipped"), ("confirmed", "cancelled"),
    ("shipped", "delivered"), ("shipped", "returned"),
    ("delivered", "returned"),
]


def orders_without_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders no item points at (anti join on the order id)."""
    ids = items.select(F.col("order_id").alias("_oid"))
    return orders.join(ids, orders["oid"] == ids["_oid"], "left_anti")


def price_list(products: DataFrame) -> DataFrame:
    return products.select("pid", "base_price", "discount_pct").distinct()


def line_pricing(items: DataFrame, prices: DataFrame) -> DataFrame:
    """List-price line total of each item: quantity x base price x (1 - discount_pct/100)."""
    p = prices.select(F.col("pid").alias("product_id"), "base_price", "discount_pct")
    price = F.col("base_price").cast(MONEY)
    pct = F.col("discount_pct").cast(PCT)
    total = F.round(F.col("quantity").cast("decimal(12,0)") * price * (F.lit(100) - pct)
                    * F.lit(0.01).cast("decimal(3,2)"), 2).cast("decimal(18,2)")
    return items.select("order_item_id", "order_id", "product_id", "quantity").join(p, "product_id").select(
        "order_item_id", "order_id", "product_id", "quantity", "base_price", "discount_pct",
        total.alias("list_line_total"))


def product_last_restock(products: DataFrame, inventory: DataFrame) -> DataFrame:
    """Per product: the earliest of COALESCE(restock date, product created date) over its
    inventory rows; the created date when it has none.

    Inventory is reduced to one row per product (earliest date, any missing date) before
    the join, so a product with very many inventory rows is pre-aggregated map-side.
    """
    inv = inventory.groupBy(F.col("product_id").alias("pid")).agg(
        F.min("last_restocked_at").alias("_first"),
        F.max(F.col("last_restocked_at").isNull().cast("int")).alias("_gap"),
    )
    j = products.select("pid", "created_at").join(inv, "pid", "left")
    created = F.col("created_at")
    last = (
        F.when(F.col("_gap").isNull(), created)                      # no inventory row
        .when(F.col("_gap") == 1, F.least(F.coalesce(F.col("_first"), created), created))
        .otherwise(F.col("_first"))
    )
    return j.select("pid", last.alias("last_date"))


def eligible_customers(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """For each order day: how many customers had registered on or before it.

    A running count over the calendar: new registrations per day and the order days are
    put on one day axis (one row per distinct day, so the single ordered window is bounded
    by the calendar, not by the data), summed cumulatively, and read at the order days.
    """
    joins = customers.groupBy(F.col("join_date").alias("day")).agg(F.count(F.lit(1)).alias("_new"))
    days = orders.select(F.col("order_date").cast("date").alias("day")).distinct().withColumn("_is_order", F.lit(1))
    axis = (joins.join(days, "day", "full_outer")
            .fillna({"_new": 0, "_is_order": 0}))
    from pyspark.sql import Window
    w = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return (axis.withColumn("eligible_customers", F.sum("_new").over(w))
            .filter(F.col("_is_order") == 1)
            .select(F.col("day").alias("order_date"), "eligible_customers"))


def legal_transitions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEGAL_TRANSITIONS, "old_status string, new_status string")


def status_transitions(logs: DataFrame) -> DataFrame:
    """Logs with an illegal old→new transition, or a change time not after the previous
    log of the same order (previous by log id). First logs (no old status) are checked
    for time only.

    The previous-log lookup is the skew-safe ordered lag (an order with a huge log is
    spread over several tasks); the legal table has 7 rows and is broadcast.
    """
    return flag_transitions(lag_within(logs.select("log_id", "order_id", "old_status", "new_status", "changed_at"),
                                       ["order_id"], ["log_id"], {"changed_at": "prev_changed_at"}))


def flag_transitions(prev: DataFrame) -> DataFrame:
    """The logs at fault, of logs that carry the change time of the one before (``prev_changed_at``)."""
    legal = F.broadcast(legal_transitions(prev.sparkSession).withColumn("_legal", F.lit(True)))
    flagged = prev.join(legal, ["old_status", "new_status"], "left").select(
        "log_id", "order_id", "old_status", "new_status", "changed_at", "prev_changed_at",
        (F.col("old_status").isNotNull() & F.col("_legal").isNull()).alias("illegal_transition"),
        (F.col("prev_changed_at").isNotNull() & (F.col("changed_at") <= F.col("prev_changed_at"))).alias("not_after_previous"),
    )
    return flagged.filter(F.col("illegal_transition") | F.col("not_after_previous"))


def table_counts(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Row count of each (layer, table), one small aggregate per table, unioned."""
    out = None
    for (layer, name), df in tables.items():
        c = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "rows")
        out = c if out is None else out.unionByName(c)
    return out
