"""The five marts as pure DataFrame functions.

Mart state is kept mergeable where the mart is incremental: the daily sales state stores
sums and counts (never a mean of means), the product-day state stores sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.caching import persist
from tidemark.functions.labels import churn_label, tier_label
from tidemark.functions.money import half_up_mean
from tidemark.operators.cuts import LOW, descending, ntile_cuts, tile_of
from tidemark.operators.merge import merge_upsert
from tidemark.schemas import CUSTOMER_360_COLS, DAILY_PRODUCT_SALES_KEYS

PLACEHOLDER = "None"  # tier / churn before scoring (fixed value)
TIERS = 4
MEAN_SCALE = 6        # published discount means: half-up, 6 decimals

# ---------------------------------------------------------------------------------------
# customer_360


def customer_aggregates(orders: DataFrame) -> DataFrame:
    """Per customer: total spend, order count, last order date."""
    return orders.groupBy("customer_id").agg(
        F.sum("final_amount").cast("decimal(18,2)").alias("total_order_value"),
        F.count("oid").alias("total_orders"),
        F.max("order_date").alias("last_order_date"),
    )


def affected_customers(silver_orders: DataFrame, batch_orders: DataFrame) -> DataFrame:
    """Full order history of the customers that appear in this batch (semi join)."""
    keys = batch_orders.select(F.col("customer_id").alias("_cid")).dropDuplicates()
    return silver_orders.join(keys, silver_orders["customer_id"] == keys["_cid"], "left_semi")


def customer_360_updates(silver_orders: DataFrame, batch_orders: DataFrame, customers: DataFrame,
                         as_of: Column) -> DataFrame:
    """Source rows of the upsert: recomputed aggregates of affected customers + attributes."""
    agg = customer_aggregates(affected_customers(silver_orders, batch_orders))
    return _with_attributes(agg, customers, as_of)


def customer_360_changes(mart: DataFrame | None, batch_orders: DataFrame, customers: DataFrame, as_of: Column) -> DataFrame:
    """Source rows of the upsert from the mart's own totals and the batch: sums, counts and the last date are mergeable, so
    the affected customers' order history is not read. Equal to :func:`customer_360_updates` when the mart holds all orders before the batch."""
    agg = customer_aggregates(batch_orders)
    if mart is not None:
        held = mart.select(F.col("customer_id").alias("_cid"), F.col("total_order_value").alias("_value"), F.col("total_orders").alias("_orders"), F.col("last_order_date").alias("_last"))
        agg = agg.join(held, agg["customer_id"] == held["_cid"], "left").select(
            "customer_id",
            F.coalesce((F.col("_value") + F.col("total_order_value")).cast("decimal(18,2)"), "_value", "total_order_value").alias("total_order_value"),
            (F.coalesce("_orders", F.lit(0)) + F.col("total_orders")).alias("total_orders"), F.greatest("_last", "last_order_date").alias("last_order_date"))
    return _with_attributes(agg, customers, as_of)


def _with_attributes(agg: DataFrame, customers: DataFrame, as_of: Column) -> DataFrame:
    attrs = customers.select("customer_id", "name", "email", "city", "country", "join_date")
    return (
        agg.join(attrs, "customer_id", "left")
        .withColumn("customer_tier", F.lit(PLACEHOLDER))
        .withColumn("churn_risk_score", F.lit(PLACEHOLDER))
        .withColumn("updated_at", as_of.cast("timestamp"))
        .select(*CUSTOMER_360_COLS)
        .dropDuplicates()
    )


def spend_order() -> tuple[Column, Column]:
    """Customers by spend, biggest first, ties by id: as whole numbers."""
    return descending(F.col("total_order_value"), 2), F.coalesce("customer_id", F.lit(LOW))


def spend_tile(mart: DataFrame) -> Column:
    """Quartile of spend over all rows of ``mart``: compared with the three cut rows, which counting finds (no sort)."""
    number, key = spend_order()
    return tile_of(number, key, ntile_cuts(mart.select("total_order_value", "customer_id"), number, key, TIERS))


def score_customers(mart: DataFrame) -> DataFrame:
    """Tier = quartile of spend over the whole mart (ties by customer_id); churn from the
    gap between each row's own ``updated_at`` and its last order."""
    mart = persist(mart)  # read by the rounds that find the cuts, and once more
    return (
        mart.withColumn("customer_tier", tier_label(spend_tile(mart)))
        .withColumn("churn_risk_score", churn_label(F.col("updated_at"), F.col("last_order_date")))
        .select(*CUSTOMER_360_COLS)
    )


UPSERT_COLS = ["total_order_value", "total_orders", "customer_tier", "last_order_date", "churn_risk_score", "updated_at"]


def customer_360(mart: DataFrame | None, silver_orders: DataFrame, batch_orders: DataFrame,
                 customers: DataFrame, as_of: Column) -> DataFrame:
    """One incremental step: upsert the affected customers, then re-score the whole mart.

    The second MERGE of the original (tier + churn for every matched row) touches every
    row, so it is folded into the same snapshot as a projection.
    """
    return upsert_and_score(mart, customer_360_updates(silver_orders, batch_orders, customers, as_of), as_of)


def customer_360_step(mart: DataFrame | None, batch_orders: DataFrame, customers: DataFrame, as_of: Column) -> DataFrame:
    """The same step without order history: the mart holds what came before the batch."""
    return upsert_and_score(mart, customer_360_changes(mart, batch_orders, customers, as_of), as_of)


def upsert_and_score(mart: DataFrame | None, updates: DataFrame, as_of: Column) -> DataFrame:
    merged = updates if mart is None else merge_upsert(
        mart, updates, ["customer_id"], UPSERT_COLS, {"updated_at": as_of.cast("timestamp")})
    return score_customers(merged)


# ---------------------------------------------------------------------------------------
# daily_sales_summary

DAILY_STATE_COLS = ["order_date", "order_count", "total_amount", "discount_sum", "discount_n", "net_revenue"]


def daily_sales_batch(orders: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Mergeable per-day partials of a batch of orders (optionally per commit too)."""
    return orders.groupBy(*by, F.col("order_date").cast("date").alias("order_date")).agg(
        F.count("oid").alias("order_count"),
        F.sum("total_amount").cast("decimal(28,2)").alias("total_amount"),
        F.sum("discount_applied").cast("decimal(28,6)").alias("discount_sum"),
        F.count("discount_applied").alias("discount_n"),
        F.sum("final_amount").cast("decimal(28,2)").alias("net_revenue"),
    )


def merge_daily_sales(state: DataFrame | None, batch_partials: DataFrame) -> DataFrame:
    """Re-aggregate stored state ∪ new partials (a re-arriving date is merged exactly)."""
    both = batch_partials if state is None else state.select(*DAILY_STATE_COLS).unionByName(
        batch_partials.select(*DAILY_STATE_COLS))
    return both.groupBy("order_date").agg(
        F.sum("order_count").alias("order_count"),
        F.sum("total_amount").cast("decimal(28,2)").alias("total_amount"),
        F.sum("discount_sum").cast("decimal(28,6)").alias("discount_sum"),
        F.sum("discount_n").alias("discount_n"),
        F.sum("net_revenue").cast("decimal(28,2)").alias("net_revenue"),
    )


def publish_daily_sales(state: DataFrame) -> DataFrame:
    return state.select(
        "order_date",
        "order_count",
        F.col("total_amount").cast("double").alias("total_amount"),
        half_up_mean(F.col("discount_sum"), F.col("discount_n"), MEAN_SCALE, MEAN_SCALE).cast("double").alias("avg_discount_per_order"),
        F.col("net_revenue").cast("double").alias("net_revenue"),
    )


# ---------------------------------------------------------------------------------------
# daily_product_sales


def product_day_partials(orders: DataFrame, items: DataFrame, products: DataFrame,
                         by: tuple[str, ...] = ()) -> DataFrame:
    """Per (product, day): units and gross sales (optionally per commit of the order too).

    Items meet their order's date first and are aggregated per (product_id, day) before the
    product attributes are attached, so the product join runs on product-days, not items.
    """
    dated = items.select("order_id", "product_id", "quantity", "gross_amount").join(
        orders.select(F.col("oid").alias("order_id"), "order_date", *by), "order_id")
    per_day = dated.groupBy(*by, "product_id", "order_date").agg(
        F.sum("quantity").alias("sales_count"),
        F.sum("gross_amount").cast("decimal(28,2)").alias("total_sales_amount"),
    )
    attrs = products.select("pid", "product_name", "category", "sub_category", "brand", "base_price")
    return per_day.join(attrs, per_day["product_id"] == attrs["pid"]).select(
        *by, *DAILY_PRODUCT_SALES_KEYS, "sales_count", "total_sales_amount")


def compact_product_days(partials: DataFrame) -> DataFrame:
    """Re-aggregate appended partials of several commits into one row per product-day."""
    return partials.groupBy(*DAILY_PRODUCT_SALES_KEYS).agg(
        F.sum("sales_count").alias("sales_count"),
        F.round(F.sum("total_sales_amount"), 2).cast("decimal(28,2)").alias("total_sales_amount"),
    )


# ---------------------------------------------------------------------------------------
# product_performance


def product_performance(dps: DataFrame) -> DataFrame:
    """Previous sale day, 7-row moving sum, product total and running total per product.

    One sort per product serves all five frames. Rows per product are bounded by the
    number of calendar days with a sale, so a product never outgrows one task.
    """
    w = Window.partitionBy("pid").orderBy("order_date")
    amt = F.col("total_sales_amount").cast("decimal(28,2)")
    return dps.select(
        "*",
        F.lag("total_sales_amount", 1, 0).over(w).alias("prev_day_sales"),
        F.lag("sales_count", 1, 0).over(w).alias("prev_day_order_cnt"),
        F.round(F.sum(amt).over(w.rowsBetween(-6, 0)), 2).alias("last_7_day_sales"),
        F.round(F.sum(amt).over(Window.partitionBy("pid")), 2).alias("overall_sales"),
        F.round(F.sum(amt).over(w.rowsBetween(Window.unboundedPreceding, 0)), 2).alias("rolling_total"),
    )


# ---------------------------------------------------------------------------------------
# category_trends


def category_daily_means(dps: DataFrame) -> DataFrame:
    """Per category: latest sale day, mean revenue and mean units per product-day."""
    return dps.groupBy("category").agg(
        F.max("order_date").alias("date"),
        half_up_mean(F.sum(F.col("total_sales_amount").cast("decimal(28,2)")),
                     F.count("total_sales_amount"), 2, 2).alias("daily_revenue"),
        half_up_mean(F.sum("sales_count"), F.count("sales_count"), 0, 0).alias("daily_orders"),
    )


def sales_lines(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """order ⋈ item ⋈ product, narrowed to what the category trends need."""
    o = orders.select(F.col("oid").alias("order_id"), "customer_id")
    p = products.select(F.col("pid").alias("product_id"), "category", "product_name")
    return items.select("order_id", "product_id", "line_total").join(o, "order_id").join(p, "product_id")


def category_product_revenue(lines: DataFrame) -> DataFrame:
    return lines.groupBy("category", "product_name").agg(
        F.round(F.sum("line_total"), 2).cast("decimal(28,2)").alias("top_product_revenue"))


def category_top_product(revenue: DataFrame) -> DataFrame:
    """All products tied at the top revenue of their category (dense_rank = 1).

    Computed as max per category joined back on (category, max), two partial-aggregating
    steps instead of one window that would put a whole category into one task.
    """
    best = revenue.groupBy("category").agg(F.max("top_product_revenue").alias("_best"))
    return revenue.join(best, (revenue["category"] == best["category"])
                        & (revenue["top_product_revenue"] == best["_best"]), "left_semi")


def category_unique_customers(lines: DataFrame) -> DataFrame:
    return lines.groupBy("category").agg(F.count_distinct("customer_id").alias("unique_customers"))


def category_customer_revenue(lines: DataFrame) -> DataFrame:
    """One pass over the big order ⋈ item ⋈ product join: revenue per (category,
    product_name, customer). Both the product revenue and the distinct-customer count
    derive from this (smaller) set, so the join is computed once, not once per consumer."""
    return lines.groupBy("category", "product_name", "customer_id").agg(F.sum("line_total").alias("line_total"))


def category_trends(dps: DataFrame, orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    means = category_daily_means(dps)
    per_customer = persist(category_customer_revenue(sales_lines(orders, items, products)))
    top = category_top_product(category_product_revenue(per_customer))
    uniq = category_unique_customers(per_customer)
    return (
        means.join(top, "category").join(uniq, "category")
        .select("category", "date", "daily_revenue", "daily_orders", "unique_customers",
                F.col("product_name").alias("top_product"), "top_product_revenue")
    )
