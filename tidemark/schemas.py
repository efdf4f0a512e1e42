"""Declared schemas of the six shop entities and the five marts.

Landing JSON is always read with these schemas: inference would cost an extra pass and
breaks on empty or all-null input.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)        # prices, line totals
PCT = T.DecimalType(5, 2)           # discount percentages
MEAN = T.DecimalType(12, 6)         # stored means (discount_applied), half up at 6 places

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("join_date", T.DateType()),
])

PRODUCTS = T.StructType([
    T.StructField("pid", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("sub_category", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("base_price", T.DoubleType()),
    T.StructField("discount_pct", T.DoubleType()),
    T.StructField("current_stock", T.LongType()),
    T.StructField("supplier", T.StringType()),
    T.StructField("created_at", T.DateType()),
])

ORDERS = T.StructType([
    T.StructField("oid", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("order_status", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("shipping_address", T.StringType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("discount_applied", T.DoubleType()),
    T.StructField("final_amount", T.DoubleType()),
])

# ``gross_amount`` = unit_price_at_order * quantity: what order totals and product sales add up.
ORDER_ITEMS = T.StructType([
    T.StructField("order_item_id", T.LongType()),
    T.StructField("order_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("unit_price_at_order", MONEY),
    T.StructField("discount_at_order", PCT),
    T.StructField("line_total", MONEY),
    T.StructField("gross_amount", MONEY),
])

INVENTORY = T.StructType([
    T.StructField("inventory_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("warehouse_location", T.StringType()),
    T.StructField("quantity_on_hand", T.LongType()),
    T.StructField("reorder_threshold", T.LongType()),
    T.StructField("last_restocked_at", T.DateType()),
])

ORDER_STATUS_LOG = T.StructType([
    T.StructField("log_id", T.LongType()),
    T.StructField("order_id", T.LongType()),
    T.StructField("old_status", T.StringType()),
    T.StructField("new_status", T.StringType()),
    T.StructField("changed_at", T.TimestampType()),
    T.StructField("changed_by", T.StringType()),
    T.StructField("remarks", T.StringType()),
])

ENTITIES = {
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "inventory": INVENTORY,
    "order_status_log": ORDER_STATUS_LOG,
}

# Primary keys (a composite key is a tuple of columns).
KEYS = {
    "customers": ("customer_id",),
    "products": ("pid",),
    "orders": ("oid",),
    "order_items": ("order_item_id",),
    "inventory": ("inventory_id",),
    "order_status_log": ("log_id",),
}

COMMIT_COL = "commit_version"
#: Column of the text that a JSON reader could not parse.
CORRUPT = "_corrupt_record"

# Gold mart columns, in published order.
CUSTOMER_360_COLS = [
    "customer_id", "name", "email", "city", "country", "join_date", "total_order_value",
    "total_orders", "customer_tier", "last_order_date", "churn_risk_score", "updated_at",
]
DAILY_SALES_COLS = ["order_date", "order_count", "total_amount", "avg_discount_per_order", "net_revenue"]
DAILY_PRODUCT_SALES_KEYS = ["pid", "product_name", "category", "sub_category", "brand", "base_price", "order_date"]
DAILY_PRODUCT_SALES_COLS = DAILY_PRODUCT_SALES_KEYS + ["sales_count", "total_sales_amount"]
PRODUCT_PERFORMANCE_COLS = DAILY_PRODUCT_SALES_COLS + [
    "prev_day_sales", "prev_day_order_cnt", "last_7_day_sales", "overall_sales", "rolling_total",
]
CATEGORY_TRENDS_COLS = [
    "category", "date", "daily_revenue", "daily_orders", "unique_customers", "top_product", "top_product_revenue",
]
