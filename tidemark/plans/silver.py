"""Cleaning layer: one pure function per entity, ``(batch, silver_before, refs) -> Cleaned``.

``silver_before`` is the silver table as of the commit *before* this batch (pinned by
commit version), for both the accepted and the quarantine plan, so a replay of the same
commit gives the same output.

Fixed values (null repair defaults, must match the published tables):
  products          product_name, category, sub_category, brand, supplier -> 'N/A'
  orders            order_status, payment_method, shipping_address -> 'Unknown'
  inventory         warehouse_location -> 'N/A'
  order_status_log  old_status, new_status, changed_by -> 'Unknown'; remarks -> 'N/A'
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import half_up_mean
from tidemark.operators.cleaning import dedup_by_key, dedup_rows
from tidemark.operators.routing import MAIN, QUARANTINE, TAGS, fill_main, flag_known, reject_by_key, route
from tidemark.schemas import MEAN, MONEY, ORDER_ITEMS

# Null repair defaults.
PRODUCT_DEFAULTS = {"product_name": "N/A", "category": "N/A", "sub_category": "N/A", "brand": "N/A", "supplier": "N/A"}
ORDER_DEFAULTS = {"order_status": "Unknown", "payment_method": "Unknown", "shipping_address": "Unknown"}
INVENTORY_DEFAULTS = {"warehouse_location": "N/A"}
LOG_DEFAULTS = {"old_status": "Unknown", "new_status": "Unknown", "changed_by": "Unknown", "remarks": "N/A"}

CUSTOMER_COLS = ["customer_id", "name", "email", "city", "country", "join_date"]
PRODUCT_COLS = ["pid", "product_name", "category", "sub_category", "brand", "base_price", "discount_pct",
                "current_stock", "supplier", "created_at"]
ITEM_COLS = [f.name for f in ORDER_ITEMS.fields]
ORDER_COLS = ["oid", "customer_id", "order_date", "order_status", "payment_method", "shipping_address",
              "total_amount", "discount_applied", "final_amount"]
AMOUNTS = ["total_amount", "discount_applied", "final_amount"]
INVENTORY_COLS = ["inventory_id", "product_id", "warehouse_location", "quantity_on_hand", "reorder_threshold",
                  "last_restocked_at"]
LOG_COLS = ["log_id", "order_id", "old_status", "new_status", "changed_at", "changed_by", "remarks"]


LAYER = "silver"


@dataclass
class Cleaned:
    """A step's rows with their ``sink``, ``reason`` and ``layer``; the two sinks are filters over it.

    ``written``: the rows come from a table that the step wrote, so reading them again costs a scan."""

    routed: DataFrame
    written: bool = False

    def of(self, sink: str) -> DataFrame:
        return self.routed.where(F.col("sink") == sink).drop(*TAGS)

    @property
    def accepted(self) -> DataFrame:
        return self.of(MAIN)

    @property
    def quarantined(self) -> DataFrame:
        return self.of(QUARANTINE)


CV = "commit_version"


def _keep(df: DataFrame, cols: list[str]) -> list[str]:
    """The entity columns plus ``commit_version`` when the batch carries it."""
    return cols + ([CV] if CV in df.columns else [])


def _dedup_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """Exact duplicates dropped; a row landed in several commits keeps the earliest."""
    if CV not in df.columns:
        return dedup_rows(df.select(*cols))
    return df.groupBy(*cols).agg(F.min(CV).alias(CV))


def silver_customers(batch: DataFrame, silver_before: DataFrame | None) -> Cleaned:
    """One survivor per customer_id, then only ids not yet in silver; repeats quarantined."""
    cols = _keep(batch, CUSTOMER_COLS)
    users = dedup_by_key(batch.select(*cols), ["customer_id"], first=[CV] if CV in cols else [])
    users = flag_known(users, "customer_id", silver_before, "customer_id", "_seen")
    routed = route(users, LAYER, [(MAIN, None, ~F.col("_seen")), (QUARANTINE, "already_loaded", F.col("_seen"))])
    return Cleaned(routed.select(*cols, *TAGS))


def product_ranges_ok() -> F.Column:
    return (F.col("base_price") > 0) & (F.col("current_stock") >= 0)


def silver_products(batch: DataFrame, silver_before: DataFrame | None) -> Cleaned:
    """Exact duplicates dropped; new pids repaired and range-checked (failures dropped); repeats quarantined as they came."""
    cols = _keep(batch, PRODUCT_COLS)
    prods = flag_known(_dedup_rows(batch, PRODUCT_COLS), "pid", silver_before, "pid", "_seen")
    routed = route(prods, LAYER, [(MAIN, None, ~F.col("_seen") & product_ranges_ok()), (QUARANTINE, "already_loaded", F.col("_seen"))])
    return Cleaned(fill_main(routed, PRODUCT_DEFAULTS).select(*cols, *TAGS))


def item_accept() -> F.Column:
    return (F.col("quantity") > 0) | (F.col("unit_price_at_order") > 0) | (F.col("discount_at_order") >= 0)


def item_reject() -> F.Column:
    return (F.col("quantity") <= 0) | (F.col("unit_price_at_order") <= 0) | (F.col("discount_at_order") < 0)


def with_gross(items: DataFrame) -> DataFrame:
    """``gross_amount`` is unit price x quantity, whatever the source carried."""
    return items.withColumn("gross_amount", (F.col("unit_price_at_order") * F.col("quantity")).cast(MONEY))


def silver_order_items(batch: DataFrame, silver_before: DataFrame | None, products: DataFrame) -> Cleaned:
    """Known product and any plausible number → accepted; orphan or any bad number → quarantine.

    The two predicates overlap on purpose (a row with quantity 0 but a positive price is
    both accepted and quarantined); already-loaded ids are quarantined as repeats.
    """
    cols = _keep(batch, ITEM_COLS)
    items = flag_known(with_gross(batch).select(*cols), "product_id", products, "pid", "_known")
    items = flag_known(items, "order_item_id", silver_before, "order_item_id", "_seen")
    valid = F.col("_known") & F.coalesce(item_accept(), F.lit(False))
    routed = route(items, LAYER, [
        (MAIN, None, valid & ~F.col("_seen")),
        (QUARANTINE, F.when(F.col("_known"), "bad_number").otherwise("unknown_product"), ~F.col("_known") | item_reject()),
        (QUARANTINE, "already_loaded", valid & F.col("_seen")),
    ])
    return Cleaned(routed.select(*cols, *TAGS))


def order_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Per order: gross total, mean item discount, net total (items aggregated first).

    Items are reduced to one row per order (map-side partial aggregation) before they
    meet the orders, so the join shuffles one row per order, not one per item.
    """
    ids = orders.select(F.col("oid").alias("_oid"))
    mine = items.join(ids, items["order_id"] == ids["_oid"], "left_semi")
    return mine.groupBy(F.col("order_id").alias("oid")).agg(
        F.sum("gross_amount").cast("decimal(18,2)").alias("total_amount"),
        half_up_mean(F.sum("discount_at_order"), F.count("discount_at_order"), 6, 2)
        .cast(MEAN).alias("discount_applied"),
        F.sum("line_total").cast("decimal(18,2)").alias("final_amount"),
    )


def silver_orders(batch: DataFrame, silver_before: DataFrame | None, customers: DataFrame,
                  items: DataFrame) -> Cleaned:
    """Known customer, repaired, amounts recomputed from silver items; an order without
    items is rejected; ids already in silver are dropped; rejects = batch − accepted."""
    cols = _keep(batch, ORDER_COLS)
    orders = _dedup_rows(batch, ORDER_COLS).withColumn("order_date", F.col("order_date").cast("date"))
    totals = order_totals(orders, items).select(F.col("oid").alias("_oid"), *[F.col(c).alias(f"_{c}") for c in AMOUNTS])
    orders = flag_known(orders, "customer_id", customers, "customer_id", "_known")
    orders = flag_known(orders, "oid", silver_before, "oid", "_seen")
    orders = orders.join(totals, orders["oid"] == totals["_oid"], "left")
    has_items = F.col("_oid").isNotNull()
    ok = F.col("_known") & has_items & ~F.col("_seen")
    tagged = orders.withColumn("_ok", ok).select(
        *[c for c in cols if c not in AMOUNTS],
        *[F.when(F.col("_ok"), F.col(f"_{c}")).otherwise(F.col(c).cast(totals.schema[f"_{c}"].dataType)).alias(c) for c in AMOUNTS],
        "_ok", first_reason((~F.col("_known"), "unknown_customer"), (~has_items, "no_items"), (F.col("_seen"), "already_loaded")))
    routed = reject_by_key(tagged, ["oid"], LAYER, "tagged-orders")
    return Cleaned(fill_main(routed, ORDER_DEFAULTS).select(*cols, *TAGS), written=True)


def first_reason(*reasons: tuple[Column, str]) -> Column:
    """The first reason that holds, as column ``reason``."""
    return F.coalesce(*[F.when(when, why) for when, why in reasons]).alias("reason")


def _key_checked(batch: DataFrame, silver_before: DataFrame | None, key: str, ref: DataFrame, on: str, ref_key: str, cols: list[str], unknown: str,
                 ranges: Column | None = None) -> DataFrame:
    """Rows with ``_ok`` and ``reason``: reference known, numbers in range, key not yet in silver."""
    rows = flag_known(batch.select(*cols), on, ref, ref_key, "_known")
    rows = flag_known(rows, key, silver_before, key, "_seen")
    fit = F.lit(True) if ranges is None else F.coalesce(ranges, F.lit(False))
    return rows.select(*cols, (F.col("_known") & fit & ~F.col("_seen")).alias("_ok"),
                       first_reason((~F.col("_known"), unknown), (~fit, "bad_number"), (F.col("_seen"), "already_loaded")))


def silver_inventory(batch: DataFrame, silver_before: DataFrame | None, products: DataFrame) -> Cleaned:
    """Known product, no negative number, id not yet in silver; rejects = batch minus accepted ids."""
    cols = _keep(batch, INVENTORY_COLS)
    ranges = (F.col("quantity_on_hand") >= 0) & (F.col("reorder_threshold") >= 0)
    dated = batch.withColumn("last_restocked_at", F.col("last_restocked_at").cast("date"))
    tagged = _key_checked(dated, silver_before, "inventory_id", products, "product_id", "pid", cols, "unknown_product", ranges)
    routed = reject_by_key(tagged, ["inventory_id"], LAYER, "tagged-inventory")
    return Cleaned(fill_main(routed, INVENTORY_DEFAULTS).select(*cols, *TAGS), written=True)


def silver_order_status_log(batch: DataFrame, silver_before: DataFrame | None, orders: DataFrame) -> Cleaned:
    """Known order, id not yet in silver; rejects = batch minus accepted ids."""
    cols = _keep(batch, LOG_COLS)
    timed = batch.withColumn("changed_at", F.col("changed_at").cast("timestamp"))
    tagged = _key_checked(timed, silver_before, "log_id", orders, "order_id", "oid", cols, "unknown_order")
    routed = reject_by_key(tagged, ["log_id"], LAYER, "tagged-logs")
    return Cleaned(fill_main(routed, LOG_DEFAULTS).select(*cols, *TAGS), written=True)
