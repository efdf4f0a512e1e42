"""Paged extracts of the shop tables (the queries behind the paged HTTP reads).

Instead of one ``ORDER BY key LIMIT n OFFSET (p-1)*n`` query per page (each scanning from
the start), every row gets its page number in one distributed pass; a single page is a
filter on that column. Pages are ordered by the primary key with all remaining columns
as tie-break, so a page's content is deterministic even where the key repeats.

Fixed values: default page sizes 500 (customers, products, inventory) and 1000 (orders,
order items, status log).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import as_date
from tidemark.operators.page_index import PageIndex
from tidemark.operators.ranking import assign_pages

PAGE_LIMITS = {"customers": 500, "products": 500, "inventory": 500,
               "orders": 1000, "order_items": 1000, "order_status_log": 1000}
PRIMARY_KEYS = {"customers": "customer_id", "products": "pid", "orders": "oid",
                "order_items": "order_item_id", "inventory": "inventory_id", "order_status_log": "log_id"}

Day = str | _dt.date | None


def page_order(df: DataFrame, key: str) -> list[Column]:
    return [F.col(key).asc_nulls_first()] + [F.col(c).asc_nulls_first() for c in df.columns if c != key]


def paged(df: DataFrame, name: str, limit: int | None = None) -> DataFrame:
    return assign_pages(df, page_order(df, PRIMARY_KEYS[name]), limit or PAGE_LIMITS[name])


def page(df_with_pages: DataFrame, number: int) -> DataFrame:
    """One page (1-based) of a paged listing."""
    return df_with_pages.filter(F.col("page") == number)


def page_customers(customers: DataFrame, on_date: Day = None, limit: int = 500) -> DataFrame:
    df = customers if on_date is None else customers.filter(F.col("join_date") == as_date(on_date))
    return paged(df, "customers", limit)


def page_products(products: DataFrame, on_date: Day = None, limit: int = 500) -> DataFrame:
    df = products if on_date is None else products.filter(F.col("created_at") == as_date(on_date))
    return paged(df, "products", limit)


def orders_between(orders: DataFrame, from_date: Day = None, to_date: Day = None) -> DataFrame:
    """The four bound cases: none, upper only, lower only, both inclusive; from > to → empty."""
    day = F.col("order_date").cast("date")
    if from_date is not None and to_date is not None and str(from_date)[:10] > str(to_date)[:10]:
        return orders.limit(0)
    if from_date is not None:
        orders = orders.filter(day >= as_date(from_date))
    if to_date is not None:
        orders = orders.filter(day <= as_date(to_date))
    return orders


def page_orders(orders: DataFrame, from_date: Day = None, to_date: Day = None, limit: int = 1000) -> DataFrame:
    return paged(orders_between(orders, from_date, to_date), "orders", limit)


def _of_orders_on(child: DataFrame, orders: DataFrame, on_date: Day) -> DataFrame:
    """Child rows whose parent order is dated ``on_date`` (the left join + filter on the
    right side of the original is an inner join; written as a semi join on the keys)."""
    if on_date is None:
        return child
    ids = orders.filter(F.col("order_date").cast("date") == as_date(on_date)).select(F.col("oid").alias("_oid"))
    return child.join(ids, child["order_id"] == ids["_oid"], "left_semi")


def page_order_items(items: DataFrame, orders: DataFrame, on_date: Day = None, limit: int = 1000) -> DataFrame:
    return paged(_of_orders_on(items, orders, on_date), "order_items", limit)


def page_order_status_log(logs: DataFrame, orders: DataFrame, on_date: Day = None, limit: int = 1000) -> DataFrame:
    return paged(_of_orders_on(logs, orders, on_date), "order_status_log", limit)


def page_inventory(inventory: DataFrame, on_date: Day = None, limit: int = 500) -> DataFrame:
    df = inventory if on_date is None else inventory.filter(F.col("last_restocked_at") == as_date(on_date))
    return paged(df, "inventory", limit)


def page_counts(df: DataFrame, name: str, limit: int | None = None) -> DataFrame:
    """COUNT(key) and ceil(count / limit) of one listing (one aggregate row)."""
    limit = limit or PAGE_LIMITS[name]
    key = PRIMARY_KEYS[name]
    return df.agg(F.count(key).alias("rows")).select(
        F.lit(name).alias("table_name"), "rows", F.lit(limit).cast("bigint").alias("page_limit"),
        F.ceil(F.col("rows") / limit).cast("bigint").alias("total_pages"))


def dated_pages(df: DataFrame, name: str, date_col: str, limit: int | None = None) -> DataFrame:
    """Every business date of a table paged on its own, all dates in one pass (the extract
    loop over dates and pages, as one distributed rank)."""
    dated = df.withColumn("dt", F.date_format(F.col(date_col).cast("date"), "yyyy-MM-dd"))
    key = PRIMARY_KEYS[name]
    order = [F.col(key).asc_nulls_first()] + [F.col(c).asc_nulls_first() for c in df.columns if c != key]
    return assign_pages(dated, order, limit or PAGE_LIMITS[name], group_by=["dt"])


DATE_COLS = {"customers": "join_date", "products": "created_at", "orders": "order_date", "inventory": "last_restocked_at"}


def rows_of_days(source: dict[str, DataFrame], first: Day, last: Day) -> dict[str, DataFrame]:
    """The rows of each table that belong to a business date in [first, last], with that date as ``dt`` (yyyy-MM-dd).

    Items and logs take the date of their order (once per date, however often the order's row came)."""
    def within(df: DataFrame, col: str) -> DataFrame:
        day = F.col(col).cast("date")
        return df.where(day.between(as_date(first), as_date(last))).withColumn("dt", F.date_format(day, "yyyy-MM-dd"))

    out = {n: within(df, DATE_COLS[n]) for n, df in source.items() if n in DATE_COLS}
    if "orders" in out:
        days = out["orders"].select(F.col("oid").alias("_oid"), "dt").where("_oid is not null").dropDuplicates()
        for n in ("order_items", "order_status_log"):
            if n in source:
                out[n] = source[n].join(days, source[n]["order_id"] == days["_oid"]).drop("_oid")
    return out


def page_index(df: DataFrame, name: str, root: str, orders: DataFrame | None = None, by_day: bool = False, ranges: int | None = None) -> PageIndex:
    """The written listing of one table, in page order, dated as its extract is (items and logs by their order)."""
    day = DATE_COLS.get(name)
    if day is not None:
        return PageIndex.build(df, root, page_order(df, PRIMARY_KEYS[name]), F.col(day), by_day, ranges)
    days = orders.select(F.col("oid").alias("_oid"), F.col("order_date").alias("_dated")).where("_oid is not null").dropDuplicates()
    dated = df.join(days, df["order_id"] == days["_oid"], "left").drop("_oid")
    index = PageIndex.build(dated, root, page_order(df, PRIMARY_KEYS[name]), F.col("_dated"), by_day, ranges)
    return PageIndex(index.spark, root, df.schema)
