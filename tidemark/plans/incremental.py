"""The product and category marts kept commit by commit, from the commit and small states instead of history.

Per commit range, with ``delta`` the sales lines that it adds (:func:`new_lines`):

* ``daily_product_sales``: a bucketed table by product; the commit's product-days are added to the rows that they meet.
* ``product_performance``: bucketed by product. Of a product the commit touched, rows before its first changed day keep their
  frames (only the product's total moves on); the rows from that day on are framed anew, seeded with the last rows before it and
  the running total there. Other products are carried over, most of them with their files.
* ``category_trends``: a state per (category, customer), per (category, product name) and per category. A pair that was not
  there before is one more customer; the sums behind the means, and the day count, move by what the commit changed.

All amounts are exact decimals, so the marts equal a recomputation over all history.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.caching import persist
from tidemark.functions.money import half_up_mean
from tidemark.plans import gold as G
from tidemark.schemas import DAILY_PRODUCT_SALES_KEYS
from tidemark.sources.buckets import Buckets

AMOUNT = "decimal(28,2)"
FRAME_ROWS = 7  # rows of the moving sum, the row itself included
ATTRS = [c for c in DAILY_PRODUCT_SALES_KEYS if c != "order_date"]

_TYPES = {"text": T.StringType(), "long": T.LongType(), "date": T.DateType(), "double": T.DoubleType(), "amount": T.DecimalType(28, 2)}


def _schema(**fields: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields.items()])


_PRODUCT_DAY = dict(pid="long", product_name="text", category="text", sub_category="text", brand="text", base_price="double", order_date="date",
                    sales_count="long", total_sales_amount="amount")
PRODUCT_DAYS = _schema(**_PRODUCT_DAY)
PERFORMANCE = _schema(**_PRODUCT_DAY, prev_day_sales="amount", prev_day_order_cnt="long", last_7_day_sales="amount", overall_sales="amount", rolling_total="amount")
PAIRS = _schema(category="text", customer_id="long")
REVENUE = _schema(category="text", product_name="text", revenue="amount")
COUNTED = ("units", "days", "amount_days", "unit_days", "unique_customers")
CATEGORIES = _schema(category="text", date="date", amount="amount", **dict.fromkeys(COUNTED, "long"))


def plus(a, b):
    """Sum of two sums, either of which may be null for want of a number."""
    return F.coalesce((a + b).cast(AMOUNT), a.cast(AMOUNT), b.cast(AMOUNT))


# ---- daily_product_sales -------------------------------------------------------------------


def add_product_days(held: DataFrame, added: DataFrame) -> DataFrame:
    """Product-days of both, one row each."""
    return G.compact_product_days(held.unionByName(added.select(*held.columns)))


# ---- product_performance -----------------------------------------------------------------------


def suffix_rows(held: DataFrame, added: DataFrame) -> DataFrame:
    """What the frames of the touched products are built from: their rows from the first changed day on, the commit's
    product-days added, and before them the last ``FRAME_ROWS - 1`` rows as seeds (``_seed``), with the running total there (``_base``)."""
    first = added.groupBy("pid").agg(F.min("order_date").alias("_first"))
    mine = held.join(first, "pid")
    back = Window.partitionBy("pid").orderBy(F.desc("order_date"))
    before = mine.where("order_date < _first").withColumn("_r", F.row_number().over(back)).where(F.col("_r") < FRAME_ROWS)
    seeds = before.select(*PRODUCT_DAYS.fieldNames(), F.lit(True).alias("_seed"), F.when(F.col("_r") == 1, F.col("rolling_total")).alias("_base"))
    after = add_product_days(mine.where("order_date >= _first").select(*PRODUCT_DAYS.fieldNames()), added)
    return seeds.unionByName(after.select("*", F.lit(False).alias("_seed"), F.lit(None).cast(AMOUNT).alias("_base")))


def frames(rows: DataFrame) -> DataFrame:
    """The frames of the rows that are no seeds (``overall_sales`` is left to the caller)."""
    by_day = Window.partitionBy("pid").orderBy("order_date")
    whole = Window.partitionBy("pid")
    amount = F.col("total_sales_amount")
    running = F.sum(F.when(~F.col("_seed"), amount)).over(by_day.rowsBetween(Window.unboundedPreceding, 0))
    framed = rows.select(
        *PRODUCT_DAYS.fieldNames(), "_seed",
        F.lag(amount, 1, 0).over(by_day).alias("prev_day_sales"),
        F.lag("sales_count", 1, 0).over(by_day).alias("prev_day_order_cnt"),
        F.sum(amount).over(by_day.rowsBetween(1 - FRAME_ROWS, 0)).cast(AMOUNT).alias("last_7_day_sales"),
        plus(F.max("_base").over(whole), running).alias("rolling_total"),
    )
    return framed.where("not _seed").drop("_seed")


def product_performance_step(held: DataFrame, added: DataFrame) -> DataFrame:
    """``held`` rows of the mart with the commit's product-days: every row of the products held or added, framed."""
    changed = added.groupBy("pid").agg(F.min("order_date").alias("_first"), F.sum("total_sales_amount").alias("_more"))
    before = held.groupBy("pid").agg(F.max("overall_sales").alias("_overall"))
    total = changed.join(before, "pid", "left").select("pid", "_first", plus(F.col("_overall"), F.col("_more")).alias("_total"))
    kept = held.join(total, "pid", "left").where("_first is null or order_date < _first")
    kept = kept.withColumn("overall_sales", F.when(F.col("_first").isNotNull(), F.col("_total")).otherwise(F.col("overall_sales"))).select(*PERFORMANCE.fieldNames())
    fresh = frames(suffix_rows(held, added)).join(total.select("pid", F.col("_total").alias("overall_sales")), "pid")
    return kept.unionByName(fresh.select(*PERFORMANCE.fieldNames()))


# ---- category_trends -----------------------------------------------------------------------------


def new_lines(orders: DataFrame, items: DataFrame, products: DataFrame, first: int, last: int) -> DataFrame:
    """Sales lines that the commits [first, last] complete: their items with any order up to them, and earlier items with their orders."""
    def commits(df: DataFrame, since: bool) -> DataFrame:
        v = F.col("commit_version")
        return df.where(v.between(first, last) if since else v < first)

    known = orders.where(F.col("commit_version") <= last)
    return G.sales_lines(known, commits(items, True), products).unionByName(G.sales_lines(commits(orders, True), commits(items, False), products))


@dataclass
class CategoryStates:
    """The three states of the category mart below ``root``."""

    spark: SparkSession
    root: str
    n: int = 64

    def __post_init__(self):
        make = lambda name, keys, schema, n: Buckets(self.spark, f"{self.root.rstrip('/')}/{name}", keys, schema, n)
        self.pairs = make("category_customers", ("category", "customer_id"), PAIRS, self.n)
        self.revenue = make("category_products", ("category", "product_name"), REVENUE, self.n)
        self.totals = make("categories", ("category",), CATEGORIES, 1)

    def step(self, version: int, before: int, lines: DataFrame, day_changes: DataFrame) -> None:
        """``lines``: the commit's sales lines; ``day_changes``: its change of the product-days (category, order_date,
        amount, units and the growth of the day counts)."""
        seen = persist(lines.select("category", "customer_id").distinct())
        touched, places = self.pairs.touched(seen), self.pairs.map(before)
        held = self.pairs.read(before, touched)
        met = held.withColumn("_held", F.lit(True))
        fresh = persist(seen.join(met, seen["category"].eqNullSafe(met["category"]) & seen["customer_id"].eqNullSafe(met["customer_id"]), "left")
                        .where("_held is null").select(seen["category"], seen["customer_id"]))
        self.pairs.write(version, places, held.unionByName(fresh), touched)

        sold = lines.groupBy("category", "product_name").agg(F.sum("line_total").cast(AMOUNT).alias("revenue"))
        self.revenue.change(version, before, sold, lambda held, more: held.unionByName(more).groupBy("category", "product_name").agg(F.sum("revenue").cast(AMOUNT).alias("revenue")))

        customers = fresh.groupBy("category").agg(F.count("customer_id").alias("unique_customers"))
        days = day_changes.groupBy("category").agg(F.max("order_date").alias("date"), F.sum("amount").cast(AMOUNT).alias("amount"), *[F.sum(c).alias(c) for c in COUNTED[:-1]])
        changes = days.unionByName(customers, allowMissingColumns=True).select(*CATEGORIES.fieldNames())
        self.totals.change(version, before, changes, lambda held, more: held.unionByName(more).groupBy("category").agg(
            F.max("date").alias("date"), F.sum("amount").cast(AMOUNT).alias("amount"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTED]))

    def publish(self, version: int) -> DataFrame:
        """The mart as of ``version``: its size is the categories and their products, not the sales."""
        totals = self.totals.read(version).where("days > 0")
        means = totals.select("category", "date", half_up_mean(F.col("amount"), F.col("amount_days"), 2, 2).alias("daily_revenue"),
                              half_up_mean(F.col("units"), F.col("unit_days"), 0, 0).alias("daily_orders"), "unique_customers")
        top = G.category_top_product(self.revenue.read(version).withColumnRenamed("revenue", "top_product_revenue"))
        return means.join(top, "category").select("category", "date", "daily_revenue", "daily_orders", "unique_customers",
                                                  F.col("product_name").alias("top_product"), "top_product_revenue")


def product_day_changes(held: DataFrame, added: DataFrame) -> DataFrame:
    """What ``added`` product-days change: (category, order_date, amount, units) and by how much the product-days grow, those
    with an amount and those with units (the divisors of the means)."""
    keys = held.select(*DAILY_PRODUCT_SALES_KEYS, F.lit(1).alias("_held"), F.col("total_sales_amount").alias("_amount"), F.col("sales_count").alias("_units"))

    def new(now: str, was: str):
        return F.when(F.col(now).isNotNull() & F.col(was).isNull(), 1).otherwise(0).cast("bigint")

    joined = added.withColumn("_now", F.lit(1)).join(keys, DAILY_PRODUCT_SALES_KEYS, "left")
    return joined.select("category", "order_date", F.col("total_sales_amount").alias("amount"), F.col("sales_count").alias("units"),
                         new("_now", "_held").alias("days"), new("total_sales_amount", "_amount").alias("amount_days"), new("sales_count", "_units").alias("unit_days"))
