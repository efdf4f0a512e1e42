"""Commerce entities over the driver's TPC-H-like tables.

The shop's six source tables do not exist in the test data, so each is defined as a
view over the given tables (the oracle SQL defines the very same views). Every view is
a narrow projection of a scan plus, where needed, a join to a dimension; Catalyst prunes
the columns at the parquet scan and pushes filters written downstream into it.

Mapping (fixed, shared with the oracle). Some rows arrive as a faulty shop would send them, so that every
reject path carries rows; which ones follows from the given columns:
  customers   customer_id=c_custkey (null where c_acctbal < -700), name=c_name, email=null, city=nation name,
              country=region name, join_date = 1995-01-01 + (c_custkey % 365) days
  products    pid=p_partkey (null where p_size = 50), product_name=p_name, category=p_type,
              sub_category=string(p_size), brand=p_brand, base_price=p_retailprice,
              discount_pct=2.5 * (p_size % 5), current_stock=p_size - 2 (so -1 occurs), supplier=null,
              created_at = 1995-01-01 + (p_partkey % 365) days; rows with p_size = 25 arrive twice
  orders      oid=o_orderkey (null where o_totalprice < 5000), customer_id=o_custkey, order_date=date(o_orderdate),
              order_status=o_orderstatus, payment_method=o_orderpriority,
              shipping_address=null, amounts 0 (recomputed in silver); urgent orders in process arrive twice
  order_items order_item_id = l_orderkey*8 + l_linenumber (repeats on purpose; null for returned single units),
              order_id=l_orderkey (null for single units returned or accepted with l_tax > 0.07), product_id=l_partkey,
              quantity=l_quantity (0 for returned pairs), unit_price = l_extendedprice / quantity (half up, cents),
              gross_amount = unit_price * quantity, discount_at_order = 100*l_discount,
              line_total = l_extendedprice * (1 - discount/100) (half up, cents); accepted triples without
              discount come with quantity, price and discount -1
  inventory   one row per (l_partkey, l_suppkey): inventory_id = l_partkey*10^9 + l_suppkey, product_id=l_partkey
              (null where sum(l_quantity) = 9), warehouse_location = supplier's nation, quantity_on_hand =
              sum(l_quantity) - 5 (so negative ones occur), reorder_threshold = 20, last_restocked_at = max ship date
  order_status_log  log_id=event_id (null where value < 0.5, and in commit 1 for clicks and errors: that batch
              fails its gate), order_id=user_id (null where value < 0.1), old_status = previous
              state of the same user (by ts, event_id), new_status = the state that the
              event_type stands for (signup pending, view confirmed, click shipped,
              purchase delivered, error cancelled),
              changed_at=ts, changed_by=null, remarks=props
  commit_version (the dated extract a row arrived in), by the entity's own date:
              orders and inventory 0 before 1997, 1 before 1999, else 2; customers and
              products 0 before 1995-05-01, 1 before 1995-09-01, else 2; status logs 0
              before 2024-01-11, 1 before 2024-01-21, else 2; items take their order's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import days_from
from tidemark.functions.money import line_total
from tidemark.operators.ordered import lag_within
from tidemark.schemas import MONEY, PCT
from tidemark.sources.tables import read_table

# Fixed values of the view mapping (shared with the oracle SQL).
JOIN_DATE_BASE = "1995-01-01"
JOIN_DATE_CYCLE = 365
ITEM_ID_STRIDE = 8
INVENTORY_ID_STRIDE = 10**9  # beyond any supplier key; the product stays within a long up to 9 * 10^9 parts
STOCK_OFFSET = 5
REORDER_THRESHOLD = 20
# Commit boundaries per entity: commit 0 before the first date, 1 before the second, else 2.
COMMIT_BOUNDS = {
    "orders": ("1997-01-01", "1999-01-01"),
    "inventory": ("1997-01-01", "1999-01-01"),
    "customers": ("1995-05-01", "1995-09-01"),
    "products": ("1995-05-01", "1995-09-01"),
    "order_status_log": ("2024-01-11", "2024-01-21"),
}


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal"])
    return (
        c.join(_places(spark, sf_dir), c.c_nationkey == F.col("n_nationkey"), "left")
        .select(
            F.when(F.col("c_acctbal") < -700, None).otherwise(F.col("c_custkey")).cast("bigint").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.lit(None).cast("string").alias("email"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("country"),
            days_from(JOIN_DATE_BASE, F.col("c_custkey") % JOIN_DATE_CYCLE).alias("join_date"),
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"])
    return twice(p.select(
        F.when(F.col("p_size") == 50, None).otherwise(F.col("p_partkey")).cast("bigint").alias("pid"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_size").cast("string").alias("sub_category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").cast("double").alias("base_price"),
        (F.col("p_size") % 5 * F.lit(2.5)).alias("discount_pct"),
        (F.col("p_size") - 2).cast("bigint").alias("current_stock"),
        F.lit(None).cast("string").alias("supplier"),
        days_from(JOIN_DATE_BASE, F.col("p_partkey") % JOIN_DATE_CYCLE).alias("created_at"),
    ), F.col("sub_category") == "25")


def twice(df: DataFrame, when: F.Column) -> DataFrame:
    """The rows for which ``when`` holds arrive a second time."""
    again = F.when(F.coalesce(when, F.lit(False)), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("_again", F.explode(again)).drop("_again")


def commit_of(entity: str, day: F.Column) -> F.Column:
    first, second = COMMIT_BOUNDS[entity]
    return (
        F.when(day < F.to_date(F.lit(first)), 0)
        .when(day < F.to_date(F.lit(second)), 1)
        .otherwise(2)
        .cast("int")
    )


def orders(spark: SparkSession, sf_dir: str, with_commit: bool = False) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_totalprice"])
    out = o.select(
        F.when(F.col("o_totalprice") < 5000, None).otherwise(F.col("o_orderkey")).cast("bigint").alias("oid"),
        F.col("o_custkey").cast("bigint").alias("customer_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderpriority").alias("payment_method"),
        F.lit(None).cast("string").alias("shipping_address"),
        F.lit(0.0).alias("total_amount"),
        F.lit(0.0).alias("discount_applied"),
        F.lit(0.0).alias("final_amount"),
    )
    out = twice(out, (F.col("payment_method") == "1-URGENT") & (F.col("order_status") == "P"))
    if with_commit:
        out = out.withColumn("commit_version", commit_of("orders", F.col("order_date")))
    return out


def order_items(spark: SparkSession, sf_dir: str, with_commit: bool = False) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"])
    gross = F.col("l_extendedprice").cast(MONEY)
    ordered = F.col("l_quantity").cast("bigint")
    pct = (F.col("l_discount").cast("decimal(4,2)") * F.lit(100)).cast(PCT)
    returned, accepted = F.col("l_returnflag") == "R", F.col("l_returnflag") == "A"
    taxed = F.col("l_tax") > 0.07
    spoilt = accepted & (ordered == 3) & (F.col("l_discount") < 0.005)
    unit = F.when(ordered > 0, F.round(gross / ordered.cast("decimal(20,0)"), 2)).cast(MONEY)
    price = F.when(spoilt, F.lit(-1).cast(MONEY)).otherwise(unit)
    qty = F.when(spoilt, -1).when(returned & (ordered == 2), 0).otherwise(ordered).cast("bigint")
    out = li.select(
        F.when(returned & (ordered == 1), None).otherwise(F.col("l_orderkey") * ITEM_ID_STRIDE + F.col("l_linenumber")).cast("bigint").alias("order_item_id"),
        F.when((returned | accepted) & (ordered == 1) & taxed, None).otherwise(F.col("l_orderkey")).cast("bigint").alias("order_id"),
        F.col("l_partkey").cast("bigint").alias("product_id"),
        qty.alias("quantity"),
        price.alias("unit_price_at_order"),
        F.when(spoilt, F.lit(-1).cast(PCT)).otherwise(pct).alias("discount_at_order"),
        line_total(gross, pct).alias("line_total"),
        (price * qty).cast(MONEY).alias("gross_amount"),
        "l_orderkey",
    )
    if with_commit:
        o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
        commits = o.select(F.col("o_orderkey").alias("l_orderkey"), commit_of("orders", F.to_date("o_orderdate")).alias("commit_version"))
        out = out.join(commits, "l_orderkey", "left").fillna({"commit_version": 0}).select(*out.columns, "commit_version")
    return out.drop("l_orderkey")


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", ["l_partkey", "l_suppkey", "l_quantity", "l_shipdate"])
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    stock = li.groupBy("l_partkey", "l_suppkey").agg(
        F.sum("l_quantity").alias("qoh"), F.max(F.to_date("l_shipdate")).alias("last_restocked_at"))
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    return (
        stock.join(s, stock.l_suppkey == s.s_suppkey, "left")
        .join(nation, F.col("s_nationkey") == nation.n_nationkey, "left")
        .select(
            (F.col("l_partkey") * INVENTORY_ID_STRIDE + F.col("l_suppkey")).cast("bigint").alias("inventory_id"),
            F.when(F.col("qoh") == 9, None).otherwise(F.col("l_partkey")).cast("bigint").alias("product_id"),
            F.col("n_name").alias("warehouse_location"),
            (F.col("qoh").cast("bigint") - STOCK_OFFSET).alias("quantity_on_hand"),
            F.lit(REORDER_THRESHOLD).cast("bigint").alias("reorder_threshold"),
            F.col("last_restocked_at"),
        )
    )


EVENT_STATES = {"signup": "pending", "view": "confirmed", "click": "shipped", "purchase": "delivered", "error": "cancelled"}


def order_status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    # The events' types stand for the shop's order states, one state each (fixed pairs).
    state = F.create_map(*[F.lit(x) for pair in EVENT_STATES.items() for x in pair])
    first, second = COMMIT_BOUNDS["order_status_log"]
    day = F.to_date("ts")
    faulty = (day >= F.to_date(F.lit(first))) & (day < F.to_date(F.lit(second))) & F.col("event_type").isin("click", "error")
    ev = ev.withColumn("_lost_id", faulty | (F.col("value") < 0.5)).withColumn("event_type", state[F.col("event_type")])
    with_prev = lag_within(ev, partition_by=["user_id"], order_by=["ts", "event_id"],
                           value_cols={"event_type": "old_status"})
    return with_prev.select(
        F.when(F.col("_lost_id"), None).otherwise(F.col("event_id")).cast("bigint").alias("log_id"),
        F.when(F.col("value") < 0.1, None).otherwise(F.col("user_id")).cast("bigint").alias("order_id"),
        F.col("old_status"),
        F.col("event_type").alias("new_status"),
        F.col("ts").alias("changed_at"),
        F.lit(None).cast("string").alias("changed_by"),
        F.col("props").alias("remarks"),
    )


VIEWS = {
    "customers": customers,
    "products": products,
    "orders": orders,
    "order_items": order_items,
    "inventory": inventory,
    "order_status_log": order_status_log,
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return VIEWS[name](spark, sf_dir)

# The date that decides which dated extract (commit) a row of each entity arrived in.
COMMIT_DATE_COL = {
    "customers": "join_date",
    "products": "created_at",
    "orders": "order_date",
    "inventory": "last_restocked_at",
    "order_status_log": "changed_at",
}


def committed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view plus ``commit_version``: the landed table as a sequence of commits."""
    if name == "order_items":
        return order_items(spark, sf_dir, with_commit=True)
    df = VIEWS[name](spark, sf_dir)
    return df.withColumn("commit_version", commit_of(name, F.to_date(F.col(COMMIT_DATE_COL[name]))))
