"""Registrations: the inventory keys, each a Spark plan plus its oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog import SPEC, cols, register, sql_publish
from tidemark.oracle import hu
from tidemark.plans import flow
from tidemark.plans import gold as G
from tidemark.plans.extracts import PAGE_LIMITS, PRIMARY_KEYS
from tidemark.sources import commerce

ENTITIES = ["customers", "products", "orders", "order_items", "inventory", "order_status_log"]
#: Ids that a landed row may lack.
MAY_LACK = {"customers": ("customer_id",), "products": ("pid",), "orders": ("oid",), "order_items": ("order_item_id", "order_id"),
            "inventory": ("product_id",), "order_status_log": ("log_id", "order_id")}
_B = {"customers": "b_customers", "products": "b_products", "orders": "b_orders",
      "order_items": "b_items", "inventory": "b_inventory", "order_status_log": "b_logs"}

# =============================================================================================
# gold marts over the fresh lake

DSS_SQL = f"""
SELECT {sql_publish(cols("order_date:date, order_count:bigint, total_amount:double"))},
       CAST({{mean}} AS DOUBLE) AS avg_discount_per_order, CAST(net_revenue AS DOUBLE) AS net_revenue
FROM (SELECT order_date, COUNT(oid) AS order_count, CAST(SUM(total_amount) AS DECIMAL(28,2)) AS total_amount,
             SUM(discount_applied) AS discount_sum, COUNT(discount_applied) AS discount_n,
             CAST(SUM(final_amount) AS DECIMAL(28,2)) AS net_revenue
      FROM f_orders GROUP BY order_date)"""
DSS_SQL = DSS_SQL.replace("{mean}", hu("discount_sum", 6, "discount_n", 6))


@register("daily_sales_summary", DSS_SQL)
def daily_sales_summary(spark: SparkSession, d: str) -> DataFrame:
    """Per-day mart maintained incrementally: one partial per commit, merged exactly."""
    orders = flow.fresh_lake(spark, d).silver("orders")
    partials = G.daily_sales_batch(orders, by=("commit_version",))
    return G.publish_daily_sales(G.merge_daily_sales(None, partials))


@register("daily_sales_batch", f"""
SELECT CAST(commit_version AS BIGINT) AS commit_version, {sql_publish(cols("order_date:date, order_count:bigint, total_amount:double, discount_sum:double, discount_n:bigint, net_revenue:double"))}
FROM (SELECT c.commit_version, o.order_date, COUNT(o.oid) AS order_count, SUM(o.total_amount) AS total_amount,
             SUM(o.discount_applied) AS discount_sum, COUNT(o.discount_applied) AS discount_n,
             SUM(o.final_amount) AS net_revenue
      FROM f_orders o JOIN s_order_commits c ON o.oid = c.oid GROUP BY c.commit_version, o.order_date)""")
def daily_sales_batch(spark: SparkSession, d: str) -> DataFrame:
    """Mergeable per-day partials of each commit (grouped by a cast date)."""
    orders = flow.fresh_lake(spark, d).silver("orders")
    parts = orders.groupBy("commit_version", F.col("order_date").cast("date").alias("order_date")).agg(
        F.count("oid").alias("order_count"),
        F.sum("total_amount").alias("total_amount"),
        F.sum("discount_applied").alias("discount_sum"),
        F.count("discount_applied").alias("discount_n"),
        F.sum("final_amount").alias("net_revenue"),
    )
    return parts


@register("order_totals", f"""
SELECT oid, CAST(total_amount AS DOUBLE) AS total_amount, CAST(discount_applied AS DOUBLE) AS discount_applied,
       CAST(final_amount AS DOUBLE) AS final_amount FROM f_totals""")
def order_totals(spark: SparkSession, d: str) -> DataFrame:
    """Per order: sum(unit price x qty), mean item discount, sum(line totals)."""
    from tidemark.plans.silver import order_totals as ot
    lake = flow.fresh_lake(spark, d)
    return ot(lake.batch("orders"), lake.silver("order_items").drop("commit_version"))


@register("customer_aggregates", f"""
SELECT {sql_publish(cols("customer_id, total_order_value:double, total_orders:bigint, last_order_date:date"))}
FROM g_cust_agg""")
def customer_aggregates(spark: SparkSession, d: str) -> DataFrame:
    return G.customer_aggregates(flow.fresh_lake(spark, d).silver("orders"))


@register("affected_keys_semi", f"""
SELECT {sql_publish(cols(SPEC["orders"]))} FROM f_orders o
WHERE EXISTS (SELECT 1 FROM f_orders b JOIN s_order_commits c ON b.oid = c.oid
              WHERE c.commit_version = 2 AND b.customer_id = o.customer_id)""")
def affected_keys_semi(spark: SparkSession, d: str) -> DataFrame:
    """Full order history of the customers touched by the last commit."""
    orders = flow.fresh_lake(spark, d).silver("orders")
    return G.affected_customers(orders, orders.filter(F.col("commit_version") == 2)).drop("commit_version")


@register("customer_tiers", f"""
SELECT customer_id, CAST(total_order_value AS DOUBLE) AS total_order_value,
       NTILE(4) OVER (ORDER BY total_order_value DESC, customer_id) AS tile,
       CASE NTILE(4) OVER (ORDER BY total_order_value DESC, customer_id)
            WHEN 1 THEN 'Platinum' WHEN 2 THEN 'Gold' WHEN 3 THEN 'Silver' ELSE 'bronze' END AS customer_tier
FROM g_cust_agg""")
def customer_tiers(spark: SparkSession, d: str) -> DataFrame:
    """Spend quartiles over all customers: three cut rows found by counting, then a comparison per row (no sort)."""
    from tidemark.caching import persist
    from tidemark.functions.labels import tier_label
    agg = persist(G.customer_aggregates(flow.fresh_lake(spark, d).silver("orders")).select("customer_id", "total_order_value"))
    t = agg.withColumn("tile", G.spend_tile(agg))
    return t.withColumn("customer_tier", tier_label(F.col("tile")))


C360_SPEC = ("customer_id, name, email, city, country, join_date:date, total_order_value:double, total_orders:bigint, "
             "customer_tier, last_order_date:date, churn_risk_score, updated_at:ts")


@register("customer_360", f"SELECT {sql_publish(cols(C360_SPEC))} FROM g_c360")
def customer_360(spark: SparkSession, d: str) -> DataFrame:
    """Customer mart: upsert of affected customers, quartile tiers, churn risk as of 2001-08-01."""
    return flow.customer_360(flow.fresh_lake(spark, d))


@register("top_customers", f"""
SELECT {sql_publish(cols("customer_id, name, total_order_value:double, customer_tier"))}
FROM g_c360 ORDER BY total_order_value DESC, customer_id LIMIT 10""")
def top_customers(spark: SparkSession, d: str) -> DataFrame:
    """The ten biggest spenders of the customer mart (a top-k report; the limit is the feature)."""
    mart = flow.customer_360(flow.fresh_lake(spark, d))
    return (mart.orderBy(F.col("total_order_value").desc(), F.col("customer_id")).limit(10)
            .select("customer_id", "name", "total_order_value", "customer_tier"))


DPS_SPEC = ("pid, product_name, category, sub_category, brand, base_price, order_date:date, sales_count:bigint, "
            "total_sales_amount:double")


@register("daily_product_sales", f"SELECT {sql_publish(cols(DPS_SPEC))} FROM g_dps")
def daily_product_sales(spark: SparkSession, d: str) -> DataFrame:
    lake = flow.fresh_lake(spark, d)
    return G.product_day_partials(lake.silver("orders"), lake.silver("order_items"), lake.silver("products"))


@register("daily_product_sales_compact", f"SELECT {sql_publish(cols(DPS_SPEC))} FROM g_dps")
def daily_product_sales_compact(spark: SparkSession, d: str) -> DataFrame:
    """Per-commit partials appended, then compacted to one row per product-day."""
    lake = flow.fresh_lake(spark, d)
    parts = G.product_day_partials(lake.silver("orders"), lake.silver("order_items"), lake.silver("products"),
                                   by=("commit_version",))
    return G.compact_product_days(parts)


PERF_SPEC = DPS_SPEC + (", prev_day_sales:double, prev_day_order_cnt:bigint, last_7_day_sales:double, "
                        "overall_sales:double, rolling_total:double")


def _perf(spark: SparkSession, d: str) -> DataFrame:
    return G.product_performance(flow.product_days(flow.fresh_lake(spark, d)))


@register("product_performance", f"SELECT {sql_publish(cols(PERF_SPEC))} FROM g_perf")
def product_performance(spark: SparkSession, d: str) -> DataFrame:
    return _perf(spark, d)


for _key, _extra in [
    ("product_prev_day", "prev_day_sales:double, prev_day_order_cnt:bigint"),
    ("product_last_7", "last_7_day_sales:double"),
    ("product_overall", "overall_sales:double"),
    ("product_rolling", "rolling_total:double"),
]:
    _names = [c.split(":")[0].strip() for c in _extra.split(",")]

    def _make(names):
        def q(spark: SparkSession, d: str) -> DataFrame:
            return _perf(spark, d).select("pid", "order_date", *names)
        return q

    register(_key, f"SELECT {sql_publish(cols('pid, order_date:date, ' + _extra))} FROM g_perf")(_make(_names))


@register("category_daily_means", f"""
SELECT {sql_publish(cols("category, date:date, daily_revenue:double, daily_orders:double"))} FROM g_means""")
def category_daily_means(spark: SparkSession, d: str) -> DataFrame:
    return G.category_daily_means(flow.product_days(flow.fresh_lake(spark, d)))


def _lines(spark: SparkSession, d: str) -> DataFrame:
    lake = flow.fresh_lake(spark, d)
    return G.sales_lines(lake.silver("orders"), lake.silver("order_items"), lake.silver("products"))


@register("category_product_revenue", f"""
SELECT category, product_name, CAST(top_product_revenue AS DOUBLE) AS top_product_revenue FROM g_rev""")
def category_product_revenue(spark: SparkSession, d: str) -> DataFrame:
    return G.category_product_revenue(_lines(spark, d))


@register("category_top_product", f"""
SELECT category, product_name, CAST(top_product_revenue AS DOUBLE) AS top_product_revenue FROM g_top""")
def category_top_product(spark: SparkSession, d: str) -> DataFrame:
    return G.category_top_product(G.category_product_revenue(_lines(spark, d)))


@register("category_unique_customers", "SELECT category, unique_customers FROM g_uniq")
def category_unique_customers(spark: SparkSession, d: str) -> DataFrame:
    return G.category_unique_customers(_lines(spark, d))


CT_SPEC = ("category, date:date, daily_revenue:double, daily_orders:double, unique_customers:bigint, top_product, "
           "top_product_revenue:double")


@register("category_trends", f"""
SELECT {sql_publish(cols("m.category, m.date:date, m.daily_revenue:double, m.daily_orders:double, u.unique_customers:bigint"))},
       t.product_name AS top_product, CAST(t.top_product_revenue AS DOUBLE) AS top_product_revenue
FROM g_means m JOIN g_top t ON m.category = t.category JOIN g_uniq u ON m.category = u.category""")
def category_trends(spark: SparkSession, d: str) -> DataFrame:
    return flow.category_trends(flow.fresh_lake(spark, d))


# =============================================================================================
# bronze: landed rows split into bronze / quarantine behind the bad-row gate


def _bronze_sql(name: str) -> str:
    spec = cols(SPEC[name])
    b = _B[name]
    return (f"SELECT {sql_publish(spec)}, 'bronze' AS sink, CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS VARCHAR) AS layer FROM {b} "
            f"UNION ALL SELECT {sql_publish(spec)}, 'quarantine' AS sink, reason, 'bronze' AS layer FROM {b}_q")


def _bronze_query(name: str):
    def q(spark: SparkSession, d: str) -> DataFrame:
        from tidemark.plans.silver import (CUSTOMER_COLS, INVENTORY_COLS, ITEM_COLS, LOG_COLS, ORDER_COLS,
                                           PRODUCT_COLS)
        wanted = {"customers": CUSTOMER_COLS, "products": PRODUCT_COLS, "orders": ORDER_COLS,
                  "order_items": ITEM_COLS, "inventory": INVENTORY_COLS, "order_status_log": LOG_COLS}[name]
        routed = flow.landed(spark, d, name).routed.select(*wanted, "sink", "reason", "layer")
        return routed.withColumn("sink", F.when(F.col("sink") == "main", "bronze").otherwise(F.col("sink")))
    q.__doc__ = f"Landing split of {name} behind the gate of each commit, routed in one pass."
    return q


for _n in ENTITIES:
    register(f"bronze_{_n}", _bronze_sql(_n), MAY_LACK[_n])(_bronze_query(_n))


def _gate_sql() -> str:
    parts = []
    rules = {"customers": ("s_customers", "customer_id IS NULL", False),
             "products": ("s_products", "pid IS NULL", True),
             "orders": ("s_orders", "oid IS NULL", False),
             "order_items": ("s_items", "(order_item_id IS NULL OR order_id IS NULL)", False),
             "order_status_log": ("s_logs", "(log_id IS NULL AND order_id IS NOT NULL)", False),
             "inventory": ("s_inventory", "(inventory_id IS NULL OR product_id IS NULL)", False)}
    for name, (src, bad, strict) in rules.items():
        op = ">" if strict else ">="
        parts.append(
            f"SELECT '{name}' AS table_name, CAST(commit_version AS BIGINT) AS commit_version, COUNT(*) AS rows, COUNT(*) FILTER (WHERE {bad}) AS bad_rows, "
            f"NOT (COUNT(*) FILTER (WHERE {bad}) {op} CAST(COUNT(*) AS DECIMAL(20,0)) * 0.3) AS passed FROM {src} GROUP BY commit_version")
    return " UNION ALL ".join(parts)


@register("quality_gate", _gate_sql())
def quality_gate(spark: SparkSession, d: str) -> DataFrame:
    """Verdict of the bad-row gate for each commit of each landed table (one aggregate per table)."""
    out = None
    for name in ENTITIES:
        g = flow.landed(spark, d, name).gate.select(F.lit(name).alias("table_name"), "*")
        out = g if out is None else out.unionByName(g)
    return out


# =============================================================================================
# silver: replay of the whole landed history against a lake that already holds commit 0


def _silver_sql(name: str) -> str:
    spec = cols(SPEC[name])
    return (f"SELECT {sql_publish(spec)}, 'silver' AS sink, CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS VARCHAR) AS layer FROM r_{name} "
            f"UNION ALL SELECT {sql_publish(spec)}, 'quarantine' AS sink, reason, 'silver' AS layer FROM r_{name}_q")


def _silver_query(name: str):
    def q(spark: SparkSession, d: str) -> DataFrame:
        return flow.with_sink(flow.replay_lake(spark, d).cleaned(name))
    q.__doc__ = f"Cleaning step for {name}: accepted rows and quarantine."
    return q


for _n in ENTITIES:
    register(f"silver_{_n}", _silver_sql(_n), MAY_LACK[_n])(_silver_query(_n))


# =============================================================================================
# joins, dedup and repair on the landed / cleaned tables


@register("ref_check_semi", f"""
SELECT {sql_publish(cols(SPEC["order_items"]))} FROM b_items i
WHERE EXISTS (SELECT 1 FROM f_products p WHERE p.pid = i.product_id)""", text=MAY_LACK["order_items"])
def ref_check_semi(spark: SparkSession, d: str) -> DataFrame:
    """Referential check: landed items whose product exists in silver."""
    from tidemark.operators.cleaning import ref_check_semi as rc
    from tidemark.plans.silver import ITEM_COLS
    lake = flow.fresh_lake(spark, d)
    return rc(lake.batch("order_items").select(*ITEM_COLS), lake.silver("products"), "product_id", "pid")


def _replay_parts(spark: SparkSession, d: str):
    from tidemark.plans.silver import ORDER_COLS
    lake = flow.replay_lake(spark, d)
    batch = lake.batch("orders").select(*ORDER_COLS)
    return batch, lake.before["orders"]


@register("new_rows_anti", f"""
SELECT {sql_publish(cols(SPEC["orders"]))} FROM b_orders b
WHERE NOT EXISTS (SELECT 1 FROM z_orders s WHERE s.oid = b.oid)""")
def new_rows_anti(spark: SparkSession, d: str) -> DataFrame:
    """Landed orders not yet in silver (silver holds commit 0): shrink-then-anti join."""
    from tidemark.operators.cleaning import new_rows_anti as nra
    batch, before = _replay_parts(spark, d)
    return nra(batch, before, ["oid"])


@register("dup_rows_semi", f"""
SELECT {sql_publish(cols(SPEC["orders"]))} FROM b_orders b
WHERE EXISTS (SELECT 1 FROM z_orders s WHERE s.oid = b.oid)""")
def dup_rows_semi(spark: SparkSession, d: str) -> DataFrame:
    """Landed orders already in silver (repeats, to quarantine)."""
    from tidemark.operators.cleaning import dup_rows_semi as drs
    batch, before = _replay_parts(spark, d)
    return drs(batch, before, ["oid"])


@register("rejected_rows_anti", f"SELECT {sql_publish(cols(SPEC['orders']))} FROM f_orders_q")
def rejected_rows_anti(spark: SparkSession, d: str) -> DataFrame:
    """Landed orders minus accepted orders (no items, unknown customer, null key)."""
    return flow.fresh_lake(spark, d).cleaned("orders").quarantined.drop("commit_version")


@register("orders_without_items", f"""
SELECT {sql_publish(cols(SPEC["orders"]))} FROM s_orders o
WHERE NOT EXISTS (SELECT 1 FROM s_items i WHERE i.order_id = o.oid)""", text=MAY_LACK["orders"])
def orders_without_items(spark: SparkSession, d: str) -> DataFrame:
    from tidemark.plans.checks import orders_without_items as owi
    return owi(commerce.orders(spark, d), commerce.order_items(spark, d))


@register("dedup_rows", f"SELECT DISTINCT {sql_publish(cols(SPEC['order_items']))} FROM b_items", text=MAY_LACK["order_items"])
def dedup_rows(spark: SparkSession, d: str) -> DataFrame:
    from tidemark.operators.cleaning import dedup_rows as dr
    from tidemark.plans.silver import ITEM_COLS
    return dr(flow.fresh_lake(spark, d).batch("order_items").select(*ITEM_COLS))


_ITEM_REST = ["order_id", "product_id", "quantity", "unit_price_at_order", "discount_at_order", "line_total",
              "gross_amount"]


@register("dedup_by_key", f"""
SELECT {sql_publish(cols(SPEC["order_items"]))} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY order_item_id ORDER BY {", ".join(c + " NULLS FIRST" for c in _ITEM_REST)}) AS rn
  FROM b_items) WHERE rn = 1""", text=MAY_LACK["order_items"])
def dedup_by_key(spark: SparkSession, d: str) -> DataFrame:
    """One deterministic survivor per order_item_id (the id repeats in the landed items)."""
    from tidemark.operators.cleaning import dedup_by_key as dk
    from tidemark.plans.silver import ITEM_COLS
    return dk(flow.fresh_lake(spark, d).batch("order_items").select(*ITEM_COLS), ["order_item_id"])


@register("fill_defaults", f"""
SELECT log_id, order_id, COALESCE(old_status, 'Unknown') AS old_status, COALESCE(new_status, 'Unknown') AS new_status,
       {sql_publish(cols("changed_at:ts"))}, COALESCE(changed_by, 'Unknown') AS changed_by,
       COALESCE(remarks, 'N/A') AS remarks FROM b_logs""", text=MAY_LACK["order_status_log"])
def fill_defaults(spark: SparkSession, d: str) -> DataFrame:
    """Null repair of the status log (first log of an order has no old status)."""
    from tidemark.operators.cleaning import fill_defaults as fd
    from tidemark.plans.silver import LOG_COLS, LOG_DEFAULTS
    return fd(flow.fresh_lake(spark, d).batch("order_status_log").select(*LOG_COLS), LOG_DEFAULTS)


@register("price_list", "SELECT DISTINCT pid, base_price, discount_pct FROM f_products")
def price_list(spark: SparkSession, d: str) -> DataFrame:
    from tidemark.plans.checks import price_list as pl
    return pl(flow.fresh_lake(spark, d).silver("products"))


@register("line_pricing", """
SELECT i.order_item_id, i.order_id, i.product_id, i.quantity, p.base_price, p.discount_pct,
       CAST(ROUND(CAST(i.quantity AS DECIMAL(12,0)) * CAST(p.base_price AS DECIMAL(12,2))
             * (100 - CAST(p.discount_pct AS DECIMAL(5,2))) * CAST(0.01 AS DECIMAL(3,2)), 2) AS DOUBLE) AS list_line_total
FROM f_order_items i JOIN (SELECT DISTINCT pid, base_price, discount_pct FROM f_products) p ON i.product_id = p.pid""", text=MAY_LACK["order_items"])
def line_pricing(spark: SparkSession, d: str) -> DataFrame:
    from tidemark.plans.checks import line_pricing as lp
    from tidemark.plans.checks import price_list as pl
    lake = flow.fresh_lake(spark, d)
    return lp(lake.silver("order_items"), pl(lake.silver("products")))


@register("product_last_restock", """
SELECT p.pid, STRFTIME(MIN(COALESCE(i.last_restocked_at, p.created_at)), '%Y-%m-%d') AS last_date
FROM f_products p LEFT JOIN f_inventory i ON p.pid = i.product_id GROUP BY p.pid""")
def product_last_restock(spark: SparkSession, d: str) -> DataFrame:
    from tidemark.plans.checks import product_last_restock as plr
    lake = flow.fresh_lake(spark, d)
    return plr(lake.silver("products"), lake.silver("inventory"))


@register("eligible_customers", """
SELECT STRFTIME(d.order_date, '%Y-%m-%d') AS order_date,
       (SELECT COUNT(*) FROM f_customers c WHERE c.join_date <= d.order_date) AS eligible_customers
FROM (SELECT DISTINCT order_date FROM f_orders) d""")
def eligible_customers(spark: SparkSession, d: str) -> DataFrame:
    from tidemark.plans.checks import eligible_customers as ec
    lake = flow.fresh_lake(spark, d)
    return ec(lake.silver("customers"), lake.silver("orders"))


_TRANSITIONS = f"""
SELECT log_id, order_id, old_status, new_status, {sql_publish(cols("changed_at:ts, prev_changed_at:ts"))},
       illegal_transition, not_after_previous FROM (
  SELECT l.*, l.old_status IS NOT NULL AND t.old_status IS NULL AS illegal_transition,
         prev_changed_at IS NOT NULL AND l.changed_at <= prev_changed_at AS not_after_previous
  FROM (SELECT log_id, order_id, old_status, new_status, changed_at,
               LAG(changed_at) OVER (PARTITION BY order_id ORDER BY log_id) AS prev_changed_at FROM b_logs WHERE log_id IS NOT NULL) l
  LEFT JOIN (VALUES ('pending','confirmed'), ('pending','cancelled'), ('confirmed','shipped'), ('confirmed','cancelled'),
                    ('shipped','delivered'), ('shipped','returned'), ('delivered','returned')) t(old_status, new_status)
    ON l.old_status = t.old_status AND l.new_status = t.new_status)
WHERE illegal_transition OR not_after_previous"""


@register("status_transitions", _TRANSITIONS)
def status_transitions(spark: SparkSession, d: str) -> DataFrame:
    """Illegal transitions and non-increasing change times in the landed status log (before its nulls are repaired).
    Rows that came without their id have no place in the order of changes."""
    from tidemark.plans.checks import status_transitions as st
    return st(flow.fresh_lake(spark, d).batch("order_status_log").where(F.col("log_id").isNotNull()))


@register("table_counts", " UNION ALL ".join(
    [f"SELECT 'bronze' AS layer, '{n}' AS table_name, COUNT(*) AS rows FROM {_B[n]}" for n in ENTITIES]
    + [f"SELECT 'silver' AS layer, '{n}' AS table_name, COUNT(*) AS rows FROM f_{n}" for n in ENTITIES]))
def table_counts(spark: SparkSession, d: str) -> DataFrame:
    from tidemark.plans.checks import table_counts as tc
    lake = flow.fresh_lake(spark, d)
    tables = {("bronze", n): lake.batch(n) for n in ENTITIES}
    tables.update({("silver", n): lake.silver(n) for n in ENTITIES})
    return tc(tables)


# =============================================================================================
# paged extracts


def _page_sql(view: str, name: str, spec: str, key: str, limit: int, other: list[str]) -> str:
    order = ", ".join([f"{key} NULLS FIRST"] + [f"{c} NULLS FIRST" for c in other])
    return f"""
SELECT {sql_publish(cols(spec))}, CAST((rn - 1) // {limit} + 1 AS BIGINT) AS page,
       CAST(CEIL(n / {limit}) AS BIGINT) AS total_pages, CAST((rn - 1) % {limit} + 1 AS BIGINT) AS row_in_page
FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY {order}) AS rn, COUNT(*) OVER () AS n FROM {view})"""


_PAGE_SOURCES = {"customers": "f_customers", "products": "f_products", "orders": "f_orders",
                 "order_items": "f_order_items", "order_status_log": "f_order_status_log", "inventory": "f_inventory"}


def _page_query(name: str):
    def q(spark: SparkSession, d: str) -> DataFrame:
        from tidemark.plans import extracts as X
        lake = flow.fresh_lake(spark, d)
        df = lake.silver(name).drop("commit_version")
        if name == "customers":
            return X.page_customers(df)
        if name == "products":
            return X.page_products(df)
        if name == "orders":
            return X.page_orders(df)
        if name == "order_items":
            return X.page_order_items(df, lake.silver("orders"))
        if name == "order_status_log":
            return X.page_order_status_log(df, lake.silver("orders"))
        return X.page_inventory(df)
    q.__doc__ = f"Every page of the {name} listing, assigned in one pass."
    return q


def _page_spec(name: str) -> tuple[str, str, list[str]]:
    spec = SPEC[name]
    key = PRIMARY_KEYS[name]
    names = [c.split(":")[0].strip() for c in spec.split(",")]
    return spec, key, [c for c in names if c != key]


for _n in ENTITIES:
    _spec, _key, _other = _page_spec(_n)
    register(f"page_{_n}", _page_sql(_PAGE_SOURCES[_n], _n, _spec, _key, PAGE_LIMITS[_n], _other), MAY_LACK[_n])(_page_query(_n))


@register("page_counts", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, COUNT({k}) AS rows, CAST({lim} AS BIGINT) AS page_limit, "
    f"CAST(CEIL(COUNT({k}) / {lim}) AS BIGINT) AS total_pages FROM {_PAGE_SOURCES[n]}"
    for n, k, lim in [(n, PRIMARY_KEYS[n], PAGE_LIMITS[n]) for n in ENTITIES]))
def page_counts(spark: SparkSession, d: str) -> DataFrame:
    from tidemark.plans import extracts as X
    lake = flow.fresh_lake(spark, d)
    out = None
    for n in ENTITIES:
        c = X.page_counts(lake.silver(n), n)
        out = c if out is None else out.unionByName(c)
    return out


def _dated_sql(view: str, name: str, date_col: str, limit: int) -> str:
    spec, key, other = _page_spec(name)
    order = ", ".join([f"{key} NULLS FIRST"] + [f"{c} NULLS FIRST" for c in other])
    return f"""
SELECT {sql_publish(cols(spec))}, dt, CAST((rn - 1) // {limit} + 1 AS BIGINT) AS page,
       CAST(CEIL(n / {limit}) AS BIGINT) AS total_pages, CAST((rn - 1) % {limit} + 1 AS BIGINT) AS row_in_page
FROM (SELECT *, STRFTIME(CAST({date_col} AS DATE), '%Y-%m-%d') AS dt,
             ROW_NUMBER() OVER (PARTITION BY CAST({date_col} AS DATE) ORDER BY {order}) AS rn,
             COUNT(*) OVER (PARTITION BY CAST({date_col} AS DATE)) AS n FROM {view})"""


@register("assign_pages", _dated_sql("f_order_status_log", "order_status_log", "changed_at", 50), text=MAY_LACK["order_status_log"])
def assign_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages of 50 status-log rows for every day, all days in one distributed rank."""
    from tidemark.plans.extracts import dated_pages
    logs = flow.fresh_lake(spark, d).silver("order_status_log").drop("commit_version")
    return dated_pages(logs, "order_status_log", "changed_at", 50)


@register("landing_extract", _dated_sql("f_orders", "orders", "order_date", 1000))
def landing_extract(spark: SparkSession, d: str) -> DataFrame:
    """Per business date, the pages (limit 1000) an extract of orders lands."""
    from tidemark.plans.extracts import dated_pages
    orders = flow.fresh_lake(spark, d).silver("orders").drop("commit_version")
    return dated_pages(orders, "orders", "order_date", 1000)


# =============================================================================================
# storage: commits, change feed, snapshots, MERGE, marks, landing, streaming

_WRITTEN: dict[tuple[str, str, str], str] = {}


def _written(spark: SparkSession, d: str, kind: str, build) -> str:
    """Write once per (application, scale dir) into the shared folder; later queries read it."""
    key = (spark.sparkContext.applicationId, d, kind)
    if key not in _WRITTEN:
        _WRITTEN[key] = build()
    return _WRITTEN[key]


def _orders_commits(spark: SparkSession, d: str) -> str:
    """Landed orders written as three commits of a bronze table."""
    from tidemark.session import scratch_path
    from tidemark.sources import lake as L

    def build() -> str:
        path = scratch_path(spark, "bronze-orders")
        landed = flow.landing_of(spark, d).landed("orders").accepted
        for v in range(3):
            L.commit_append(landed.filter(F.col("commit_version") == v), path, v)
        return path
    return _written(spark, d, "orders-commits", build)


@register("commit_append", f"SELECT {sql_publish(cols(SPEC['orders']))}, CAST(commit_version AS BIGINT) AS commit_version "
                          "FROM b_orders")
def commit_append(spark: SparkSession, d: str) -> DataFrame:
    """Three appended commits read back as one snapshot (commit_version per row)."""
    from tidemark.schemas import ORDERS
    from tidemark.sources import lake as L
    return L.read_table(spark, _orders_commits(spark, d), ORDERS)


_FEED_SQL = (f"SELECT {sql_publish(cols(SPEC['orders']))}, CAST(commit_version AS BIGINT) AS commit_version, "
             "'insert' AS _change_type, "
             "CAST(commit_version AS BIGINT) AS _commit_version FROM b_orders WHERE ")


@register("change_feed_bounded", _FEED_SQL + "commit_version BETWEEN 1 AND 1")
def change_feed_bounded(spark: SparkSession, d: str) -> DataFrame:
    """Change feed of commit [1, 1] (partition-pruned read)."""
    from tidemark.schemas import ORDERS
    from tidemark.sources import lake as L
    return L.change_feed(spark, _orders_commits(spark, d), ORDERS, 1, 1, with_metadata=True)


@register("change_feed_open", _FEED_SQL + "commit_version >= 1")
def change_feed_open(spark: SparkSession, d: str) -> DataFrame:
    """Change feed from commit 1 on (open-ended)."""
    from tidemark.schemas import ORDERS
    from tidemark.sources import lake as L
    return L.change_feed(spark, _orders_commits(spark, d), ORDERS, 1, None, with_metadata=True)


@register("snapshot_overwrite", f"SELECT {sql_publish(cols(DPS_SPEC))} FROM g_dps")
def snapshot_overwrite(spark: SparkSession, d: str) -> DataFrame:
    """Product-day partials appended per commit, compacted into a new snapshot, read back."""
    from tidemark.session import scratch_path
    from tidemark.sources import lake as L

    def build() -> str:
        lake = flow.fresh_lake(spark, d)
        orders, items, products = lake.silver("orders"), lake.silver("order_items"), lake.silver("products")
        parts_path, root = scratch_path(spark, "dps-partials"), scratch_path(spark, "dps")
        for v in range(3):
            p = G.product_day_partials(orders.filter(F.col("commit_version") == v), items, products)
            L.commit_append(p, parts_path, v)
        parts = L.read_table(spark, parts_path, p.schema)
        L.write_snapshot(G.compact_product_days(parts.drop(L.CV)), root, 0)
        return root
    return L.read_snapshot(spark, _written(spark, d, "dps-snapshot", build), 0)


# as-of time of each commit's upsert (the end of the commit's extract window)
UPSERT_AS_OF = ("1997-01-01 00:00:00", "1999-01-01 00:00:00", "2001-08-01 00:00:00")

_MERGE_SQL = f"""
SELECT {sql_publish(cols("a.customer_id, c.name, c.email, c.city, c.country, c.join_date:date, a.total_order_value:double, a.total_orders:bigint"))},
       CASE NTILE(4) OVER (ORDER BY a.total_order_value DESC, a.customer_id)
            WHEN 1 THEN 'Platinum' WHEN 2 THEN 'Gold' WHEN 3 THEN 'Silver' ELSE 'bronze' END AS customer_tier,
       STRFTIME(a.last_order_date, '%Y-%m-%d') AS last_order_date,
       CASE WHEN DATEDIFF('day', a.last_order_date, a.updated_at) > 30 THEN 'High'
            WHEN DATEDIFF('day', a.last_order_date, a.updated_at) > 15 THEN 'Medium' ELSE 'Low' END AS churn_risk_score,
       STRFTIME(a.updated_at, '%Y-%m-%d %H:%M:%S.%f') AS updated_at
FROM (SELECT g.*, CASE m.cv WHEN 0 THEN TIMESTAMP '{UPSERT_AS_OF[0]}' WHEN 1 THEN TIMESTAMP '{UPSERT_AS_OF[1]}'
                         ELSE TIMESTAMP '{UPSERT_AS_OF[2]}' END AS updated_at
      FROM g_cust_agg g JOIN (SELECT o.customer_id, MAX(s.commit_version) AS cv FROM f_orders o
                              JOIN s_order_commits s ON o.oid = s.oid GROUP BY o.customer_id) m
        ON g.customer_id = m.customer_id) a
LEFT JOIN f_customers c ON a.customer_id = c.customer_id"""


@register("merge_upsert", _MERGE_SQL)
def merge_upsert(spark: SparkSession, d: str) -> DataFrame:
    """customer_360 maintained commit by commit: MERGE (update 6 columns, insert all) into
    the previous snapshot, re-score, write the next snapshot. Customers untouched by a
    commit keep their earlier ``updated_at`` (and so their churn label)."""
    from tidemark.session import scratch_path
    from tidemark.sources import lake as L

    def build() -> str:
        lake = flow.fresh_lake(spark, d)
        orders, customers = lake.silver("orders"), lake.silver("customers")
        root = scratch_path(spark, "customer_360")
        for v in range(3):
            prev = L.read_snapshot(spark, root, v - 1)
            upto = orders.filter(F.col("commit_version") <= v).drop("commit_version")
            batch = orders.filter(F.col("commit_version") == v).drop("commit_version")
            mart = G.customer_360(prev, upto, batch, customers, flow.as_of_col(UPSERT_AS_OF[v]))
            L.write_snapshot(mart, root, v)
        return root
    return L.read_snapshot(spark, _written(spark, d, "c360-snapshots", build), 2)


@register("merge_update_only", f"""
SELECT {sql_publish(cols("g.customer_id, g.total_order_value:double, g.total_orders:bigint, g.last_order_date:date"))},
       COALESCE(s.customer_tier, 'None') AS customer_tier, COALESCE(s.churn_risk_score, 'None') AS churn_risk_score
FROM g_cust_agg g LEFT JOIN (
  SELECT t.customer_id, t.customer_tier, t.churn_risk_score FROM g_c360 t
  WHERE EXISTS (SELECT 1 FROM f_orders o JOIN s_order_commits c ON o.oid = c.oid
                WHERE c.commit_version = 2 AND o.customer_id = t.customer_id)) s ON g.customer_id = s.customer_id""")
def merge_update_only(spark: SparkSession, d: str) -> DataFrame:
    """Scores of the customers touched by the last commit MERGEd (update only) into the
    unscored aggregates; all other rows keep the placeholder."""
    from tidemark.operators.merge import merge_update_only as muo
    lake = flow.fresh_lake(spark, d)
    orders = lake.silver("orders")
    base = G.customer_aggregates(orders.drop("commit_version")).select(
        "customer_id", "total_order_value", "total_orders", "last_order_date",
        F.lit(G.PLACEHOLDER).alias("customer_tier"), F.lit(G.PLACEHOLDER).alias("churn_risk_score"))
    scored = flow.customer_360(lake)
    touched = G.affected_customers(scored, orders.filter(F.col("commit_version") == 2))
    return muo(base, touched.select("customer_id", "customer_tier", "churn_risk_score"), ["customer_id"],
               ["customer_tier", "churn_risk_score"])


@register("pending_versions", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, u.v AS upstream, s.v AS downstream, "
    "CASE WHEN u.v = s.v THEN 'up_to_date' WHEN s.v > u.v THEN 'conflict' ELSE 'pending' END AS status, "
    "CASE WHEN u.v > s.v THEN s.v + 1 END AS from_version, CASE WHEN u.v > s.v THEN u.v END AS to_version "
    f"FROM (SELECT CAST(MAX(commit_version) AS BIGINT) AS v FROM {_B[n]}) u, "
    f"(SELECT CAST(MAX(commit_version) AS BIGINT) AS v FROM {_B[n]} WHERE commit_version = 0) s"
    for n in ENTITIES))
def pending_versions(spark: SparkSession, d: str) -> DataFrame:
    """Landed commits each silver table still has to process (silver holds commit 0)."""
    from tidemark.sources import lake as L
    landing = flow.landing_of(spark, d)
    out = None
    for n in ENTITIES:
        acc = landing.landed(n).accepted
        up = acc.agg(F.max("commit_version").cast("bigint").alias("upstream"))
        down = acc.filter(F.col("commit_version") == 0).agg(F.max("commit_version").cast("bigint").alias("downstream"))
        row = up.select("upstream", down.select("downstream").scalar().alias("downstream"))
        row = row.select(F.lit(n).alias("table_name"), "upstream", "downstream",
                         *L.pending_versions(F.col("upstream"), F.col("downstream")))
        out = row if out is None else out.unionByName(row)
    return out


@register("landing_read", f"""
SELECT {sql_publish(cols(SPEC["customers"]))}, dt, CAST((rn - 1) // 500 + 1 AS BIGINT) AS page
FROM (SELECT *, STRFTIME(join_date, '%Y-%m-%d') AS dt,
             ROW_NUMBER() OVER (PARTITION BY join_date ORDER BY customer_id, name NULLS FIRST, email NULLS FIRST,
                                city NULLS FIRST, country NULLS FIRST, join_date NULLS FIRST) AS rn FROM b_customers)""")
def landing_read(spark: SparkSession, d: str) -> DataFrame:
    """Customers landed as dated JSON pages (dt=/page= layout), then read back with a
    declared schema: every landed date."""
    from tidemark.plans.silver import CUSTOMER_COLS
    from tidemark.session import scratch_path
    from tidemark.sources import landing as LD

    def build() -> str:
        path = scratch_path(spark, "landing-customers")
        LD.write_extract(flow.landing_of(spark, d).landed("customers").accepted.select(*CUSTOMER_COLS),
                         path, "customers", "join_date", 500)
        return path
    return LD.read_partitioned(spark, _written(spark, d, "landing-customers", build), "customers")


# ---- single pages of dated listings, through the index ---------------------------------------

_DAY_COLS = {"customers": "join_date", "products": "created_at", "orders": "order_date", "inventory": "last_restocked_at"}
#: One page per listing: (first day, last day, page, limit).
PAGES = {
    "customers": ("1995-02-01", "1995-02-01", 1, 3), "products": ("1995-03-05", "1995-03-05", 1, 4),
    "inventory": ("1997-06-03", "1997-06-03", 1, 5), "order_items": ("1995-05-02", "1995-05-02", 2, 10),
    "order_status_log": ("1995-06-20", "1995-06-20", 2, 10),
}
ORDER_PAGES = {"none": (None, None), "upto": (None, "1996-02-29"), "since": ("2000-06-01", None), "between": ("1996-03-01", "1997-03-01"), "crossed": ("1997-03-01", "1996-03-01")}
ORDER_PAGE, ORDER_LIMIT = 2, 150


def _one_page_sql(name: str, first: str | None, last: str | None, number: int, limit: int) -> str:
    spec, key, other = _page_spec(name)
    view = _PAGE_SOURCES[name]
    day = _DAY_COLS.get(name, "_day")
    if name not in _DAY_COLS:
        view = f"(SELECT c.*, o.order_date AS _day FROM {view} c JOIN (SELECT DISTINCT oid, order_date FROM f_orders) o ON c.order_id = o.oid)"
    bounds = [f"{day} {op} DATE '{d}'" for op, d in ((">=", first), ("<=", last)) if d]
    order = ", ".join([f"{key} NULLS FIRST"] + [f"{c} NULLS FIRST" for c in other])
    return f"""SELECT {sql_publish(cols(spec))}, CAST({number} AS BIGINT) AS page, CAST(CEIL(n / {limit}) AS BIGINT) AS total_pages,
       CAST(rn - {(number - 1) * limit} AS BIGINT) AS row_in_page
FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY {order}) AS rn, COUNT(*) OVER () AS n FROM {view} WHERE {" AND ".join(bounds) or "TRUE"})
WHERE rn BETWEEN {(number - 1) * limit + 1} AND {number * limit}"""


_INDEXES: dict[tuple[str, str, str], object] = {}


def _page_index(spark: SparkSession, d: str, name: str, by_day: bool):
    from tidemark.plans.extracts import page_index
    from tidemark.session import scratch_path
    key = (spark.sparkContext.applicationId, d, f"{name}-{by_day}")
    if key not in _INDEXES:
        lake = flow.fresh_lake(spark, d)
        dated_by = None if name in _DAY_COLS else lake.silver("orders")  # listings with a day of their own need no orders
        _INDEXES[key] = page_index(lake.silver(name).drop("commit_version"), name, scratch_path(spark, f"pages-{name}"), dated_by, by_day)
    return _INDEXES[key]


def _page_on(name: str):
    first, last, number, limit = PAGES[name]

    def q(spark: SparkSession, d: str) -> DataFrame:
        return _page_index(spark, d, name, True).page(number, limit, first, last)
    q.__doc__ = f"One page of the {name} of one day, read from the ranges that hold it."
    return q


for _n in PAGES:
    register(f"page_{_n}_on", _one_page_sql(_n, *PAGES[_n]), tuple(c for c in MAY_LACK[_n] if c != "product_id"))(_page_on(_n))


@register("page_orders_between", " UNION ALL ".join(f"SELECT '{case}' AS bounds, * FROM ({_one_page_sql('orders', *days, ORDER_PAGE, ORDER_LIMIT)})" for case, days in ORDER_PAGES.items()))
def page_orders_between(spark: SparkSession, d: str) -> DataFrame:
    """The second page of orders by key for each case of date bounds: none, upper, lower, both, and crossed ones (empty)."""
    index, out = _page_index(spark, d, "orders", False), None
    for case, days in ORDER_PAGES.items():
        part = index.page(ORDER_PAGE, ORDER_LIMIT, *days).select(F.lit(case).alias("bounds"), "*")
        out = part if out is None else out.unionByName(part)
    return out


# ---- extracts published by manifest --------------------------------------------------------

EXTRACT_DAYS = ("1995-05-01", "1995-06-30")
EXTRACT_LIMIT = 20
_KEYS = {"customers": ("customer_id", "NULL", "name"), "products": ("pid", "NULL", "product_name"),
         "orders": ("oid", "customer_id", "order_status"), "order_items": ("order_item_id", "order_id", "product_id"),
         "inventory": ("inventory_id", "product_id", "warehouse_location"), "order_status_log": ("log_id", "order_id", "new_status")}
_SOURCE_VIEWS = {"customers": "s_customers", "products": "s_products", "orders": "s_orders", "order_items": "s_items",
                 "inventory": "s_inventory", "order_status_log": "s_logs"}


def _extract_rows_sql() -> str:
    first, last = EXTRACT_DAYS
    parts = []
    for name, (key, ref, label) in _KEYS.items():
        if name in _DAY_COLS:
            rel, day = _SOURCE_VIEWS[name], _DAY_COLS[name]
        else:  # children take the days of their orders
            rel, day = (f"{_SOURCE_VIEWS[name]} c JOIN (SELECT DISTINCT oid, order_date AS _day FROM s_orders) o ON c.order_id = o.oid"), "_day"
        parts.append(f"SELECT '{name}' AS table_name, STRFTIME({day}, '%Y-%m-%d') AS dt, {key} AS row_key, CAST({ref} AS BIGINT) AS ref_key, "
                     f"CAST({label} AS VARCHAR) AS label FROM {rel} WHERE {day} BETWEEN DATE '{first}' AND DATE '{last}'")
    return " UNION ALL ".join(parts)


def _extracted(spark: SparkSession, d: str) -> str:
    """All six tables of ``EXTRACT_DAYS``, extracted out of the source views and published."""
    from tidemark.session import scratch_path
    from tidemark.sources import landing as LD

    def build() -> str:
        root = scratch_path(spark, "landing")
        LD.run_extract(spark, {n: commerce.view(spark, d, n) for n in ENTITIES}, root, *EXTRACT_DAYS, limits={n: EXTRACT_LIMIT for n in ENTITIES})
        return root
    return _written(spark, d, "extract", build)


@register("extract_days", _extract_rows_sql(), text=("row_key", "ref_key"))
def extract_days(spark: SparkSession, d: str) -> DataFrame:
    """The dated extract of all six tables (items and logs dated by their order), read back from its JSON arrays."""
    from tidemark.sources import landing as LD
    root, out = _extracted(spark, d), None
    for name, (key, ref, label) in _KEYS.items():
        rows = LD.read_landed(spark, root, name, *EXTRACT_DAYS)
        part = rows.select(F.lit(name).alias("table_name"), "dt", F.col(key).alias("row_key"),
                           (F.lit(None) if ref == "NULL" else F.col(ref)).cast("bigint").alias("ref_key"), F.col(label).cast("string").alias("label"))
        out = part if out is None else out.unionByName(part)
    return out


@register("extract_manifest", f"""
SELECT table_name, dt, page, COUNT(*) AS rows FROM (
  SELECT table_name, dt, CAST((ROW_NUMBER() OVER (PARTITION BY table_name, dt) - 1) // {EXTRACT_LIMIT} + 1 AS BIGINT) AS page FROM ({_extract_rows_sql()}))
GROUP BY table_name, dt, page""")
def extract_manifest(spark: SparkSession, d: str) -> DataFrame:
    """What the extract published: pages of each table and day with their rows, days without rows left out."""
    from tidemark.sources import landing as LD
    return LD.read_manifest(spark, _extracted(spark, d), *EXTRACT_DAYS).where("path is not null").select("table_name", "dt", "page", "rows")


@register("landing_arrays", f"""
SELECT oid, customer_id, STRFTIME(order_date, '%Y-%m-%d') AS order_date, order_status, 'main' AS sink, CAST(NULL AS VARCHAR) AS reason
FROM s_orders WHERE oid IS NOT NULL AND order_date BETWEEN DATE '{EXTRACT_DAYS[0]}' AND DATE '{EXTRACT_DAYS[1]}'
UNION ALL SELECT oid, customer_id, STRFTIME(order_date, '%Y-%m-%d'), order_status, 'quarantine', 'null_key'
FROM s_orders WHERE oid IS NULL AND order_date BETWEEN DATE '{EXTRACT_DAYS[0]}' AND DATE '{EXTRACT_DAYS[1]}'
UNION ALL SELECT NULL, NULL, NULL, NULL, 'quarantine', 'corrupt_record'""", text=("oid", "customer_id"))
def landing_arrays(spark: SparkSession, d: str) -> DataFrame:
    """Landed JSON arrays of orders, one page of them cut off half way as a broken transfer leaves it, split for bronze."""
    from tidemark.plans import bronze as B
    from tidemark.session import scratch_path
    from tidemark.sources import landing as LD

    def build() -> str:
        root = scratch_path(spark, "landing-broken")
        LD.run_extract(spark, {"orders": commerce.view(spark, d, "orders")}, root, *EXTRACT_DAYS)
        sent = LD.read_manifest(spark, root, *EXTRACT_DAYS)
        page = sent.where("path is not null").orderBy("dt").first()
        half = scratch_path(spark, "half-page")
        whole = spark.read.text(page["path"], wholetext=True)
        whole.select(F.expr("substring(value, 1, length(value) div 2)")).write.text(half)
        broken = LD.files_of(spark, half).select(F.lit("orders").alias("table_name"), F.lit(page["dt"]).alias("dt"), F.lit(page["page"] + 1000).alias("page"), F.lit(None).cast("bigint").alias("rows"), "path", "bytes")
        LD.publish(spark, root, sent.where(F.col("dt") == page["dt"]).drop("attempt").unionByName(broken), [page["dt"]])
        return root
    root = _written(spark, d, "landing-broken", build)
    routed = B.split(LD.read_landed(spark, root, "orders", *EXTRACT_DAYS), "orders")
    return routed.select("oid", "customer_id", "order_date", "order_status", "sink", "reason")


@register("streaming_silver_orders", f"SELECT {sql_publish(cols(SPEC['orders']))} FROM f_orders")
def streaming_silver_orders(spark: SparkSession, d: str) -> DataFrame:
    """Bronze orders commits cleaned by an availableNow stream (one micro-batch per run),
    silver references read as snapshots inside foreachBatch; result read back."""
    from tidemark.plans import silver as S
    from tidemark.schemas import ORDERS
    from tidemark.session import scratch_path
    from tidemark.sources import lake as L
    from tidemark.streaming.incremental import clean_edge

    def build() -> str:
        lake = flow.fresh_lake(spark, d)
        customers, items = lake.silver("customers"), lake.silver("order_items")
        silver_path = scratch_path(spark, "silver-orders")
        clean_edge(spark, _orders_commits(spark, d), silver_path, ORDERS,
                   lambda b, before: S.silver_orders(b, before, customers, items),
                   scratch_path(spark, "stream-ckpt"))
        return silver_path
    from tidemark.plans.pipeline import SILVER_SCHEMAS
    return L.read_table(spark, _written(spark, d, "stream-silver-orders", build), SILVER_SCHEMAS["orders"]).drop(L.CV)


@register("streaming_status_transitions", _TRANSITIONS)
def streaming_status_transitions(spark: SparkSession, d: str) -> DataFrame:
    """The same from a stream over the landed log's commits, which keeps the orders' histories as state."""
    from tidemark.session import scratch_path
    from tidemark.sources import lake as L
    from tidemark.streaming.order_history import OrderHistory, follow

    def build() -> str:
        landed = flow.landing_of(spark, d).landed("order_status_log").accepted
        path, root = scratch_path(spark, "bronze-logs"), scratch_path(spark, "order-history")
        for r in landed.select(L.CV).distinct().orderBy(L.CV).collect():  # commits, not rows
            L.commit_append(landed.filter(F.col(L.CV) == r[0]), path, r[0])
        follow(spark, path, OrderHistory(spark, root), scratch_path(spark, "stream-ckpt"))
        return root
    return OrderHistory(spark, _written(spark, d, "order-history", build)).transitions()
