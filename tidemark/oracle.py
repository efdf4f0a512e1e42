"""Independent SQL statement of every registered query (DuckDB dialect, ANSI where possible).

Used only to check the Spark plans: the driver runs each string against the raw tables.
Conventions shared with the Spark side: dates and timestamps are published as strings,
money as double (summed exactly as decimals first), counts as bigint. Spark rounds
decimals half up; DuckDB divides decimals in floating point, so exact half-up means are
written here with integer arithmetic (``hu``).
"""

from __future__ import annotations


def hu(num: str, num_scale: int, den: str, out_scale: int) -> str:
    """Exact round_half_up(num / den, out_scale) as DECIMAL(38, out_scale).

    ``num`` is a decimal of scale <= out_scale; the quotient is formed on integers
    (num * 10^num_scale * 10^(out_scale-num_scale) / den), rounded half up, then scaled.
    """
    n = f"CAST(({num}) * {10 ** num_scale} AS HUGEINT)"
    k = 10 ** (out_scale - num_scale)
    q = f"(SIGN({n}) * ((ABS({n}) * {2 * k} + ({den})) // (2 * ({den}))))"
    if out_scale == 0:
        return f"CAST({q} AS DECIMAL(38,0))"
    unit = "0." + "0" * (out_scale - 1) + "1"
    return f"CAST(CAST({q} AS DECIMAL(30,0)) * CAST('{unit}' AS DECIMAL({out_scale + 1},{out_scale})) AS DECIMAL(38,{out_scale}))"


hu_dec = hu


def commit_case(day: str, first: str, second: str) -> str:
    return f"CASE WHEN {day} < DATE '{first}' THEN 0 WHEN {day} < DATE '{second}' THEN 1 ELSE 2 END"


# ---- commerce views (same mapping as tidemark.sources.commerce) -----------------------------

VIEWS: dict[str, str] = {}

VIEWS["s_customers"] = f"""
SELECT CAST(CASE WHEN c.c_acctbal < -700 THEN NULL ELSE c.c_custkey END AS BIGINT) AS customer_id, c.c_name AS name, CAST(NULL AS VARCHAR) AS email,
       p.n_name AS city, p.r_name AS country,
       CAST(DATE '1995-01-01' + CAST(c.c_custkey % 365 AS INTEGER) AS DATE) AS join_date,
       {commit_case("CAST(DATE '1995-01-01' + CAST(c.c_custkey % 365 AS INTEGER) AS DATE)", '1995-05-01', '1995-09-01')} AS commit_version
FROM customer c
LEFT JOIN (SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey) p
  ON c.c_nationkey = p.n_nationkey"""

VIEWS["s_products"] = f"""
SELECT CAST(CASE WHEN p_size = 50 THEN NULL ELSE p_partkey END AS BIGINT) AS pid, p_name AS product_name, p_type AS category,
       CAST(p_size AS VARCHAR) AS sub_category, p_brand AS brand, CAST(p_retailprice AS DOUBLE) AS base_price,
       CAST(p_size % 5 AS DOUBLE) * 2.5 AS discount_pct, CAST(p_size - 2 AS BIGINT) AS current_stock,
       CAST(NULL AS VARCHAR) AS supplier,
       CAST(DATE '1995-01-01' + CAST(p_partkey % 365 AS INTEGER) AS DATE) AS created_at,
       {commit_case("CAST(DATE '1995-01-01' + CAST(p_partkey % 365 AS INTEGER) AS DATE)", '1995-05-01', '1995-09-01')} AS commit_version
FROM part CROSS JOIN (VALUES (0), (1)) t(again) WHERE again = 0 OR p_size = 25"""

VIEWS["s_orders"] = f"""
SELECT CAST(CASE WHEN o_totalprice < 5000 THEN NULL ELSE o_orderkey END AS BIGINT) AS oid, CAST(o_custkey AS BIGINT) AS customer_id,
       CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS order_status,
       o_orderpriority AS payment_method, CAST(NULL AS VARCHAR) AS shipping_address,
       CAST(0.0 AS DOUBLE) AS total_amount, CAST(0.0 AS DOUBLE) AS discount_applied, CAST(0.0 AS DOUBLE) AS final_amount,
       {commit_case("CAST(o_orderdate AS DATE)", '1997-01-01', '1999-01-01')} AS commit_version
FROM orders CROSS JOIN (VALUES (0), (1)) t(again) WHERE again = 0 OR (o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')"""

# which commit an order came with (its row may have come twice)
VIEWS["s_order_commits"] = "SELECT DISTINCT oid, commit_version FROM s_orders WHERE oid IS NOT NULL"

_PCT = "CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS DECIMAL(5,2))"
_GROSS = "CAST(l_extendedprice AS DECIMAL(12,2))"
_UNIT = f"""CAST({hu_dec(_GROSS, 2, "CAST(l_quantity AS BIGINT)", 2)} AS DECIMAL(12,2))"""
_SPOILT = "(l_returnflag = 'A' AND l_quantity = 3 AND l_discount < 0.005)"
_PRICE = f"CASE WHEN {_SPOILT} THEN CAST(-1 AS DECIMAL(12,2)) ELSE {_UNIT} END"
_QTY = f"CAST(CASE WHEN {_SPOILT} THEN -1 WHEN l_returnflag = 'R' AND l_quantity = 2 THEN 0 ELSE l_quantity END AS BIGINT)"
VIEWS["s_items"] = f"""
SELECT CAST(CASE WHEN l_returnflag = 'R' AND l_quantity = 1 THEN NULL ELSE l_orderkey * 8 + l_linenumber END AS BIGINT) AS order_item_id,
       CAST(CASE WHEN l_returnflag IN ('R', 'A') AND l_quantity = 1 AND l_tax > 0.07 THEN NULL ELSE l_orderkey END AS BIGINT) AS order_id,
       CAST(l_partkey AS BIGINT) AS product_id, {_QTY} AS quantity,
       {_PRICE} AS unit_price_at_order,
       CASE WHEN {_SPOILT} THEN CAST(-1 AS DECIMAL(5,2)) ELSE {_PCT} END AS discount_at_order,
       CAST(ROUND({_GROSS} * (100 - {_PCT}) * CAST(0.01 AS DECIMAL(3,2)), 2) AS DECIMAL(12,2)) AS line_total,
       CAST(({_PRICE}) * {_QTY} AS DECIMAL(12,2)) AS gross_amount,
       COALESCE((SELECT {commit_case("CAST(o.o_orderdate AS DATE)", '1997-01-01', '1999-01-01')}
                 FROM orders o WHERE o.o_orderkey = l_orderkey), 0) AS commit_version
FROM lineitem"""

VIEWS["s_inventory"] = f"""
SELECT CAST(l_partkey AS BIGINT) * 1000000000 + l_suppkey AS inventory_id, CAST(CASE WHEN SUM(l_quantity) = 9 THEN NULL ELSE l_partkey END AS BIGINT) AS product_id,
       n.n_name AS warehouse_location, CAST(SUM(l_quantity) AS BIGINT) - 5 AS quantity_on_hand,
       CAST(20 AS BIGINT) AS reorder_threshold, MAX(CAST(l_shipdate AS DATE)) AS last_restocked_at,
       {commit_case("MAX(CAST(l_shipdate AS DATE))", '1997-01-01', '1999-01-01')} AS commit_version
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation n ON s_nationkey = n.n_nationkey
GROUP BY l_partkey, l_suppkey, n.n_name"""

_STATE = ("CASE event_type WHEN 'signup' THEN 'pending' WHEN 'view' THEN 'confirmed' WHEN 'click' THEN 'shipped' "
          "WHEN 'purchase' THEN 'delivered' WHEN 'error' THEN 'cancelled' END")
VIEWS["s_logs"] = f"""
SELECT CAST(CASE WHEN value < 0.5 OR (CAST(ts AS DATE) >= DATE '2024-01-11' AND CAST(ts AS DATE) < DATE '2024-01-21'
                                      AND event_type IN ('click', 'error')) THEN NULL ELSE event_id END AS BIGINT) AS log_id,
       CAST(CASE WHEN value < 0.1 THEN NULL ELSE user_id END AS BIGINT) AS order_id,
       LAG({_STATE}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS old_status,
       {_STATE} AS new_status, ts AS changed_at, CAST(NULL AS VARCHAR) AS changed_by, props AS remarks,
       {commit_case("CAST(ts AS DATE)", '2024-01-11', '2024-01-21')} AS commit_version
FROM events"""

# ---- bronze (gate: reject when bad >= 30 %, products when bad > 30 %) -------------------------

_BRONZE_RULES = {
    # name: (source view, valid predicate, invalid predicate, strict)
    "b_customers": ("s_customers", "customer_id IS NOT NULL", "customer_id IS NULL", False),
    "b_products": ("s_products", "pid IS NOT NULL", "pid IS NULL", True),
    "b_orders": ("s_orders", "oid IS NOT NULL", "oid IS NULL", False),
    "b_items": ("s_items", "(order_item_id IS NOT NULL OR order_id IS NOT NULL)",
                "(order_item_id IS NULL OR order_id IS NULL)", False),
    "b_logs": ("s_logs", "(log_id IS NOT NULL OR order_id IS NOT NULL)",
               "(log_id IS NULL AND order_id IS NOT NULL)", False),
    "b_inventory": ("s_inventory", "(inventory_id IS NOT NULL AND product_id IS NOT NULL)",
                    "(inventory_id IS NULL OR product_id IS NULL)", False),
}


def _gate(src: str, invalid: str, strict: bool) -> str:
    """The commits whose batch passes its gate."""
    op = "<=" if strict else "<"
    return (f"commit_version IN (SELECT commit_version FROM {src} GROUP BY commit_version "
            f"HAVING COUNT(*) FILTER (WHERE {invalid}) {op} CAST(COUNT(*) AS DECIMAL(20,0)) * 0.3)")


for _name, (_src, _valid, _invalid, _strict) in _BRONZE_RULES.items():
    VIEWS[_name] = f"SELECT * FROM {_src} WHERE {_valid} AND {_gate(_src, _invalid, _strict)}"
    VIEWS[_name + "_q"] = f"SELECT *, 'null_key' AS reason FROM {_src} WHERE {_invalid} AND {_gate(_src, _invalid, _strict)}"

# ---- silver, fresh flow (all commits as one batch into an empty lake) -----------------------

CUST_COLS = "customer_id, name, email, city, country, join_date"
PROD_COLS = "pid, product_name, category, sub_category, brand, base_price, discount_pct, current_stock, supplier, created_at"
ITEM_COLS = "order_item_id, order_id, product_id, quantity, unit_price_at_order, discount_at_order, line_total, gross_amount"
ORDER_COLS = "oid, customer_id, order_date, order_status, payment_method, shipping_address, total_amount, discount_applied, final_amount"
INV_COLS = "inventory_id, product_id, warehouse_location, quantity_on_hand, reorder_threshold, last_restocked_at"
LOG_COLS = "log_id, order_id, old_status, new_status, changed_at, changed_by, remarks"


def silver_sql(prefix: str, batch: dict[str, str], before: dict[str, str] | None) -> dict[str, str]:
    """CTEs for one silver step. ``batch[name]`` = bronze batch view; ``before`` = silver
    before the batch (None → empty lake). Names: {prefix}_customers, ..._q (quarantine)."""
    v: dict[str, str] = {}
    p = prefix

    def anti(rel: str, key: str, name: str) -> str:
        if not before:
            return rel
        return f"SELECT * FROM ({rel}) x WHERE NOT EXISTS (SELECT 1 FROM {before[name]} s WHERE s.{key} = x.{key})"

    def semi(rel: str, key: str, name: str) -> str:
        return f"SELECT * FROM ({rel}) x WHERE EXISTS (SELECT 1 FROM {before[name]} s WHERE s.{key} = x.{key})"

    def silver_of(name: str) -> str:
        acc = f"{p}_{name}"
        if not before:
            return acc
        return f"(SELECT * FROM {before[name]} UNION ALL SELECT * FROM {acc})"

    users = (f"SELECT {CUST_COLS} FROM (SELECT {CUST_COLS}, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY "
             f"commit_version NULLS FIRST, name NULLS FIRST, email NULLS FIRST, city NULLS FIRST, country NULLS FIRST, join_date NULLS FIRST) AS rn "
             f"FROM {batch['customers']}) WHERE rn = 1")
    v[f"{p}_users"] = users
    v[f"{p}_customers"] = anti(f"SELECT * FROM {p}_users", "customer_id", "customers")
    loaded = "SELECT *, 'already_loaded' AS reason FROM"
    v[f"{p}_customers_q"] = (f"{loaded} ({semi(f'SELECT * FROM {p}_users', 'customer_id', 'customers')})" if before
                             else f"{loaded} {p}_users WHERE FALSE")

    prods = f"SELECT DISTINCT {PROD_COLS} FROM {batch['products']}"
    v[f"{p}_prods"] = prods
    v[f"{p}_products"] = (
        "SELECT pid, COALESCE(product_name, 'N/A') AS product_name, COALESCE(category, 'N/A') AS category, "
        "COALESCE(sub_category, 'N/A') AS sub_category, COALESCE(brand, 'N/A') AS brand, base_price, discount_pct, "
        "current_stock, COALESCE(supplier, 'N/A') AS supplier, created_at "
        f"FROM ({anti(f'SELECT * FROM {p}_prods', 'pid', 'products')}) WHERE base_price > 0 AND current_stock >= 0")
    v[f"{p}_products_q"] = (f"{loaded} ({semi(f'SELECT * FROM {p}_prods', 'pid', 'products')})" if before
                            else f"{loaded} {p}_prods WHERE FALSE")
    products = silver_of("products")

    v[f"{p}_items_valid"] = (
        f"SELECT {ITEM_COLS} FROM {batch['order_items']} i WHERE EXISTS (SELECT 1 FROM {products} pp WHERE pp.pid = i.product_id) "
        "AND (quantity > 0 OR unit_price_at_order > 0 OR discount_at_order >= 0)")
    v[f"{p}_order_items"] = anti(f"SELECT * FROM {p}_items_valid", "order_item_id", "order_items")
    rejected_items = (
        f"SELECT {ITEM_COLS}, CASE WHEN EXISTS (SELECT 1 FROM {products} pp WHERE pp.pid = i.product_id) THEN 'bad_number' ELSE 'unknown_product' END AS reason "
        f"FROM {batch['order_items']} i WHERE NOT EXISTS (SELECT 1 FROM {products} pp WHERE pp.pid = i.product_id) "
        "OR quantity <= 0 OR unit_price_at_order <= 0 OR discount_at_order < 0")
    v[f"{p}_order_items_q"] = rejected_items + (
        f" UNION ALL {loaded} ({semi(f'SELECT * FROM {p}_items_valid', 'order_item_id', 'order_items')})" if before else "")
    items = silver_of("order_items")
    customers = silver_of("customers")

    v[f"{p}_ord_batch"] = f"SELECT DISTINCT {ORDER_COLS} FROM {batch['orders']}"
    v[f"{p}_totals"] = (
        f"SELECT order_id AS oid, CAST(SUM(gross_amount) AS DECIMAL(18,2)) AS total_amount, "
        f"{hu_dec('SUM(discount_at_order)', 2, 'COUNT(discount_at_order)', 6)} AS discount_applied, "
        f"CAST(SUM(line_total) AS DECIMAL(18,2)) AS final_amount FROM {items} it "
        f"WHERE it.order_id IN (SELECT oid FROM {p}_ord_batch) GROUP BY order_id")
    joined = (
        "SELECT o.oid, o.customer_id, CAST(o.order_date AS DATE) AS order_date, "
        "COALESCE(o.order_status, 'Unknown') AS order_status, COALESCE(o.payment_method, 'Unknown') AS payment_method, "
        "COALESCE(o.shipping_address, 'Unknown') AS shipping_address, t.total_amount, t.discount_applied, t.final_amount "
        f"FROM {p}_ord_batch o JOIN {p}_totals t ON o.oid = t.oid "
        f"WHERE EXISTS (SELECT 1 FROM {customers} c WHERE c.customer_id = o.customer_id)")
    v[f"{p}_orders"] = anti(joined, "oid", "orders")
    def why(*cases: tuple[str, str]) -> str:
        return "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for c, r in cases) + " END AS reason"

    def missing(rel: str, key: str, col: str) -> str:
        return f"NOT EXISTS (SELECT 1 FROM {rel} k WHERE k.{key} = b.{col})"

    v[f"{p}_orders_q"] = (f"SELECT *, {why((missing(customers, 'customer_id', 'customer_id'), 'unknown_customer'), (missing(f'{p}_totals', 'oid', 'oid'), 'no_items'), ('TRUE', 'already_loaded'))} "
                          f"FROM {p}_ord_batch b WHERE NOT EXISTS "
                          f"(SELECT 1 FROM {p}_orders a WHERE a.oid = b.oid)")
    orders = silver_of("orders")

    inv_main = (
        f"SELECT inventory_id, product_id, COALESCE(warehouse_location, 'N/A') AS warehouse_location, quantity_on_hand, "
        f"reorder_threshold, CAST(last_restocked_at AS DATE) AS last_restocked_at FROM {batch['inventory']} i "
        f"WHERE EXISTS (SELECT 1 FROM {products} pp WHERE pp.pid = i.product_id) "
        "AND quantity_on_hand >= 0 AND reorder_threshold >= 0")
    v[f"{p}_inventory"] = anti(inv_main, "inventory_id", "inventory")
    v[f"{p}_inventory_q"] = (f"SELECT {INV_COLS}, {why((missing(products, 'pid', 'product_id'), 'unknown_product'), ('NOT COALESCE(quantity_on_hand >= 0 AND reorder_threshold >= 0, FALSE)', 'bad_number'), ('TRUE', 'already_loaded'))} FROM {batch['inventory']} b WHERE NOT EXISTS "
                             f"(SELECT 1 FROM {p}_inventory a WHERE a.inventory_id = b.inventory_id)")

    log_main = (
        "SELECT log_id, order_id, COALESCE(old_status, 'Unknown') AS old_status, COALESCE(new_status, 'Unknown') AS new_status, "
        "CAST(changed_at AS TIMESTAMP) AS changed_at, COALESCE(changed_by, 'Unknown') AS changed_by, "
        f"COALESCE(remarks, 'N/A') AS remarks FROM {batch['order_status_log']} l "
        f"WHERE EXISTS (SELECT 1 FROM {orders} o WHERE o.oid = l.order_id)")
    v[f"{p}_order_status_log"] = anti(log_main, "log_id", "order_status_log")
    v[f"{p}_order_status_log_q"] = (f"SELECT {LOG_COLS}, {why((missing(orders, 'oid', 'order_id'), 'unknown_order'), ('log_id IS NULL', 'null_key'), ('TRUE', 'already_loaded'))} FROM {batch['order_status_log']} b WHERE NOT EXISTS "
                                    f"(SELECT 1 FROM {p}_order_status_log a WHERE a.log_id = b.log_id)")
    return v


_BRONZE = {"customers": "b_customers", "products": "b_products", "orders": "b_orders",
           "order_items": "b_items", "inventory": "b_inventory", "order_status_log": "b_logs"}

# fresh: everything as one batch into an empty lake
VIEWS.update(silver_sql("f", _BRONZE, None))
# replay: silver holds commit 0; the whole landed history arrives again
VIEWS.update({f"c0_{k}": f"SELECT * FROM {v} WHERE commit_version = 0" for k, v in _BRONZE.items()})
VIEWS.update(silver_sql("z", {k: f"c0_{k}" for k in _BRONZE}, None))
VIEWS.update(silver_sql("r", _BRONZE, {
    "customers": "z_customers", "products": "z_products", "order_items": "z_order_items",
    "orders": "z_orders", "inventory": "z_inventory", "order_status_log": "z_order_status_log"}))

# ---- gold over the fresh lake ---------------------------------------------------------------

VIEWS["g_dps"] = """
SELECT p.pid, p.product_name, p.category, p.sub_category, p.brand, p.base_price, d.order_date,
       d.sales_count, d.total_sales_amount
FROM (SELECT i.product_id, o.order_date, CAST(SUM(i.quantity) AS BIGINT) AS sales_count,
             CAST(SUM(i.gross_amount) AS DECIMAL(28,2)) AS total_sales_amount
      FROM f_order_items i JOIN f_orders o ON i.order_id = o.oid GROUP BY i.product_id, o.order_date) d
JOIN f_products p ON d.product_id = p.pid"""

VIEWS["g_lines"] = """
SELECT i.order_id, i.product_id, i.line_total, o.customer_id, p.category, p.product_name
FROM f_order_items i JOIN f_orders o ON i.order_id = o.oid JOIN f_products p ON i.product_id = p.pid"""

VIEWS["g_cust_agg"] = """
SELECT customer_id, CAST(SUM(final_amount) AS DECIMAL(18,2)) AS total_order_value, COUNT(oid) AS total_orders,
       MAX(order_date) AS last_order_date
FROM f_orders GROUP BY customer_id"""

VIEWS["g_rev"] = """
SELECT category, product_name, CAST(ROUND(SUM(line_total), 2) AS DECIMAL(28,2)) AS top_product_revenue
FROM g_lines GROUP BY category, product_name"""

VIEWS["g_top"] = """
SELECT * FROM (SELECT *, DENSE_RANK() OVER (PARTITION BY category ORDER BY top_product_revenue DESC) AS rk FROM g_rev)
WHERE rk = 1"""

VIEWS["g_means"] = f"""
SELECT category, MAX(order_date) AS date,
       {hu_dec('SUM(total_sales_amount)', 2, 'COUNT(total_sales_amount)', 2)} AS daily_revenue,
       {hu_dec('SUM(sales_count)', 0, 'COUNT(sales_count)', 0)} AS daily_orders
FROM g_dps GROUP BY category"""

VIEWS["g_uniq"] = "SELECT category, COUNT(DISTINCT customer_id) AS unique_customers FROM g_lines GROUP BY category"

VIEWS["g_c360"] = """
SELECT a.customer_id, c.name, c.email, c.city, c.country, c.join_date, a.total_order_value, a.total_orders,
       CASE NTILE(4) OVER (ORDER BY a.total_order_value DESC, a.customer_id ASC)
            WHEN 1 THEN 'Platinum' WHEN 2 THEN 'Gold' WHEN 3 THEN 'Silver' ELSE 'bronze' END AS customer_tier,
       a.last_order_date,
       CASE WHEN DATEDIFF('day', a.last_order_date, TIMESTAMP '2001-08-01 00:00:00') > 30 THEN 'High'
            WHEN DATEDIFF('day', a.last_order_date, TIMESTAMP '2001-08-01 00:00:00') > 15 THEN 'Medium'
            ELSE 'Low' END AS churn_risk_score,
       TIMESTAMP '2001-08-01 00:00:00' AS updated_at
FROM g_cust_agg a LEFT JOIN f_customers c ON a.customer_id = c.customer_id"""

VIEWS["g_perf"] = """
SELECT *,
  LAG(total_sales_amount, 1, 0) OVER w AS prev_day_sales,
  LAG(sales_count, 1, 0) OVER w AS prev_day_order_cnt,
  ROUND(SUM(total_sales_amount) OVER (PARTITION BY pid ORDER BY order_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 2) AS last_7_day_sales,
  ROUND(SUM(total_sales_amount) OVER (PARTITION BY pid), 2) AS overall_sales,
  ROUND(SUM(total_sales_amount) OVER (PARTITION BY pid ORDER BY order_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS rolling_total
FROM g_dps WINDOW w AS (PARTITION BY pid ORDER BY order_date)"""

# Each view lists the views it reads, so a query only carries the CTEs it needs.
_DEPS: dict[str, list[str]] = {}


def _deps_of(name: str) -> list[str]:
    if name not in _DEPS:
        body = VIEWS[name]
        found = []
        import re
        for other in VIEWS:
            if other != name and re.search(rf"\b{re.escape(other)}\b", body):
                found.append(other)
        _DEPS[name] = found
    return _DEPS[name]


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the CTEs it (transitively) references, in dependency order."""
    import re
    order: list[str] = []
    seen: set[str] = set()

    def visit(n: str) -> None:
        if n in seen:
            return
        seen.add(n)
        for d in _deps_of(n):
            visit(d)
        order.append(n)

    for n in VIEWS:
        if re.search(rf"\b{re.escape(n)}\b", sql):
            visit(n)
    if not order:
        return sql
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in order)
    return f"WITH {ctes}\n{sql}"
