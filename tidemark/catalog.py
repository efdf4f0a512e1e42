"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the given tables (through the commerce views) in full. Its oracle SQL
(DuckDB) sits next to it. Results are published with strings for dates/timestamps,
doubles for money and bigints for counts so both engines compare value for value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.oracle import with_views

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None, text: tuple[str, ...] = ()):
    """Register a query and its oracle SQL. ``text``: ids that may be missing in the result, published as strings (a
    missing whole number has no one form in the frames that the two engines' results are compared as)."""
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = publish(fn(spark, sf_dir))
            return out.withColumns({c: F.col(c).cast("string") for c in text}) if text else out
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            casts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in text)
            ORACLE[key] = with_views(f"SELECT * REPLACE ({casts}) FROM ({sql}) AS published" if text else sql)
        return run
    return deco


def publish(df: DataFrame) -> DataFrame:
    """Dates/timestamps → ISO strings, decimals → double, small ints → bigint."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(t, T.DecimalType):
            c = c.cast("double")
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def sql_publish(cols: list[tuple[str, str]]) -> str:
    """SELECT list that mirrors :func:`publish` for the oracle: (expr, kind) pairs."""
    out = []
    for expr, kind in cols:
        name = expr.split(".")[-1]
        if kind == "date":
            out.append(f"STRFTIME({expr}, '%Y-%m-%d') AS {name}")
        elif kind == "ts":
            out.append(f"STRFTIME({expr}, '%Y-%m-%d %H:%M:%S.%f') AS {name}")
        elif kind == "double":
            out.append(f"CAST({expr} AS DOUBLE) AS {name}")
        elif kind == "bigint":
            out.append(f"CAST({expr} AS BIGINT) AS {name}")
        else:
            out.append(f"{expr} AS {name}")
    return ", ".join(out)


def cols(spec: str) -> list[tuple[str, str]]:
    """'a:date, b, c:double' → [(a, date), (b, ''), (c, double)]"""
    out = []
    for part in spec.split(","):
        part = part.strip()
        if not part:
            continue
        name, _, kind = part.partition(":")
        out.append((name.strip(), kind.strip()))
    return out


# Published column specs of the entity tables (shared by several queries).
CUSTOMER_SPEC = "customer_id, name, email, city, country, join_date:date"
PRODUCT_SPEC = ("pid, product_name, category, sub_category, brand, base_price, discount_pct, current_stock, "
                "supplier, created_at:date")
ITEM_SPEC = ("order_item_id, order_id, product_id, quantity, unit_price_at_order:double, discount_at_order:double, "
             "line_total:double, gross_amount:double")
ORDER_SPEC = ("oid, customer_id, order_date:date, order_status, payment_method, shipping_address, "
              "total_amount:double, discount_applied:double, final_amount:double")
INVENTORY_SPEC = ("inventory_id, product_id, warehouse_location, quantity_on_hand, reorder_threshold, "
                  "last_restocked_at:date")
LOG_SPEC = "log_id, order_id, old_status, new_status, changed_at:ts, changed_by, remarks"
SPEC = {"customers": CUSTOMER_SPEC, "products": PRODUCT_SPEC, "order_items": ITEM_SPEC, "orders": ORDER_SPEC,
        "inventory": INVENTORY_SPEC, "order_status_log": LOG_SPEC}


def load_all() -> None:
    """Import the modules that register queries."""
    from tidemark.plans import queries  # noqa: F401
