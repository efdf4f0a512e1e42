"""Landing JSON: dated page files (original layout) and the partitioned extract."""

import datetime as dt
import json
import os

from conftest import rows
from pyspark.sql import functions as F

from tidemark.sources import landing as LD


def _page(dirpath, date, page, recs):
    with open(os.path.join(dirpath, f"{date}_file_{page}.json"), "w") as f:
        json.dump(recs, f, indent=4)


def test_only_the_asked_date_is_read(spark, tmp_path):
    d = tmp_path / "orders"
    d.mkdir()
    rec = lambda oid, day: {"oid": oid, "customer_id": 1, "order_date": day, "order_status": "pending",
                            "payment_method": "UPI", "shipping_address": "x", "total_amount": 0,
                            "discount_applied": 0, "final_amount": 0}
    _page(d, "2026-07-01", 1, [rec(1, "2026-07-01"), rec(2, "2026-07-01")])
    _page(d, "2026-07-01", 2, [rec(3, "2026-07-01")])
    _page(d, "2026-07-02", 1, [rec(4, "2026-07-02")])
    got = LD.read_pages(spark, str(d), "orders", "2026-07-01")
    assert rows(got, "oid") == [(1,), (2,), (3,)]
    assert got.schema["order_date"].dataType.typeName() == "date"
    assert LD.read_pages(spark, str(d), "orders", dt.datetime(2026, 7, 2, 13, 0)).count() == 1
    assert LD.read_pages(spark, str(d), "orders", "2026-07-03").count() == 0     # nothing landed: no error


def test_extract_round_trip(spark, tmp_path):
    from tidemark.schemas import ORDER_STATUS_LOG
    ts = [dt.datetime(2026, 7, 1, 10, 0, 0, 123456), dt.datetime(2026, 7, 1, 11, 0), dt.datetime(2026, 7, 2, 9, 0)]
    logs = spark.createDataFrame([(i + 1, 5, None, "pending", t, None, None) for i, t in enumerate(ts)],
                                 ORDER_STATUS_LOG)
    path = str(tmp_path / "logs")
    LD.write_extract(logs, path, "order_status_log", "changed_at", limit=1)
    back = LD.read_partitioned(spark, path, "order_status_log")
    assert rows(back, "log_id", "changed_at", "dt", "page") == [
        (1, ts[0], "2026-07-01", 1), (2, ts[1], "2026-07-01", 2), (3, ts[2], "2026-07-02", 1)]
    assert LD.read_partitioned(spark, path, "order_status_log", "2026-07-02").count() == 1


# ---- extracts published by manifest ---------------------------------------------------------------


def shop(spark):
    """Two days of a small shop: items and logs dated by their order, which may come twice or without its id."""
    from tidemark.schemas import CUSTOMERS, INVENTORY, ORDER_ITEMS, ORDER_STATUS_LOG, ORDERS, PRODUCTS
    from decimal import Decimal
    a, b = dt.date(2026, 7, 1), dt.date(2026, 7, 2)
    one = Decimal("1.00")
    order = lambda oid, day: (oid, 7, day, "pending", "UPI", None, 0.0, 0.0, 0.0)
    return {
        "customers": spark.createDataFrame([(7, 'q"uo\nte', None, "x", "y", a), (8, "b", None, "x", "y", b)], CUSTOMERS),
        "products": spark.createDataFrame([(i, f"p{i}", "c", "s", "br", 2.0, 0.0, 1, None, a) for i in range(5)], PRODUCTS),
        "orders": spark.createDataFrame([order(1, a), order(1, a), order(1, a), order(2, b), order(None, a)], ORDERS),
        "order_items": spark.createDataFrame([(i, 1 + i % 2, 0, 1, one, one, one, one) for i in range(7)] + [(99, None, 0, 1, one, one, one, one)], ORDER_ITEMS),
        "inventory": spark.createDataFrame([(1, 0, None, 3, 4, b)], INVENTORY),
        "order_status_log": spark.createDataFrame([(1, 1, None, "pending", dt.datetime(2027, 1, 1, 1, 2, 3, 456789), None, None)], ORDER_STATUS_LOG),
    }


def test_extract_of_a_day_is_published_and_replaced(spark, tmp_path):
    root, source = str(tmp_path), shop(spark)
    assert LD.run_extract(spark, source, root, "2026-07-01", limits={"products": 2, "order_items": 3}) == ["2026-07-01"]
    files = LD.read_manifest(spark, root, "2026-07-01")
    assert rows(files.where("path is not null"), "table_name", "page", "rows") == [
        ("customers", 1, 1), ("order_items", 1, 3), ("order_items", 2, 1), ("order_status_log", 1, 1), ("orders", 1, 4),
        ("products", 1, 2), ("products", 2, 2), ("products", 3, 1)]
    assert rows(files.where("path is null"), "table_name") == [("inventory",)]
    whole = spark.read.text([r["path"] for r in files.where("table_name = 'products' and page = 1").collect()], wholetext=True).first()[0]
    assert [r["pid"] for r in json.loads(whole)] == [0, 1]
    read = lambda t, *days: rows(LD.read_landed(spark, root, t, *(days or ["2026-07-01"])).drop(LD.CORRUPT, "dt"))
    assert read("customers") == rows(source["customers"].where("customer_id = 7"))
    assert read("order_status_log") == rows(source["order_status_log"])
    assert read("order_items") == rows(source["order_items"].where("order_id = 1"))
    assert read("inventory") == [] and read("products", "2026-07-02") == []
    # extracted anew, the date is replaced; a broken run's files are not read
    changed = dict(source, products=source["products"].where("pid < 2"))
    LD.run_extract(spark, changed, root, "2026-07-01", "2026-07-02")
    assert read("products") == rows(changed["products"])
    assert len(read("orders", "2026-07-01", "2026-07-02")) == 5 and read("inventory", "2026-07-02") == rows(source["inventory"])
    assert os.path.isdir(os.path.join(root, "_staging"))


def test_pages_of_a_day_lie_in_one_folder_and_keep_their_numbers(spark, tmp_path):
    root, orders = str(tmp_path), shop(spark)["orders"].where("oid = 1").limit(1)
    many = orders.crossJoin(spark.range(9).select((F.col("id") > 6).cast("bigint").alias("_more"))).withColumn("oid", F.col("oid") + F.col("_more")).drop("_more")
    cost = spark.conf.get(LD.OPEN_COST)
    LD.run_extract(spark, {"orders": many}, root, "2026-07-01", limits={"orders": 2})
    files = LD.read_manifest(spark, root, "2026-07-01").orderBy("page").collect()
    assert [(r["page"], r["rows"]) for r in files] == [(1, 2), (2, 2), (3, 2), (4, 2), (5, 1)]
    read = lambda p: [r["oid"] for r in json.loads(spark.read.text(p, wholetext=True).first()[0])]
    assert [read(r["path"]) for r in files] == [[1, 1], [1, 1], [1, 1], [1, 2], [2]]  # three pages are equal
    assert len({r["path"] for r in files}) == 5 and len({os.path.dirname(r["path"]) for r in files}) == 1
    assert all(r["bytes"] == len(spark.read.text(r["path"], wholetext=True).first()[0]) for r in files)
    assert spark.conf.get(LD.OPEN_COST) == cost


def test_a_broken_page_is_one_corrupt_row(spark, tmp_path):
    root = str(tmp_path)
    LD.run_extract(spark, shop(spark), root, "2026-07-01")
    path = LD.read_manifest(spark, root, "2026-07-01").where("table_name = 'products'").first()["path"].replace("file://", "").replace("file:", "")
    text = open(path).read()
    with open(path, "w") as f:
        f.write(text[:len(text) // 2])
    os.remove(os.path.join(os.path.dirname(path), "." + os.path.basename(path) + ".crc"))
    got = LD.read_landed(spark, root, "products", "2026-07-01").collect()
    assert sum(r[LD.CORRUPT] is not None for r in got) == 1
    from tidemark.plans import bronze as B
    routed = B.split(LD.read_landed(spark, root, "products", "2026-07-01"), "products")
    assert rows(routed.where("sink = 'quarantine'"), "reason") == [("corrupt_record",)]


def test_backfill_from_the_source_tables(spark, tmp_path):
    from tidemark.plans import flow
    from tidemark.plans import pipeline as P
    source, landing, lake = shop(spark), str(tmp_path / "landing"), str(tmp_path / "lake")
    reports = P.backfill(spark, landing, lake, "2026-07-01", "2026-07-02", flow.as_of_col(), source=source)
    assert [r.version for r in reports] == [0, 1]
    silver = lambda n: rows(P.L.read_table(spark, P.Paths(lake).table("silver", n), P.SILVER_SCHEMAS[n]).drop("commit_version"))
    assert [r[0] for r in silver("orders")] == [1, 2] and [r[0] for r in silver("order_items")] == list(range(7))
    days = rows(P.read_mart(spark, lake, "daily_sales_summary"), "order_date", "order_count")
    assert days == [(dt.date(2026, 7, 1), 1), (dt.date(2026, 7, 2), 1)]
    again = P.run_day(spark, source, landing, lake, "2026-07-02", flow.as_of_col(), version=1)
    assert again.version == 1 and rows(P.read_mart(spark, lake, "daily_sales_summary"), "order_date", "order_count") == days
