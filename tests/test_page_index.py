"""Single pages through the index: equal to the paged listing, from two ranges at most."""

import datetime as dt

import pytest
from conftest import rows

from tidemark.plans import extracts as X
from tidemark.schemas import CUSTOMERS, ORDER_STATUS_LOG, ORDERS

DAY = dt.date(2026, 7, 1)


def customers(spark, n=200):
    return spark.createDataFrame([(None if k % 40 == 0 else k // 2, f"n{k % 3}", None, "x", "y", None if k % 50 == 7 else DAY + dt.timedelta(days=k % 5)) for k in range(n)], CUSTOMERS)


@pytest.mark.parametrize("by_day", [False, True])
def test_pages_equal_the_paged_listing(spark, tmp_path, by_day):
    df = customers(spark)
    index = X.page_index(df, "customers", str(tmp_path), by_day=by_day, ranges=5)
    cols = [*df.columns, "page", "total_pages", "row_in_page"]
    if not by_day:
        whole = X.paged(df, "customers", 30)
        for number in (1, 4, 7, 8):
            assert rows(index.page(number, 30), *cols) == rows(X.page(whole, number), *cols)
    day = DAY + dt.timedelta(days=2)
    on = X.page_customers(df, day.isoformat(), 15)
    for number in (1, 3):
        got = index.page(number, 15, day.isoformat(), day.isoformat())
        assert rows(got, *cols) == rows(X.page(on, number), *cols)
        if by_day:
            assert 1 <= len({f.rsplit("/", 2)[1] for f in got.inputFiles()}) <= 2
    assert index.page(99, 30).count() == 0
    with pytest.raises(ValueError):
        index.page(0, 30)


def test_dated_orders_and_their_logs(spark, tmp_path):
    orders = spark.createDataFrame([(k, 1, DAY + dt.timedelta(days=k % 3), "s", "p", None, 0.0, 0.0, 0.0) for k in range(30)], ORDERS)
    index = X.page_index(orders, "orders", str(tmp_path / "o"), ranges=3)
    for first, last in ((None, None), (None, "2026-07-02"), ("2026-07-02", None), ("2026-07-01", "2026-07-02"), ("2026-07-03", "2026-07-01")):
        want = X.page(X.page_orders(orders, first, last, 7), 2)
        assert rows(index.page(2, 7, first, last)) == rows(want.select(*index.page(2, 7).columns))
    logs = spark.createDataFrame([(k, k % 40, None, "s", dt.datetime(2027, 1, 1), None, None) for k in range(80)], ORDER_STATUS_LOG)
    index = X.page_index(logs, "order_status_log", str(tmp_path / "l"), orders, by_day=True, ranges=3)
    want = X.page(X.page_order_status_log(logs, orders, "2026-07-02", 6), 2)
    assert rows(index.page(2, 6, "2026-07-02", "2026-07-02")) == rows(want.select(*index.page(1, 6).columns))
    assert index.page(1, 100).count() == 80      # rows without an order are listed where no day is asked for
