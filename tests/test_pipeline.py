"""End-to-end runs against versioned tables: three commits, replay, streaming ≡ batch."""

import os

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from tidemark.catalog import publish
from tidemark.plans import flow
from tidemark.plans import pipeline as P
from tidemark.sources import commerce
from tidemark.sources import lake as L

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test data missing")


# Reference data lands before the rows pointing at it (customers and products in the
# first commit, status logs in the last), so k commits must equal one batch.
LANDS_IN = {"customers": 0, "products": 0, "order_status_log": 2}


def committed(spark, name):
    df = commerce.committed(spark, SF_SMALL, name)
    if name == "order_status_log":  # the commit whose batch the gate rejects; lands with the others it would pass
        df = df.where("commit_version <> 1")
    if name in LANDS_IN:
        df = df.withColumn("commit_version", F.lit(LANDS_IN[name]))
    return df


@pytest.fixture(scope="module")
def lake_root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    views = {n: committed(spark, n) for n in P.SILVER_ORDER}
    for v in range(3):
        batches = {n: views[n].filter(F.col("commit_version") == v).drop("commit_version") for n in P.SILVER_ORDER}
        P.run_batches(spark, root, batches, flow.as_of_col(), version=v)
    return root


def test_marks_advanced(spark, lake_root):
    for layer, names in (("bronze", P.SILVER_ORDER), ("silver", P.SILVER_ORDER), ("gold", P.MARTS)):
        for n in names:
            assert L.mark_of(spark, lake_root, layer, n) == 2, (layer, n)


def test_marts_equal_the_one_batch_flow(spark, lake_root):
    import __spark_entry__ as E
    q = E.queries()
    for mart in ("daily_sales_summary", "daily_product_sales", "category_trends", "product_performance"):
        got = publish(P.read_mart(spark, lake_root, mart))
        assert rows(got) == rows(q[mart](spark, SF_SMALL).select(*got.columns)), mart
    c360 = publish(P.read_mart(spark, lake_root, "customer_360")).drop("updated_at", "churn_risk_score")
    assert rows(c360) == rows(q["customer_360"](spark, SF_SMALL).select(*c360.columns))


def test_silver_equals_the_one_batch_flow(spark, lake_root):
    fresh = flow.fresh_lake(spark, SF_SMALL)
    for n in P.SILVER_ORDER:
        got = L.read_table(spark, P.Paths(lake_root).table("silver", n), P.SILVER_SCHEMAS[n]).drop("commit_version")
        expect = fresh.silver(n).drop("commit_version")
        assert rows(publish(got)) == rows(publish(expect).select(*got.columns)), n


def test_replaying_a_commit_changes_nothing(spark, lake_root, tmp_path):
    paths = P.Paths(lake_root)
    before = {n: rows(L.read_table(spark, paths.table("silver", n), P.SILVER_SCHEMAS[n])) for n in P.SILVER_ORDER}
    qbefore = rows(L.read_table(spark, paths.table("silver", "orders"), P.SILVER_SCHEMAS["orders"], sink="quarantine"))
    views = {n: committed(spark, n) for n in P.SILVER_ORDER}
    batches = {n: views[n].filter(F.col("commit_version") == 1).drop("commit_version") for n in P.SILVER_ORDER}
    rep = P.RunReport(1)
    for n in P.SILVER_ORDER:
        P.ingest_batch(spark, paths, n, batches[n], 1, rep)
    for n in P.SILVER_ORDER:
        P.clean_commit(spark, paths, n, 1, rep)
    after = {n: rows(L.read_table(spark, paths.table("silver", n), P.SILVER_SCHEMAS[n])) for n in P.SILVER_ORDER}
    assert after == before
    assert rows(L.read_table(spark, paths.table("silver", "orders"), P.SILVER_SCHEMAS["orders"],
                             sink="quarantine")) == qbefore


def test_streaming_edge_equals_batch(spark, lake_root, tmp_path):
    from tidemark.plans import silver as S
    from tidemark.schemas import ORDERS
    from tidemark.streaming.incremental import clean_edge
    paths = P.Paths(lake_root)
    customers = L.read_table(spark, paths.table("silver", "customers"), P.SILVER_SCHEMAS["customers"])
    items = L.read_table(spark, paths.table("silver", "order_items"), P.SILVER_SCHEMAS["order_items"])
    out = str(tmp_path / "silver_orders")
    ckpt = str(tmp_path / "ckpt")
    clean_edge(spark, paths.table("bronze", "orders"), out, ORDERS,
               lambda b, before: S.silver_orders(b, before, customers, items), ckpt,
               silver_schema=P.SILVER_SCHEMAS["orders"])
    got = L.read_table(spark, out, P.SILVER_SCHEMAS["orders"]).drop("commit_version")
    expect = L.read_table(spark, paths.table("silver", "orders"), P.SILVER_SCHEMAS["orders"]).drop("commit_version")
    assert rows(got) == rows(expect)
    # a second availableNow run finds nothing new and changes nothing
    clean_edge(spark, paths.table("bronze", "orders"), out, ORDERS,
               lambda b, before: S.silver_orders(b, before, customers, items), ckpt,
               silver_schema=P.SILVER_SCHEMAS["orders"])
    assert rows(L.read_table(spark, out, P.SILVER_SCHEMAS["orders"]).drop("commit_version")) == rows(expect)


def test_failing_mart_does_not_stop_the_others(spark, lake_root):
    rep = P.RunReport(3)
    P.build_marts(spark, P.Paths(lake_root), 3, F.lit("not a time").cast("timestamp"), rep)
    status = {t: s for _, t, s, _ in rep.statuses}
    assert status["daily_sales_summary"] == "ok"


def test_backfill_from_landing(spark, tmp_path):
    """Business dates landed as dated pages, caught up one commit per date; the middle
    date landed nothing and still takes its (empty) commit."""
    from tidemark.plans.pipeline import backfill
    from tidemark.sources import landing as LD
    days = ["1995-03-01", "1995-03-03"]
    landing = str(tmp_path / "landing")
    lake_root = str(tmp_path / "lake")
    orders = commerce.orders(spark, SF_SMALL)
    on_days = orders.filter(F.date_format("order_date", "yyyy-MM-dd").isin(days))
    items = commerce.order_items(spark, SF_SMALL).join(
        on_days.select(F.col("oid").alias("order_id"), "order_date"), "order_id")
    LD.write_extract(commerce.customers(spark, SF_SMALL).withColumn("join_date", F.to_date(F.lit(days[0]))),
                     f"{landing}/customers", "customers", "join_date")
    LD.write_extract(commerce.products(spark, SF_SMALL).withColumn("created_at", F.to_date(F.lit(days[0]))),
                     f"{landing}/products", "products", "created_at")
    LD.write_extract(on_days, f"{landing}/orders", "orders", "order_date")
    LD.write_extract(items, f"{landing}/order_items", "order_items", "order_date")
    reports = backfill(spark, landing, lake_root, days[0], days[1], flow.as_of_col())
    assert [r.version for r in reports] == [0, 1, 2]
    assert {st for layer, _t, st, _d in reports[1].statuses if layer == "bronze"} == {"empty"}
    paths = P.Paths(lake_root)
    got = L.read_table(spark, paths.table("silver", "orders"), P.SILVER_SCHEMAS["orders"])
    expect = on_days.join(items.select(F.col("order_id").alias("oid")).distinct(), "oid")
    assert rows(got, "oid") == rows(expect, "oid")
    per_commit = rows(got.groupBy("commit_version").count())
    assert [c for c, _ in per_commit] == [0, 2]
    assert P.read_mart(spark, lake_root, "daily_sales_summary").count() == len(days)


# ---- catch-up, re-runs, empty and rejected commits: five marts must equal the undisturbed run ------


def small_batches(spark, day, n=4, bad=0):
    """One day's extract: ``n`` orders of two customers over two products; ``bad`` orders without an id."""
    import datetime as dt
    from tidemark.schemas import ENTITIES
    d = dt.date(2026, 7, 1 + day)
    ids = [100 * day + k for k in range(n)]
    out = {name: spark.createDataFrame([], ENTITIES[name]) for name in P.SILVER_ORDER}

    def rows_of(name, values):
        names = ENTITIES[name].fieldNames()
        import decimal
        typed = []
        for v in values:
            row = []
            for f in ENTITIES[name].fields:
                x = v.get(f.name)
                kind = f.dataType.simpleString()
                if x is not None and kind.startswith("decimal"):
                    x = decimal.Decimal(str(x))
                elif x is not None and kind == "double":
                    x = float(x)
                elif x is not None and kind == "timestamp":
                    x = dt.datetime.combine(x, dt.time()) if not isinstance(x, dt.datetime) else x
                row.append(x)
            typed.append(tuple(row))
        assert set(values[0]) <= set(names), set(values[0]) - set(names)
        return spark.createDataFrame(typed, ENTITIES[name])

    if day == 0:
        out["customers"] = rows_of("customers", [{"customer_id": c, "name": f"n{c}"} for c in (1, 2)])
        out["products"] = rows_of("products", [{"pid": p, "product_name": f"p{p}", "category": f"c{p}", "base_price": 10, "current_stock": 5} for p in (1, 2)])
    if n:
        orders = [{"oid": i, "customer_id": 1 + k % 2, "order_date": d, "discount_applied": 0} for k, i in enumerate(ids)]
        orders += [{"oid": None, "customer_id": 1, "order_date": d}] * bad
        out["orders"] = rows_of("orders", orders)
        out["order_items"] = rows_of("order_items", [
            {"order_item_id": 2 * i + j, "order_id": i, "product_id": 1 + j, "quantity": 1 + j, "unit_price_at_order": 10 + day, "discount_at_order": 0,
             **({"gross_amount": (1 + j) * (10 + day)} if "gross_amount" in ENTITIES["order_items"].fieldNames() else {}),
             "line_total": (1 + j) * (10 + day)} for i in ids for j in (0, 1)])
    return out


def all_marts(spark, root):
    out = {}
    for m in P.MARTS:
        df = publish(P.read_mart(spark, root, m))
        out[m] = rows(df.drop(*[c for c in ("updated_at", "churn_risk_score") if c in df.columns]))
    return out


@pytest.fixture(scope="module")
def undisturbed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plain"))
    for day in range(3):
        P.run_batches(spark, root, small_batches(spark, day), flow.as_of_col())
    return all_marts(spark, root)


def test_a_later_run_catches_up_what_a_crash_left(spark, tmp_path, undisturbed, monkeypatch):
    root = str(tmp_path)
    P.run_batches(spark, root, small_batches(spark, 0), flow.as_of_col())
    with monkeypatch.context() as m:      # commit 1 ends before its marts
        m.setattr(P, "build_marts", lambda *a, **k: None)
        P.run_batches(spark, root, small_batches(spark, 1), flow.as_of_col())
    P.run_batches(spark, root, small_batches(spark, 2), flow.as_of_col())
    assert all_marts(spark, root) == undisturbed


def test_silver_left_behind_catches_up(spark, tmp_path, undisturbed, monkeypatch):
    root = str(tmp_path)
    P.run_batches(spark, root, small_batches(spark, 0), flow.as_of_col())
    with monkeypatch.context() as m:
        m.setattr(P, "clean_pending", lambda *a, **k: None)
        m.setattr(P, "build_marts", lambda *a, **k: None)
        P.run_batches(spark, root, small_batches(spark, 1), flow.as_of_col())
    P.run_batches(spark, root, small_batches(spark, 2), flow.as_of_col())
    assert all_marts(spark, root) == undisturbed


def test_running_a_commit_again_changes_nothing(spark, tmp_path, undisturbed):
    root = str(tmp_path)
    for day in (0, 0, 1, 2, 2, 1):        # the newest twice, then an older one
        P.run_batches(spark, root, small_batches(spark, day), flow.as_of_col(), version=day)
    assert all_marts(spark, root) == undisturbed
    assert P.next_version(spark, P.Paths(root)) == 3


def test_first_day_without_orders(spark, tmp_path):
    root = str(tmp_path)
    rep = P.run_batches(spark, root, small_batches(spark, 0, n=0), flow.as_of_col())
    assert not rep.failed()
    assert all(len(v) == 0 for m, v in all_marts(spark, root).items() if m != "customer_360")
    assert not P.run_batches(spark, root, small_batches(spark, 1), flow.as_of_col()).failed()
    assert len(all_marts(spark, root)["daily_sales_summary"]) == 1


def test_a_rejected_run_again_clears_its_commit(spark, tmp_path):
    root = str(tmp_path)
    P.run_batches(spark, root, small_batches(spark, 0), flow.as_of_col())
    P.run_batches(spark, root, small_batches(spark, 0, n=2, bad=9), flow.as_of_col(), version=0)
    bronze = L.read_table(spark, P.Paths(root).table("bronze", "orders"), P.ENTITIES["orders"])
    assert bronze.count() == 0
    assert all_marts(spark, root)["daily_sales_summary"] == []


def test_readers_of_a_failed_mart_wait_for_it(spark, tmp_path, undisturbed, monkeypatch):
    root = str(tmp_path)
    P.run_batches(spark, root, small_batches(spark, 0), flow.as_of_col())
    good = P.G.product_day_partials
    with monkeypatch.context() as m:
        m.setattr(P.G, "product_day_partials", lambda *a: (_ for _ in ()).throw(ValueError("broken")))
        rep = P.run_batches(spark, root, small_batches(spark, 1), flow.as_of_col(), raise_on_failure=False)
    assert [f[1] for f in rep.failed()] == ["daily_product_sales"]
    assert P.G.product_day_partials is good
    P.run_batches(spark, root, small_batches(spark, 2), flow.as_of_col())
    assert all_marts(spark, root) == undisturbed


def test_streaming_edge_keeps_commits_apart(spark, tmp_path):
    """Silver holds two batch commits; the stream brings a third and leaves the others as they are."""
    from tidemark.plans import silver as S
    from tidemark.schemas import CUSTOMERS
    from tidemark.streaming.incremental import clean_edge
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    names = CUSTOMERS.fieldNames()

    def people(*ids):
        return spark.createDataFrame([(i, *[None] * (len(names) - 1)) for i in ids], CUSTOMERS)

    for v, ids in enumerate([(1, 2), (3, 4)]):
        L.commit_append(people(*ids), bronze, v)
        L.commit_append(people(*ids), silver, v)
    L.commit_append(people(4, 5, 6), bronze, 2)
    for _ in range(2):
        clean_edge(spark, bronze, silver, CUSTOMERS, S.silver_customers, str(tmp_path / "ckpt"))
        got = L.read_table(spark, silver, CUSTOMERS)
        assert rows(got, "commit_version", "customer_id") == [(0, 1), (0, 2), (1, 3), (1, 4), (2, 5), (2, 6)]
