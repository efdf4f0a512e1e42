"""Plan-shape guards for the scale properties (checked on the executed plan)."""

from pyspark.sql import functions as F

from tidemark.operators.cleaning import new_rows_anti
from tidemark.operators.ordered import lag_within


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_key_joins_force_no_broadcast(spark):
    big = spark.range(0, 200_000).withColumnRenamed("id", "k")
    batch = spark.range(0, 50).withColumn("k", F.col("id") * 7).select("k")
    df = new_rows_anti(batch, big, ["k"])
    assert "hint" not in df._jdf.queryExecution().logical().toString().lower()   # sizes are measured, not asserted
    plan = _plan(df)
    assert "LeftSemi" in plan and "LeftAnti" in plan


def test_seen_keys_are_distinct_however_often_a_key_repeats(spark):
    from tidemark.operators.cleaning import _seen_keys
    existing = spark.range(0, 1_000_000).select((F.col("id") % 5).alias("k"))
    batch = spark.range(0, 10).withColumnRenamed("id", "k")
    assert _seen_keys(batch, existing, ["k"]).count() == 5
    assert new_rows_anti(batch, existing, ["k"]).count() == 5


def test_lag_window_is_split_by_range_not_by_key(spark):
    hot = spark.range(0, 5000).select(F.lit(1).alias("k"), F.col("id").alias("t"), F.col("id").cast("string").alias("v"))
    plan = _plan(lag_within(hot, ["k"], ["t"], {"v": "pv"}, num_partitions=8))
    import re
    assert "Window" in plan
    # the window's shuffle hashes on (key, range label): a hot key spreads over all ranges
    assert re.search(r"hashpartitioning\(k#\d+, _part#\d+", plan), plan
    got = lag_within(hot, ["k"], ["t"], {"v": "pv"}, num_partitions=8)
    assert got.filter(F.col("pv").isNull()).count() == 1     # only the very first row lacks a predecessor


def test_gate_verdicts_go_to_the_rows(spark):
    from tidemark.plans import bronze as B
    landed = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 1, None).otherwise(F.col("id")).alias("oid"), (F.col("id") % 2).cast("int").alias("commit_version"))
    landed = landed.where("commit_version = 1 or oid is not null")   # commit 0 keeps no bad row
    out = B.ingest(landed, "orders", by=["commit_version"])
    # a shuffle on the commits would put the whole table into as many tasks as there are commits
    assert "hashpartitioning(commit_version" not in _plan(out.accepted)
    assert {(r["commit_version"], r["passed"]) for r in out.gate.collect()} == {(0, True), (1, False)}
    assert {r["commit_version"] for r in out.accepted.collect()} == {0} and out.accepted.count() == 1000


def test_a_large_group_of_pages_stays_spread(spark):
    from tidemark.operators.ranking import assign_pages
    days = spark.range(0, 2000).select("id", F.when(F.col("id") < 5, "a").otherwise("b").alias("day"))
    out = assign_pages(days, [F.col("id")], 10, group_by=["day"])
    assert "hashpartitioning(day" not in _plan(out)   # the days' first ranks go to the rows, not the rows to a task per day
    last = out.where("day = 'b'").orderBy(F.col("page").desc(), F.col("row_in_page").desc()).first()
    assert (last["id"], last["page"], last["total_pages"], last["row_in_page"]) == (1999, 200, 200, 5)


class _Shop:
    """Landed customers and silver products; whoever asks for another table gets an error."""

    def __init__(self, spark):
        from tidemark.schemas import CUSTOMERS, PRODUCTS
        self.spark, self.sf_dir = spark, "none"
        self.customers = spark.createDataFrame([(i, "n", None, "c", "d", None) for i in range(4)], CUSTOMERS).withColumn("commit_version", (F.col("customer_id") % 2).cast("int"))
        self.products = spark.createDataFrame([(i, "n", "c", "s", "b", 1.0, 0.0, 1, None, None) for i in range(3)], PRODUCTS).withColumn("commit_version", F.lit(0))

    def landed(self, name):
        from tidemark.plans import bronze as B
        return B.ingest({"customers": self.customers}[name], name, by=["commit_version"])

    def silver(self, name):
        return {"products": self.products}[name]


def test_a_replay_cleans_the_tables_asked_for(spark, monkeypatch):
    from tidemark.plans import flow
    monkeypatch.setattr(flow, "_LAKES", {})
    monkeypatch.setattr(flow, "landing_of", lambda spark, d: _Shop(spark))
    lake = flow.replay_lake(spark, "none")
    sinks = {(r["customer_id"], r["sink"]) for r in lake.cleaned("customers").routed.collect()}
    assert sinks == {(0, "quarantine"), (2, "quarantine"), (1, "main"), (3, "main")}   # commit 0 was there before


def test_landed_rows_are_written_once_for_all_lakes(spark, monkeypatch):
    from tidemark.plans import flow
    ids = spark.range(0, 100).select(F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id")).alias("oid"), (F.col("id") % 3).cast("int").alias("commit_version"))
    monkeypatch.setattr(flow.commerce, "committed", lambda spark, d, name: ids.join(spark.range(0, 100).withColumnRenamed("id", "oid"), "oid", "left"))
    landing = flow.Landing(spark, "none")
    rows = landing.landed("orders").accepted
    assert "Range (" not in _plan(rows) and rows.count() == 90   # the view and its join are not read again
    assert any("landed-orders" in f for f in rows.inputFiles())
    assert {(r["commit_version"], r["rows"], r["bad_rows"]) for r in landing.landed("orders").gate.collect()} == {(0, 34, 4), (1, 33, 3), (2, 33, 3)}


def test_routing_runs_in_generated_code(spark):
    from tidemark.operators.routing import MAIN, QUARANTINE, route
    out = route(spark.range(0, 6), "silver", [(MAIN, None, F.col("id") > 1), (QUARANTINE, "low", F.col("id") < 3), (QUARANTINE, "null", F.lit(None).cast("boolean"))])
    assert "lambda" not in _plan(out).lower()
    assert sorted((r["id"], r["sink"], r["reason"], r["layer"]) for r in out.collect()) == sorted(
        [(i, "main", None, None) for i in range(2, 6)] + [(i, "quarantine", "low", "silver") for i in range(3)], key=lambda t: (t[0], t[1]))


def test_pages_of_dated_tables_need_no_orders(spark, monkeypatch):
    from tidemark.plans import flow, queries
    monkeypatch.setattr(flow, "fresh_lake", lambda spark, d: _Shop(spark))
    monkeypatch.setattr(queries, "_INDEXES", {})
    assert [r["pid"] for r in queries._page_index(spark, "none", "products", True).page(1, 2).collect()] == [0, 1]


def test_partitions_grow_with_the_input(spark, tmp_path):
    import re

    from tidemark import session as S
    from tidemark.operators.page_index import PageIndex
    from tidemark.sources.tables import bytes_of
    keys = [S.INITIAL, S.SIZED, *S.TASK_BYTES]
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8m")
        S.bound_tasks(spark, 100 * S.SHUFFLE_SHARE + 1)
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "8m" and spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
        assert S.shuffle_partitions(spark) == 101
        rows = spark.range(0, 1000)
        assert re.search(r"hashpartitioning\([^()]*, 101\)", _plan(rows.groupBy((F.col("id") % 7).alias("k")).count()))
        index = PageIndex.build(rows, str(tmp_path / "pages"), [F.col("id")])
        assert index.counts().count() == 101 and [r["id"] for r in index.page(100, 10).collect()] == list(range(990, 1000))
        S.bound_tasks(spark, 1)   # a small input again
        assert S.shuffle_partitions(spark) == int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set(S.INITIAL, "33")
        S.bound_tasks(spark, 100 * S.SHUFFLE_SHARE)
        assert S.shuffle_partitions(spark) == 33   # the session's own
        spark.range(0, 10).write.parquet(str(tmp_path / "orders.parquet"))
        files = sum(f.stat().st_size for f in (tmp_path / "orders.parquet").iterdir() if not f.name.startswith("."))
        assert bytes_of(spark, str(tmp_path)) >= files > 0
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_files_that_compress_well_are_not_taken_for_small(spark, tmp_path):
    from tidemark import session as S
    keys = [S.INITIAL, S.SIZED, S.COMPRESSION, *S.TASK_BYTES]
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        # 1,500,000 keys in some 7 MB, as orders are written: by their bytes they would be broadcast, and take about 100 MB of the driver
        texts = [F.lit(f"{c} of all rows").alias(c) for c in "abcdef"]
        spark.range(0, 1_500_000, 1, 2).select("id", *texts).write.parquet(str(tmp_path / "many"))
        spark.range(0, 100).write.parquet(str(tmp_path / "few"))
        rows = spark.range(0, 3_000_000).select((F.col("id") * 3).alias("id"), F.lit("a longer text that every one of the rows has").alias("t"), F.lit("another such text of the row").alias("u"))

        def planned(of):
            df = rows.join(spark.read.parquet(str(tmp_path / of)).select("id"), "id", "left_semi")
            return df, df._jdf.queryExecution().executedPlan().toString()

        spark.conf.set(S.COMPRESSION, "1.0")
        assert "BroadcastHashJoin" in planned("many")[1]   # what bound_tasks is there for
        S.bound_tasks(spark, 1)
        df, plan = planned("many")
        assert "BroadcastHashJoin" not in plan and df.count() == 500_000
        assert "BroadcastHashJoin" in planned("few")[1]    # small tables are still sent to the rows
        spark.conf.set(S.COMPRESSION, "100.0")
        S.bound_tasks(spark, 1)
        assert spark.conf.get(S.COMPRESSION) == "100.0"    # the session's own
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
