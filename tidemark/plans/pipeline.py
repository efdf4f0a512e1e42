"""One business date through all layers, against versioned Parquet tables.

    landing/<table>/...  --ingest-->  bronze/<table>/commit_version=v/sink=main|quarantine
                         --clean--->  silver/<table>/commit_version=v/sink=main|quarantine
                         --marts--->  gold/<mart>/snapshot=<v> or, by product, bucketed versions

All tables of a run commit under one shared ``commit_version`` (the run's batch id), so a
mart joining two feeds reads the same batch from both. Commit *v* of any table replaces
its whole commit directory (rows and quarantine) and reads only commits < *v* of its own
table. Marks are written after the data.

Every edge is driven by marks: silver cleans each bronze commit in (silver mark, bronze mark], a
mart takes the silver commits in (its mark, silver mark] on top of its last snapshot below them. So
a layer or mart that a crash left behind catches up in the next run. Running a version that is
already done sets the marks of all edges back to just before it: the commit and whatever
followed are made anew from snapshots and commits below it, never from their own output.
A rejected or empty batch commits no rows (and clears what an earlier attempt had committed).
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.caching import persist, released
from tidemark.operators.quality import gate_passes
from tidemark.plans import bronze as B
from tidemark.plans import gold as G
from tidemark.plans import incremental as I
from tidemark.plans import silver as S
from tidemark.schemas import CORRUPT, ENTITIES
from tidemark.sources import lake as L
from tidemark.sources.buckets import Buckets

log = logging.getLogger(__name__)

BUCKETED = {"daily_product_sales": I.PRODUCT_DAYS, "product_performance": I.PERFORMANCE}
SILVER_ORDER = ["customers", "products", "order_items", "orders", "inventory", "order_status_log"]
MARTS = ["customer_360", "daily_sales_summary", "daily_product_sales", "product_performance", "category_trends"]


#: Buckets of the marts kept by product or category; fixed for the life of a lake (about a mart's expected bytes over 128 MB).
MART_BUCKETS = 8


@dataclass
class Paths:
    root: str
    buckets: int = MART_BUCKETS

    def table(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def mart(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/gold/{name}"

    def bucketed(self, spark: SparkSession, name: str) -> Buckets:
        return Buckets(spark, self.mart(name), ("pid",), BUCKETED[name], self.buckets)


@dataclass
class RunReport:
    version: int
    statuses: list[tuple[str, str, str, str]] = field(default_factory=list)  # layer, table, status, detail

    def add(self, layer: str, table: str, status: str, detail: str = "") -> None:
        self.statuses.append((layer, table, status, detail))

    def failed(self) -> list[tuple[str, str, str, str]]:
        return [s for s in self.statuses if s[2] == "failed"]


# ---- bronze ------------------------------------------------------------------------------------


def ingest_batch(spark: SparkSession, paths: Paths, name: str, raw: DataFrame, version: int,
                 report: RunReport) -> int:
    """Gate one landed batch and commit it (rows + quarantine in one write); returns its
    row count (0 for no input). The mark is recorded by the caller, after all tables.

    One pass over the landing: the gate's counts are observed while the commit is written, and a commit that the
    gate rejects is replaced by an empty one. Readers follow marks, so none sees it before the verdict."""
    path, rule = paths.table("bronze", name), B.rules()[name]
    seen = Observation()
    counted = raw.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(B.bad_row(raw, name)).alias("bad_rows"))
    L.commit_routed(B.split(counted, name), path, version)
    counts = seen.get
    rows, bad = int(counts.get("rows") or 0), int(counts.get("bad_rows") or 0)  # nothing is observed of a batch known to be empty
    if rows == 0:
        report.add("bronze", name, "empty")
    elif gate_passes(rows, bad, B.MAX_BAD_SHARE, rule.strict):
        report.add("bronze", name, "ok", f"{rows} rows")
    else:
        L.commit_append(L.empty(spark, ENTITIES[name]), path, version)
        report.add("bronze", name, "rejected", f"{bad} of {rows} rows bad")
    return rows


# ---- silver ------------------------------------------------------------------------------------


def clean_commit(spark: SparkSession, paths: Paths, name: str, version: int,
                 report: RunReport) -> None:
    """Clean commit ``version`` of one bronze table into silver (+ quarantine)."""
    batch = L.drop_feed_metadata(L.change_feed(spark, paths.table("bronze", name), ENTITIES[name], version, version))
    with released():
        L.commit_routed(_clean(spark, paths, name, version, batch).routed, paths.table("silver", name), version)
    report.add("silver", name, "ok")


def _clean(spark: SparkSession, paths: Paths, name: str, version: int, batch: DataFrame) -> S.Cleaned:
    before = L.read_table(spark, paths.table("silver", name), SILVER_SCHEMAS[name], upto=version - 1)

    def silver(ref: str) -> DataFrame:
        return L.read_table(spark, paths.table("silver", ref), SILVER_SCHEMAS[ref], upto=version)

    if name == "customers":
        return S.silver_customers(batch, before)
    if name == "products":
        return S.silver_products(batch, before)
    if name == "order_items":
        return S.silver_order_items(batch, before, silver("products"))
    if name == "orders":
        return S.silver_orders(batch, before, silver("customers"), silver("order_items"))
    if name == "inventory":
        return S.silver_inventory(batch, before, silver("products"))
    return S.silver_order_status_log(batch, before, silver("orders"))


# ---- gold --------------------------------------------------------------------------------------


def _orders_schema():
    from pyspark.sql import types as T
    # silver orders carry exact decimals for the recomputed amounts
    fields = []
    for f in ENTITIES["orders"].fields:
        if f.name in ("total_amount", "final_amount"):
            fields.append(T.StructField(f.name, T.DecimalType(18, 2)))
        elif f.name == "discount_applied":
            fields.append(T.StructField(f.name, T.DecimalType(12, 6)))
        else:
            fields.append(f)
    return T.StructType(fields)


SILVER_SCHEMAS = dict(ENTITIES, orders=_orders_schema())


def partials_schema(spark: SparkSession):
    """Schema of the stored product-day partials (from the plan; nothing runs)."""
    return G.product_day_partials(*(L.empty(spark, L.with_commit_schema(SILVER_SCHEMAS[n])) for n in ("orders", "order_items", "products"))).schema


def build_marts(spark: SparkSession, paths: Paths, version: int, as_of: Column, report: RunReport,
                only: list[str] | None = None, marks: L.Marks | None = None) -> None:
    """Bring the five marts up to silver commit ``version``, each from its own mark.

    One failing mart does not stop the others: its failure is reported, its mark stays, and marts
    that read it go on from its last good snapshot.
    """
    marks = marks or L.Marks(spark, paths.root)

    def mark(mart: str) -> int:
        return marks.of("gold", mart)

    def silver(name: str, upto: int) -> DataFrame:
        return L.read_table(spark, paths.table("silver", name), SILVER_SCHEMAS[name], upto=upto)

    def feed(name: str, first: int, last: int) -> DataFrame:
        return L.change_feed(spark, paths.table("silver", name), SILVER_SCHEMAS[name], first, last)

    def before(mart: str, first: int) -> DataFrame | None:
        return L.read_snapshot(spark, paths.mart(mart), marks.last_before("gold", mart, first))

    def partials() -> DataFrame:
        return L.read_table(spark, paths.mart("daily_product_sales_partials"), partials_schema(spark))

    def added(first: int, last: int) -> DataFrame:
        """The product-days that the commits bring, one row each."""
        return persist(G.compact_product_days(partials().filter(F.col(L.CV).between(first, last)).drop(L.CV)))

    def held_before(mart: str, first: int) -> int:
        return marks.last_before("gold", mart, first)

    def c360(first: int, last: int) -> None:
        mart = G.customer_360_step(before("customer_360", first), feed("orders", first, last).drop(L.CV), silver("customers", last), as_of)
        L.write_snapshot(mart, paths.mart("customer_360"), last)

    def daily_sales(first: int, last: int) -> None:
        root = paths.mart("daily_sales_state")
        prev = L.read_snapshot(spark, root, marks.last_before("gold", "daily_sales_summary", first))
        L.write_snapshot(G.merge_daily_sales(prev, G.daily_sales_batch(feed("orders", first, last))), root, last)
        L.write_snapshot(G.publish_daily_sales(L.read_snapshot(spark, root, last)), paths.mart("daily_sales_summary"), last)

    def product_sales(first: int, last: int) -> None:
        for v in range(first, last + 1):  # a commit of partials per silver commit: a re-run replaces just these
            parts = G.product_day_partials(feed("orders", v, v), feed("order_items", v, v), silver("products", v))
            L.commit_append(parts, paths.mart("daily_product_sales_partials"), v)
        paths.bucketed(spark, "daily_product_sales").change(last, held_before("daily_product_sales", first), added(first, last), I.add_product_days)

    def performance(first: int, last: int) -> None:
        paths.bucketed(spark, "product_performance").change(last, held_before("product_performance", first), added(first, last), I.product_performance_step)

    def trends(first: int, last: int) -> None:
        was, days = held_before("category_trends", first), paths.bucketed(spark, "daily_product_sales")
        more = added(first, last)
        held = days.read(was, days.touched(more))
        lines = persist(I.new_lines(silver("orders", last), silver("order_items", last), silver("products", last), first, last))
        states = I.CategoryStates(spark, paths.mart("category_state"), paths.buckets)
        states.step(last, was, lines, I.product_day_changes(held, more))
        L.write_snapshot(states.publish(last), paths.mart("category_trends"), last)

    steps = {"customer_360": c360, "daily_sales_summary": daily_sales, "daily_product_sales": product_sales,
             "product_performance": performance, "category_trends": trends}
    reads = {"product_performance": "daily_product_sales", "category_trends": "daily_product_sales"}
    for name in only or MARTS:
        try:
            last = mark(reads[name]) if name in reads else version
            first = mark(name) + 1
            if first > last:
                report.add("gold", name, "up_to_date" if first == last + 1 else "conflict")
                continue
            with released():          # intermediates persisted by the step die with it
                steps[name](first, last)
            marks.record([("gold", name, last, "ok")])
            report.add("gold", name, "ok")
        except Exception as e:  # isolate: report, go on with the other marts
            log.exception("mart %s failed", name)
            report.add("gold", name, "failed", f"{type(e).__name__}: {str(e)[:500]}")


# ---- a whole run ---------------------------------------------------------------------------------


def next_version(spark: SparkSession, paths: Paths, marks: L.Marks | None = None) -> int:
    marks = marks or L.Marks(spark, paths.root)
    return max((v for (layer, _), v in marks.current().items() if layer == "bronze"), default=-1) + 1


def rewind(marks: L.Marks, version: int) -> None:
    """Set every mark at or above ``version`` back to ``version - 1``."""
    marks.record([(layer, table, version - 1, L.REWOUND) for (layer, table), v in sorted(marks.current().items()) if v >= version])


def clean_pending(spark: SparkSession, paths: Paths, upto: int, report: RunReport, marks: L.Marks | None = None) -> None:
    """Clean every bronze commit that silver lacks, oldest first, all tables of a commit together."""
    marks = marks or L.Marks(spark, paths.root)
    now = marks.current()
    pending = {n: now.get(("silver", n), -1) + 1 for n in SILVER_ORDER if ("bronze", n) in now}
    for v in range(min(pending.values(), default=upto + 1), upto + 1):
        done = []
        for name in SILVER_ORDER:
            if name in pending and pending[name] <= v:
                clean_commit(spark, paths, name, v, report)
                done.append(("silver", name, v, "ok"))
        marks.record(done)


def run_batches(spark: SparkSession, root: str, batches: dict[str, DataFrame], as_of: Column,
                version: int | None = None, raise_on_failure: bool = True, buckets: int = MART_BUCKETS) -> RunReport:
    """Ingest one landed batch per table, bring silver and the marts up to it: one commit version.

    A table without a batch takes an empty commit, so all tables stay on the shared version.
    """
    paths = Paths(root, buckets)
    marks = L.Marks(spark, root)
    v = next_version(spark, paths, marks) if version is None else version
    rewind(marks, v)
    report = RunReport(v)
    for name in SILVER_ORDER:
        raw = batches[name] if name in batches else L.empty(spark, ENTITIES[name])
        ingest_batch(spark, paths, name, raw, v, report)
    # Bronze commits after a re-run version are still there: the edges go on to the last of them.
    top = max(v, marks.last_done("bronze"))
    marks.record([(lay, t, top, st) for lay, t, st, _ in report.statuses if lay == "bronze"])
    clean_pending(spark, paths, top, report, marks)
    build_marts(spark, paths, top, as_of, report, marks=marks)
    if raise_on_failure and report.failed():
        raise RuntimeError(f"marts failed in commit {v}: {report.failed()}")
    return report


def run_pipeline(spark: SparkSession, landing_root: str, root: str, date, as_of: Column | None = None,
                 layout: str = "partitioned", version: int | None = None) -> RunReport:
    """Daily run for one business ``date``: landed pages of that date → bronze → silver → gold."""
    from tidemark.sources import landing as LD
    batches = {}
    for name in SILVER_ORDER:
        if layout == "manifest":
            batches[name] = LD.read_landed(spark, landing_root, name, date).select(*ENTITIES[name].fieldNames(), CORRUPT)
        else:
            read = LD.read_partitioned if layout == "partitioned" else LD.read_pages
            batches[name] = read(spark, f"{landing_root.rstrip('/')}/{name}", name, date).select(*ENTITIES[name].fieldNames())
    as_of = as_of if as_of is not None else F.current_timestamp()
    return run_batches(spark, root, batches, as_of, version)


def run_day(spark: SparkSession, source: dict[str, DataFrame], landing_root: str, root: str, date, as_of: Column | None = None,
            version: int | None = None) -> RunReport:
    """The whole chain for one business ``date``: extract out of the source tables → landing → bronze → silver → gold."""
    from tidemark.sources import landing as LD
    LD.run_extract(spark, source, landing_root, date)
    return run_pipeline(spark, landing_root, root, date, as_of, "manifest", version)


def backfill(spark: SparkSession, landing_root: str, root: str, start, end, as_of: Column | None = None,
             layout: str = "partitioned", source: dict[str, DataFrame] | None = None) -> list[RunReport]:
    """Catch up every business date in ``[start, end]``, oldest first: one run (one commit
    version) per date, as a daily schedule with catch-up would. With ``source`` tables the dates
    are extracted first, all in one pass."""
    from tidemark.sources import landing as LD
    if source is not None:
        LD.run_extract(spark, source, landing_root, start, end)
        layout = "manifest"
    return [run_pipeline(spark, landing_root, root, day, as_of, layout) for day in LD.days_between(start, end)]


def read_mart(spark: SparkSession, root: str, name: str, buckets: int = MART_BUCKETS) -> DataFrame | None:
    """The current snapshot of a mart (as recorded by its mark)."""
    v = L.mark_of(spark, root, "gold", name)
    if name in BUCKETED:
        return Paths(root, buckets).bucketed(spark, name).read(v) if v >= 0 else None
    return L.read_snapshot(spark, Paths(root).mart(name), v)
