"""Layer-by-layer flow over the commerce views, as lazily composed DataFrames.

``fresh_*``   every landed commit processed as one batch into an empty lake (what a
              first back-fill produces); gold is computed from it.
``replay_*``  commit 0 is already in silver and the whole landed history (commits 0..2)
              arrives again; shows the "not yet loaded" / "already loaded" paths.

No function here touches storage; :mod:`tidemark.plans.pipeline` runs the same plans
against versioned tables.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.caching import materialize
from tidemark.plans import bronze as B
from tidemark.plans import gold as G
from tidemark.plans import silver as S
from tidemark.session import scratch_path
from tidemark.sources import commerce

AS_OF = "2001-08-01 00:00:00"  # fixed scoring time for reproducible churn labels


def as_of_col(value: str = AS_OF) -> Column:
    return F.to_timestamp(F.lit(value))


def landed(spark: SparkSession, sf_dir: str, name: str) -> B.Landed:
    """Every landed commit of a table, each behind its own gate."""
    return B.ingest(commerce.committed(spark, sf_dir, name), name, by=["commit_version"])


def bronze_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return landed(spark, sf_dir, name).accepted


class Landing:
    """The landed commits of every entity, ingested once and shared by all lakes built on them.

    The rows of a table are written when it is first asked for: the gate, every lake and every step of a cleaning read
    them, and each reading would join items with their orders, sum up the stock or look up the last states anew."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._landed: dict[str, B.Landed] = {}

    def landed(self, name: str) -> B.Landed:
        if name not in self._landed:
            written = materialize(commerce.committed(self.spark, self.sf_dir, name), f"landed-{name}")
            self._landed[name] = B.ingest(written, name, by=["commit_version"])
        return self._landed[name]


class SilverOf(Mapping[str, DataFrame]):
    """The silver tables of a lake by name, each cleaned when it is first asked for."""

    def __init__(self, lake: Lake):
        self.lake = lake

    def __getitem__(self, name: str) -> DataFrame:
        return self.lake.silver(name)

    def __iter__(self) -> Iterator[str]:
        return iter(commerce.VIEWS)

    def __len__(self) -> int:
        return len(commerce.VIEWS)


class Lake:
    """Silver tables of one flow, built once per instance (plans are shared, not data)."""

    def __init__(self, landing: Landing, before: Mapping[str, DataFrame] | None = None,
                 batch_filter: Column | None = None, materialize: bool = True):
        self.landing = landing
        self.materialize = materialize
        self.spark, self.sf_dir = landing.spark, landing.sf_dir
        self.before = {} if before is None else before
        self.batch_filter = batch_filter
        self._cleaned: dict[str, S.Cleaned] = {}

    def batch(self, name: str) -> DataFrame:
        df = self.landing.landed(name).accepted
        return df if self.batch_filter is None else df.filter(self.batch_filter)

    def cleaned(self, name: str) -> S.Cleaned:
        if name not in self._cleaned:
            before = self.before.get(name)
            b = self.batch(name)
            if name == "customers":
                out = S.silver_customers(b, before)
            elif name == "products":
                out = S.silver_products(b, before)
            elif name == "order_items":
                out = S.silver_order_items(b, before, self.silver("products"))
            elif name == "orders":
                out = S.silver_orders(b, before, self.silver("customers"), self.silver("order_items"))
            elif name == "inventory":
                out = S.silver_inventory(b, before, self.silver("products"))
            elif name == "order_status_log":
                out = S.silver_order_status_log(b, before, self.silver("orders"))
            else:
                raise KeyError(name)
            if self.materialize and not out.written:
                # Later steps read this table several times: write it once as parquet in the shared folder, by
                # sink, and scan that, instead of re-planning its whole lineage.
                out = S.Cleaned(write_and_read(out.routed, f"silver-{name}", by="sink"), written=True)
            self._cleaned[name] = out
        return self._cleaned[name]

    def silver(self, name: str) -> DataFrame:
        """Silver after this batch = silver before ∪ accepted."""
        acc = self.cleaned(name).accepted
        before = self.before.get(name)
        return acc if before is None else before.unionByName(acc)


def write_and_read(df: DataFrame, name: str, by: str) -> DataFrame:
    """Cut lineage: write ``df`` as parquet below the shared checkpoint folder, partitioned, scan it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").partitionBy(by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Lakes are memoised per (application, scale dir): every query of a session reads the
# same materialised silver tables, as queries over a real lake read its written tables.
_LAKES: dict[tuple[str, str, str], Lake] = {}


def _memo(kind: str, spark: SparkSession, sf_dir: str, build) -> Lake:
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _LAKES:
        _LAKES[key] = build()
    return _LAKES[key]


def fresh_lake(spark: SparkSession, sf_dir: str) -> Lake:
    return _memo("fresh", spark, sf_dir, lambda: Lake(landing_of(spark, sf_dir)))


def landing_of(spark: SparkSession, sf_dir: str) -> Landing:
    key = (spark.sparkContext.applicationId, sf_dir, "landing")
    if key not in _LAKES:
        _LAKES[key] = Landing(spark, sf_dir)  # type: ignore[assignment]
    return _LAKES[key]  # type: ignore[return-value]


def replay_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Silver already holds commit 0 (cleaned on its own); the batch is commits 0..2."""
    def build() -> Lake:
        landing = landing_of(spark, sf_dir)
        return Lake(landing, before=SilverOf(Lake(landing, batch_filter=F.col("commit_version") == 0)))
    return _memo("replay", spark, sf_dir, build)


def with_sink(c: S.Cleaned) -> DataFrame:
    """All rows of one cleaning step with their destination and, in quarantine, reason and layer."""
    return c.routed.withColumn("sink", F.when(F.col("sink") == "main", "silver").otherwise(F.col("sink"))).drop("commit_version")


# ---- gold over the fresh lake ---------------------------------------------------------------


def product_days(lake: Lake) -> DataFrame:
    return G.compact_product_days(G.product_day_partials(
        lake.silver("orders"), lake.silver("order_items"), lake.silver("products")))


def customer_360(lake: Lake, as_of: Column | None = None) -> DataFrame:
    orders = lake.silver("orders").drop("commit_version")
    return G.customer_360(None, orders, orders, lake.silver("customers"), as_of if as_of is not None else as_of_col())


def category_trends(lake: Lake) -> DataFrame:
    return G.category_trends(product_days(lake), lake.silver("orders"), lake.silver("order_items"),
                             lake.silver("products"))
