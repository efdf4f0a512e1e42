"""Order histories kept by a stream over the status-log commits.

The stream's state lets every log be held against the one before it of the same order, in whatever split the logs
arrive: late logs (an id below one already seen) take their place and become the predecessor of the next. Two bucketed
tables with copy-on-write versions hold it, a version per commit:

* ``logs``: the logs with the change time of their predecessor within the same (order, span), where a span is ``SPAN``
  consecutive log ids. An order that holds a third of all logs lies in many spans, so no group is larger than a span;
* ``edges``: per (order, span) the change time of its last log, which the next span's first log is held against.

A commit reads and writes only the buckets of its (order, span) pairs. It is read whole from its table, so a micro-batch
that brings only some of its files, or is run again, makes the same version again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.caching import persist, released
from tidemark.plans.checks import flag_transitions
from tidemark.schemas import ORDER_STATUS_LOG
from tidemark.sources import lake as L
from tidemark.sources.buckets import Buckets
from tidemark.streaming.incremental import run_available_now, stream_commits

SPAN = 1 << 16
GROUP = ("order_id", "span")
_LOG = ("log_id", "order_id", "old_status", "new_status", "changed_at")
LOGS = T.StructType([ORDER_STATUS_LOG[c] for c in _LOG] + [
    T.StructField("span", T.LongType()), T.StructField("first", T.BooleanType()), T.StructField("within", T.TimestampType())])
EDGES = T.StructType([ORDER_STATUS_LOG["order_id"], T.StructField("span", T.LongType()), T.StructField("last_changed_at", T.TimestampType())])


def placed(logs: DataFrame) -> DataFrame:
    """Logs of whole (order, span) groups with ``first`` and ``within`` (the change time of the log before, by id)."""
    by_id = Window.partitionBy(*GROUP).orderBy("log_id", "changed_at", "old_status", "new_status")
    return logs.select(*_LOG, "span", (F.row_number().over(by_id) == 1).alias("first"), F.lag("changed_at").over(by_id).alias("within"))


@dataclass
class OrderHistory:
    """The state below ``root``."""

    spark: SparkSession
    root: str
    n: int = 64

    def __post_init__(self):
        base = self.root.rstrip("/")
        self.logs = Buckets(self.spark, f"{base}/logs", GROUP, LOGS, self.n)
        self.edges = Buckets(self.spark, f"{base}/edges", ("order_id",), EDGES, self.n)

    def last_version(self, below: int | None = None) -> int:
        """The highest version (below another one); -1 if there is none. ``edges`` are written last, so theirs count."""
        made = [int(f.split("=")[1]) for f in L.folder(self.spark, f"{self.edges.root}/map") if f.startswith("version=")]
        return max((v for v in made if below is None or v < below), default=-1)

    def step(self, version: int, commit: DataFrame) -> None:
        """Version ``version``: the state before it with the logs of a commit. Logs without an id have no place and are left out."""
        before = self.last_version(version)
        with released():
            new = persist(commit.where("log_id is not null").select(*_LOG, F.floor(F.col("log_id") / SPAN).alias("span")))
            self.logs.change(version, before, new, lambda held, more: placed(held.select(*more.columns).unionByName(more)))
            # the groups that the commit changed, read back from the buckets it wrote
            groups = new.select(*GROUP).distinct()
            now = self.logs.read(version, self.logs.touched(groups)).alias("a").join(
                groups.alias("b"), F.col("a.order_id").eqNullSafe(F.col("b.order_id")) & (F.col("a.span") == F.col("b.span")), "left_semi")
            last = now.groupBy(*GROUP).agg(F.max_by("changed_at", "log_id").alias("last_changed_at"))

            def merge(held: DataFrame, changed: DataFrame) -> DataFrame:
                a, b = held.alias("a"), changed.alias("b")
                same = F.col("a.order_id").eqNullSafe(F.col("b.order_id")) & (F.col("a.span") == F.col("b.span"))
                return a.join(b, same, "left_anti").unionByName(changed)

            self.edges.change(version, before, persist(last), merge)

    def transitions(self, version: int | None = None) -> DataFrame:
        """The illegal or not advancing changes of all logs up to a version (the last one): what
        :func:`tidemark.plans.checks.status_transitions` tells of the same logs."""
        v = self.last_version() if version is None else version
        carried = self.edges.read(v).select("order_id", "span", F.lag("last_changed_at").over(Window.partitionBy("order_id").orderBy("span")).alias("carried"))
        a, b = self.logs.read(v).alias("a"), carried.alias("b")
        # only a group's first log looks beyond it: the others need no edge
        joined = a.join(b, F.col("a.first") & F.col("a.order_id").eqNullSafe(F.col("b.order_id")) & (F.col("a.span") == F.col("b.span")), "left")
        return flag_transitions(joined.select(*[f"a.{c}" for c in _LOG], F.when(F.col("a.first"), F.col("b.carried")).otherwise(F.col("a.within")).alias("prev_changed_at")))


def follow(spark: SparkSession, logs_path: str, history: OrderHistory, checkpoint: str) -> None:
    """Take all commits of the status log that have arrived since the last call into the history, in order, then stop."""

    def per_batch(batch: DataFrame, _batch_id: int) -> None:
        for v in sorted(r[0] for r in batch.select(L.CV).distinct().collect() if r[0] is not None):  # commits, not rows
            history.step(v, L.change_feed(spark, logs_path, ORDER_STATUS_LOG, v, v))

    run_available_now(stream_commits(spark, logs_path, ORDER_STATUS_LOG), checkpoint, per_batch)
