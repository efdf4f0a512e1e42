"""Versioned tables on plain Parquet.

* A layer table is a Parquet dataset partitioned by ``commit_version`` and ``sink``; one
  commit is one directory holding the step's rows (``sink=main``) and the rows it
  quarantined (``sink=quarantine``), written by one job. Writing commit *v* overwrites
  only directory *v*, so re-running a commit replaces it instead of duplicating it.
* A snapshot read is the whole dataset (optionally up to a version); a change-feed read
  is a ``commit_version`` range filter, which Spark turns into partition pruning.
* A mart is a sequence of immutable snapshot directories; "overwrite" writes the next
  snapshot and the marks table points readers at it, so a plan never overwrites the
  path it is reading.
* Marks (the per layer/table high-water marks) are a small Parquet table of
  ``(layer, table_name, version, status, seq)`` rows; the current mark is the row of the highest
  ``seq``, so a re-run can set a mark back (see :class:`Marks`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import CORRUPT

CV = "commit_version"
SINK = "sink"          # 'main' rows of the table, 'quarantine' rows rejected by its step
QUARANTINE_COLS = ("reason", "layer", CORRUPT)
FEED_COLS = ("_change_type", "_commit_version")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does ``path`` exist on its filesystem (local, HDFS or object store)?"""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def folder(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of one folder (not below it); none if it is not there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def with_commit_schema(schema: T.StructType) -> T.StructType:
    fields = [f for f in schema.fields if f.name not in (CV, SINK)]
    return T.StructType(fields + [T.StructField(CV, T.IntegerType()), T.StructField(SINK, T.StringType())])


def commit_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/{CV}={version}"


def commit_append(df: DataFrame, path: str, version: int, quarantine: DataFrame | None = None) -> None:
    """Write commit ``version`` of the table at ``path``: its rows and, in the same job, the
    rows its step quarantined (``sink=main`` / ``sink=quarantine`` sub-directories).

    The commit directory is overwritten as a whole, so re-running a commit replaces it
    (idempotent) and never touches other commits. Within it Spark writes one file per
    task, so the write is as parallel as the plan that produced ``df``.
    """
    cols = [c for c in df.columns if c not in (CV, SINK)]
    out = df.select(*cols).withColumn(SINK, F.lit("main"))
    if quarantine is not None:
        # quarantined rows take the table's column types (a union would otherwise widen them)
        typed = quarantine.select(*[F.col(c).cast(df.schema[c].dataType).alias(c) for c in cols])
        out = out.unionByName(typed.withColumn(SINK, F.lit("quarantine")))
    # static: the whole commit directory is replaced, including a sink this run leaves empty
    (out.write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(SINK).parquet(commit_path(path, version)))


def commit_routed(routed: DataFrame, path: str, version: int) -> None:
    """Write commit ``version`` from rows that carry their ``sink`` (and ``reason``, ``layer``): one job, one pass over
    the plan, a sub-directory per sink. As :func:`commit_append` it replaces the commit as a whole."""
    (routed.drop(CV).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(SINK).parquet(commit_path(path, version)))


def read_quarantine(spark: SparkSession, path: str, schema: T.StructType, upto: int | None = None) -> DataFrame:
    """The quarantined rows of a commit table with ``reason``, ``layer`` and what could not be parsed."""
    names = [f.name for f in schema.fields]
    more = [T.StructField(c, T.StringType()) for c in QUARANTINE_COLS if c not in names]
    return read_table(spark, path, T.StructType(list(schema.fields) + more), upto, sink="quarantine")


def read_table(spark: SparkSession, path: str, schema: T.StructType, upto: int | None = None,
               sink: str = "main") -> DataFrame:
    """Snapshot of a commit table (all commits, or those <= ``upto``); empty if absent.

    Both filters are on partition columns, so they prune directories at planning time.
    """
    full = with_commit_schema(schema)
    if not path_exists(spark, path):
        return empty(spark, full).drop(SINK)
    df = spark.read.schema(full).parquet(path).filter(F.col(SINK) == sink)
    if upto is not None:
        df = df.filter(F.col(CV) <= upto)
    return df.drop(SINK)


def change_feed(spark: SparkSession, path: str, schema: T.StructType, start: int, end: int | None = None,
                with_metadata: bool = False) -> DataFrame:
    """Rows committed in ``[start, end]`` (``end`` None = open-ended), partition-pruned.

    Every commit is an append, so each feed row is an insert; ``with_metadata`` adds the
    ``_change_type`` / ``_commit_version`` columns a change-feed reader expects.
    """
    cond: Column = F.col(CV) >= start
    if end is not None:
        cond = cond & (F.col(CV) <= end)
    df = read_table(spark, path, schema).filter(cond)
    if with_metadata:
        df = df.withColumn("_change_type", F.lit("insert")).withColumn("_commit_version", F.col(CV).cast("bigint"))
    return df


def drop_feed_metadata(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in FEED_COLS if c in df.columns])


# ---- snapshots (full-overwrite marts) --------------------------------------------------------


def snapshot_path(root: str, snapshot: int) -> str:
    return f"{root.rstrip('/')}/snapshot={snapshot}"


def write_snapshot(df: DataFrame, root: str, snapshot: int) -> str:
    """Write a new immutable snapshot directory; readers switch to it via the marks."""
    path = snapshot_path(root, snapshot)
    df.write.mode("overwrite").parquet(path)
    return path


def read_snapshot(spark: SparkSession, root: str, snapshot: int | None, schema: T.StructType | None = None
                  ) -> DataFrame | None:
    """The snapshot ``snapshot`` of a mart, or None when there is none yet."""
    if snapshot is None or snapshot < 0:
        return None
    path = snapshot_path(root, snapshot)
    if not path_exists(spark, path):
        return None
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


# ---- marks -----------------------------------------------------------------------------------

MARKS_SCHEMA = T.StructType([
    T.StructField("layer", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("seq", T.LongType()),
])
REWOUND = "rewound"


def marks_path(root: str) -> str:
    return f"{root.rstrip('/')}/_marks"


class Marks:
    """The marks of a lake, read once and kept in step with what this run records.

    Each record writes the whole list (a few rows a run) as one file of a new generation; readers take the latest complete one,
    so a run opens one small file however many runs there were. One run writes at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        done = [int(f.split("=")[1]) for f in folder(spark, marks_path(root)) if f.startswith("gen=")]
        self.generation, self.rows = -1, []
        for gen in sorted(done, reverse=True):
            path = f"{marks_path(root)}/gen={gen}"
            if path_exists(spark, f"{path}/_SUCCESS"):
                found = spark.read.schema(MARKS_SCHEMA).parquet(path).collect()
                self.generation, self.rows = gen, sorted((tuple(r) for r in found), key=lambda r: r[4])
                break

    def current(self) -> dict[tuple[str, str], int]:
        """The version recorded last per (layer, table)."""
        return {(layer, table): version for layer, table, version, _, _ in self.rows}

    def of(self, layer: str, table: str) -> int:
        return self.current().get((layer, table), -1)

    def last_before(self, layer: str, table: str, version: int) -> int:
        """The newest version below ``version`` that (layer, table) ever completed; -1 if none."""
        return max((v for lay, t, v, status, _ in self.rows if (lay, t) == (layer, table) and v < version and status != REWOUND), default=-1)

    def last_done(self, layer: str) -> int:
        """The newest version that any table of ``layer`` ever completed; -1 if none."""
        return max((v for lay, _, v, status, _ in self.rows if lay == layer and status != REWOUND), default=-1)

    def record(self, rows: list[tuple[str, str, int, str]]) -> None:
        """Record marks (layer, table, version, status); after the data they stand for."""
        if not rows:
            return
        seq = self.rows[-1][4] + 1 if self.rows else 0
        after = self.rows + [(a, b, int(c), d, seq + k) for k, (a, b, c, d) in enumerate(rows)]
        gen = max([self.generation, *(int(f.split("=")[1]) for f in folder(self.spark, marks_path(self.root)) if f.startswith("gen="))]) + 1
        self.spark.createDataFrame(after, MARKS_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{marks_path(self.root)}/gen={gen}")
        self.generation, self.rows = gen, after


def read_marks(spark: SparkSession, root: str) -> DataFrame:
    """Current mark per (layer, table): the version recorded last."""
    return spark.createDataFrame([(a, b, v) for (a, b), v in Marks(spark, root).current().items()], "layer string, table_name string, version int")


def mark_of(spark: SparkSession, root: str, layer: str, table: str) -> int:
    return Marks(spark, root).of(layer, table)


def last_version_before(spark: SparkSession, root: str, layer: str, table: str, version: int) -> int:
    return Marks(spark, root).last_before(layer, table, version)


def advance_mark(spark: SparkSession, root: str, layer: str, table: str, version: int, status: str = "ok") -> None:
    """Record that (layer, table) has processed up to ``version``; written after the data."""
    advance_marks(spark, root, [(layer, table, version, status)])


def advance_marks(spark: SparkSession, root: str, rows: list[tuple[str, str, int, str]]) -> None:
    """Record several marks at once (one write per layer and run)."""
    Marks(spark, root).record(rows)


PENDING_COLS = ["status", "from_version", "to_version"]


def pending_versions(upstream: Column, downstream: Column) -> list[Column]:
    """Compare two marks: equal → up to date; downstream ahead → conflict; behind → the
    versions downstream+1 … upstream are pending."""
    status = (F.when(upstream == downstream, "up_to_date")
              .when(downstream > upstream, "conflict")
              .otherwise("pending"))
    pending = upstream > downstream
    return [status.alias("status"),
            F.when(pending, downstream + 1).alias("from_version"),
            F.when(pending, upstream).alias("to_version")]
