"""Landing zone: dated, paged extracts as JSON.

Three layouts are read:
* ``manifest`` – what :func:`run_extract` publishes: a JSON array per page in a staging folder of the run, and per
  business date one manifest that lists its files. A manifest is written when its files are there, a date extracted
  anew gets a later one, and readers open the files of the latest, so they list neither history nor what a
  broken run left behind.
* ``pages`` – the original layout, ``<table>/<yyyy-MM-dd>_file_<page>.json``, each file a
  JSON array. The date is selected with an anchored ``pathGlobFilter`` in the reader
  (no driver-side listing loop, no substring match on the whole path).
* ``partitioned`` – what :func:`write_extract` produces: ``<table>/dt=<date>/page=<n>/``
  JSON-lines files; the date is a partition filter, pruned at planning time.

Schemas are always declared: inference costs a pass and fails on empty input.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.caching import materialize
from tidemark.operators.ranking import assign_pages
from tidemark.plans.extracts import PAGE_LIMITS, PRIMARY_KEYS, dated_pages, rows_of_days
from tidemark.schemas import CORRUPT, ENTITIES
from tidemark.session import shuffle_partitions
from tidemark.sources.lake import empty, path_exists


def day_str(date: str | _dt.date | _dt.datetime) -> str:
    """First 10 characters of an ISO date/datetime (the business date of a run)."""
    if isinstance(date, (_dt.date, _dt.datetime)):
        return date.isoformat()[:10]
    return str(date)[:10]


def json_schema(table: str) -> T.StructType:
    return ENTITIES[table]


TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"  # microseconds survive the JSON round trip


def read_pages(spark: SparkSession, table_dir: str, table: str, date) -> DataFrame:
    """Rows of one business date from ``<date>_file_<n>.json`` arrays (original layout)."""
    if not path_exists(spark, table_dir):
        return empty(spark, json_schema(table))
    return (spark.read.schema(json_schema(table)).option("multiLine", True)
            .option("timestampFormat", TS_FORMAT)
            .option("pathGlobFilter", f"{day_str(date)}_file_*.json").json(table_dir))


def read_partitioned(spark: SparkSession, table_dir: str, table: str, date=None) -> DataFrame:
    """Rows of the ``dt=/page=`` layout; ``date`` None reads every landed date."""
    schema = T.StructType(list(json_schema(table).fields) + [
        T.StructField("dt", T.StringType()), T.StructField("page", T.LongType())])
    if not path_exists(spark, table_dir):
        return empty(spark, schema)
    df = spark.read.schema(schema).option("timestampFormat", TS_FORMAT).json(table_dir)
    return df if date is None else df.filter(F.col("dt") == day_str(date))


def write_extract(df: DataFrame, table_dir: str, table: str, date_col: str, limit: int | None = None) -> None:
    """Land every business date of ``df`` as pages of ``limit`` rows, all in one job.

    Page numbers come from one distributed rank per date; each (dt, page) becomes a
    partition directory, so one page is one small directory as in the original layout.
    """
    pages = dated_pages(df, table, date_col, limit)
    out = pages.drop("total_pages", "row_in_page")
    (out.repartition("dt", "page").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
     .partitionBy("dt", "page").json(table_dir))


# ---- extracts published by manifest ----------------------------------------------------------

WRITE_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
FILE_SCHEMA = "table_name string, dt string, page bigint, rows bigint, path string, bytes bigint"
OPEN_COST = "spark.sql.files.openCostInBytes"  # what a file counts for, beside its bytes, when files are dealt to tasks
PAGE_COST = "128k"


def days_between(first, last=None) -> list[str]:
    day, end = (_dt.date.fromisoformat(day_str(d)) for d in (first, last or first))
    return [(day + _dt.timedelta(days=k)).isoformat() for k in range((end - day).days + 1)]


def manifest_path(landing_root: str, date: str) -> str:
    return f"{landing_root.rstrip('/')}/_manifests/dt={date}"


def run_extract(spark: SparkSession, source: dict[str, DataFrame], landing_root: str, first, last=None,
                limits: dict[str, int] | None = None) -> list[str]:
    """Land the rows of every business date in [first, last] out of the ``source`` tables; returns the dates published.

    One pass over the union of the tables: a distributed rank numbers the rows of each (table, date) by primary key
    (ties by the row's text), which gives their page; a page is one file with one JSON array, written to a staging
    folder of this run. Then the files are listed and their rows counted, and each date's manifest is published.
    A table without rows for a date has no file and an entry without path.

    The pages of a (table, date) lie in one folder: a folder per page would have to be made, moved and listed for each of
    them. Which page a file holds is told by its text; pages with the same text take its files in turn.
    """
    limits = {**PAGE_LIMITS, **(limits or {})}
    rows = None
    for name, df in rows_of_days(source, first, last or first).items():
        body = F.to_json(F.struct(*ENTITIES[name].fieldNames()), {"timestampFormat": WRITE_TS_FORMAT, "ignoreNullFields": "false"})
        part = df.select(F.lit(name).alias("table_name"), "dt", F.col(PRIMARY_KEYS[name]).cast("bigint").alias("_key"), body.alias("_body"),
                         F.lit(limits[name]).alias("_limit"))
        rows = part if rows is None else rows.unionByName(part)
    days, tables = days_between(first, last), list(source)
    staging = f"{landing_root.rstrip('/')}/_staging/{uuid.uuid4().hex}"
    # a group's own limit: pages of one row first, then the limit of the table over the position
    placed = assign_pages(rows, [F.col("_key").asc_nulls_first(), F.col("_body")], 1, group_by=["table_name", "dt"])
    paged = placed.withColumn("_row", F.col("page")).withColumn("page", F.floor((F.col("_row") - 1) / F.col("_limit")) + 1)
    array = F.transform(F.sort_array(F.collect_list(F.struct("_row", "_body"))), lambda r: r["_body"])  # at most a page's limit
    dealt = paged.repartitionByRange(shuffle_partitions(spark), "table_name", "dt", "page")  # few tasks write to a folder
    pages = materialize(dealt.groupBy("table_name", "dt", "page").agg(F.concat(F.lit("[\n"), F.array_join(array, ",\n"), F.lit("\n]")).alias("value")), "extract-pages")
    files = empty(spark, T.StructType.fromDDL(FILE_SCHEMA))
    if not pages.isEmpty():
        pages.drop("page").write.option("maxRecordsPerFile", 1).partitionBy("table_name", "dt").text(staging)
        text = spark.read.schema("value string, table_name string, dt string").text(staging, wholetext=True)
        stored = text.select("table_name", "dt", F.md5(F.col("value").cast("binary")).alias("_digest"), F.json_array_length("value").cast("bigint").alias("rows"),
                             F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"))
        named = pages.select("table_name", "dt", F.md5(F.concat("value", F.lit("\n")).cast("binary")).alias("_digest"), "page")
        same = ["table_name", "dt", "_digest"]
        files = (_in_turn(named, same, "page").join(_in_turn(stored, same, "path"), [*same, "_nth"])
                 .select("table_name", "dt", F.col("page").cast("bigint").alias("page"), "rows", "path", "bytes"))
    expected = spark.createDataFrame([(t, d) for t in tables for d in days], "table_name string, dt string")
    with _many_small_files(spark):
        publish(spark, landing_root, expected.join(files, ["table_name", "dt"], "left"), days)
    return days


def _in_turn(df: DataFrame, same: list[str], order: str) -> DataFrame:
    return df.withColumn("_nth", F.row_number().over(Window.partitionBy(*same).orderBy(order)))


@contextmanager
def _many_small_files(spark: SparkSession) -> Iterator[None]:
    """Jobs inside deal hundreds of pages to a task that reads them; at the session's cost of a file it would be a handful."""
    before = spark.conf.get(OPEN_COST)
    spark.conf.set(OPEN_COST, PAGE_COST)
    try:
        yield
    finally:
        spark.conf.set(OPEN_COST, before)


def files_of(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes) of the files below ``path``; nothing of their content is read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.col("_metadata.file_path").alias("path"), F.col("length").alias("bytes"))


def publish(spark: SparkSession, landing_root: str, files: DataFrame, days: list[str]) -> None:
    """Make ``files`` the manifest of each of ``days``: a new attempt, one file per date, that replaces the former on reading."""
    before = _attempts(spark, landing_root, days)
    last = None if before is None else before.agg(F.max("attempt")).first()[0]
    entries = files.select("table_name", "dt", "page", "rows", "path", "bytes").withColumn("attempt", F.lit(0 if last is None else last + 1).cast("bigint"))
    (entries.repartition("dt").write.mode("append").partitionBy("dt", "attempt").parquet(f"{landing_root.rstrip('/')}/_manifests"))


def _attempts(spark: SparkSession, landing_root: str, days: list[str]) -> DataFrame | None:
    """Every attempt of the days' manifests; the folders of other dates are not listed."""
    paths = [p for p in (manifest_path(landing_root, d) for d in days) if path_exists(spark, p)]
    if not paths:
        return None
    schema = T.StructType.fromDDL(FILE_SCHEMA + ", attempt bigint")
    return spark.read.schema(schema).option("basePath", f"{landing_root.rstrip('/')}/_manifests").parquet(*paths)


def read_manifest(spark: SparkSession, landing_root: str, first, last=None) -> DataFrame:
    """The published files of the dates: (table_name, dt, page, rows, path, bytes, attempt), the latest attempt of each date."""
    found = _attempts(spark, landing_root, days_between(first, last))
    if found is None:
        return empty(spark, T.StructType.fromDDL(FILE_SCHEMA + ", attempt bigint"))
    latest = found.groupBy("dt").agg(F.max("attempt").alias("attempt"))
    return found.join(latest, ["dt", "attempt"]).select(*found.columns)


def read_landed(spark: SparkSession, landing_root: str, table: str, first, last=None) -> DataFrame:
    """Rows of the dates' published arrays with ``dt``; a file that does not parse is one row with its text in ``_corrupt_record``."""
    schema = T.StructType(list(json_schema(table).fields) + [T.StructField(CORRUPT, T.StringType())])
    listed = read_manifest(spark, landing_root, first, last).where((F.col("table_name") == table) & F.col("path").isNotNull())
    out = empty(spark, T.StructType(list(schema.fields) + [T.StructField("dt", T.StringType())]))
    paths = [r["path"] for r in listed.select("path").collect()]  # one table's pages of the dates asked for
    if not paths:
        return out
    rows = (spark.read.schema(schema).option("multiLine", True).option("timestampFormat", TS_FORMAT)
            .option("columnNameOfCorruptRecord", CORRUPT).json(paths))
    # the date is the manifest's: a republished file may lie anywhere
    dated = rows.withColumn("_path", F.col("_metadata.file_path"))
    return dated.join(F.broadcast(listed.select(F.col("path").alias("_path"), "dt")), "_path").drop("_path")
