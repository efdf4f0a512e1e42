"""An order-statistics index for single pages: a page reads only the key ranges that hold its rows.

The rows are range-partitioned on the listing's order and written once, a folder per range, each row with its place in the
range; the index counts the rows of every (range, business day). A page's rank interval is then found by adding counts (a
row per range), and only the ranges that it meets are opened: two at most while a range has as many rows as a page. A
dated listing counts just its days. Ordered by key, any span of days can be listed; ordered by (day, key)
(``by_day``), a single day's rows are neighbours, so that its pages touch one or two ranges as well.

    <root>/rows/_range=i/...      rows with _day and _pos
    <root>/counts/...             (_range, _day, rows)
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import shuffle_partitions
from tidemark.sources.lake import empty

_LOW_BITS = 33  # monotonically_increasing_id = partition << 33 | row


@dataclass(frozen=True)
class PageIndex:
    """The written listing at ``root`` of rows of ``schema``."""

    spark: SparkSession
    root: str
    schema: T.StructType

    @classmethod
    def build(cls, df: DataFrame, root: str, order: list[Column], day: Column | None = None, by_day: bool = False, ranges: int | None = None) -> PageIndex:
        """Write ``df`` and its counts. ``order`` must be total; ``day``: the business day of a row (may be null)."""
        spark = df.sparkSession
        dated = df.withColumn("_day", F.lit(None).cast("string") if day is None else F.date_format(day.cast("date"), "yyyy-MM-dd"))
        by = [F.col("_day").asc_nulls_first(), *order] if by_day else order
        n = ranges or shuffle_partitions(spark)
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _LOW_BITS) - 1))
        (dated.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("_range", F.spark_partition_id()).withColumn("_pos", place)
         .write.mode("overwrite").partitionBy("_range").parquet(f"{root}/rows"))
        index = cls(spark, root, df.schema)
        counts = index._rows().groupBy("_range", "_day").agg(F.count("*").alias("rows"))
        counts.coalesce(1).write.mode("overwrite").parquet(f"{root}/counts")
        return index

    def _stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("_day", T.StringType()), T.StructField("_pos", T.LongType())])

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(T.StructType([*self._stored().fields, T.StructField("_range", T.IntegerType())])).parquet(f"{self.root}/rows")

    @staticmethod
    def _within(df: DataFrame, first: str | None, last: str | None) -> DataFrame:
        """Rows of the days first to last, inclusive; an open side has no bound, and without bounds undated rows count too."""
        if first is not None:
            df = df.where(F.col("_day") >= str(first)[:10])
        return df if last is None else df.where(F.col("_day") <= str(last)[:10])

    def counts(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """(_range, rows, start): rows of each range that are in the listing, and the rank (from 0) of its first."""
        counts = self.spark.read.schema("_range int, _day string, rows bigint").parquet(f"{self.root}/counts")
        per = self._within(counts, first, last).groupBy("_range").agg(F.sum("rows").alias("rows"))
        before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
        return per.withColumn("start", F.coalesce(F.sum("rows").over(before), F.lit(0)))

    def page(self, number: int, limit: int, first: str | None = None, last: str | None = None) -> DataFrame:
        """Page ``number`` (from 1) of the listing: its rows with ``page``, ``total_pages`` and ``row_in_page``."""
        if limit <= 0 or number <= 0:
            raise ValueError("page and limit must be positive")
        lo = (number - 1) * limit
        per = self.counts(first, last)
        total = per.agg(F.sum("rows")).first()[0] or 0
        hit = per.where((F.col("start") < lo + limit) & (F.col("start") + F.col("rows") > lo)).collect()  # the ranges of one page
        out = T.StructType([*self.schema.fields, *[T.StructField(c, T.LongType()) for c in ("page", "total_pages", "row_in_page")]])
        if not hit:
            return empty(self.spark, out)
        rows = None
        for r in hit:
            part = self._within(self.spark.read.schema(self._stored()).parquet(f"{self.root}/rows/_range={r['_range']}"), first, last)
            ranked = part.withColumn("_rank", F.lit(r["start"]) + F.row_number().over(Window.orderBy("_pos")) - 1)  # one range
            part = ranked.where(F.col("_rank").between(lo, lo + limit - 1))
            rows = part if rows is None else rows.unionByName(part)
        return rows.select(*self.schema.fieldNames(), F.lit(number).cast("bigint").alias("page"), F.lit(-(-total // limit)).cast("bigint").alias("total_pages"),
                           (F.col("_rank") - lo + 1).cast("bigint").alias("row_in_page"))
