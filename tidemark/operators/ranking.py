"""Global rank, ntile and page numbers without a single-partition window.

``Window.orderBy(...)`` with no partition moves every row into one task. Instead:

1. range-partition on the ordering (Spark samples the bounds), sort inside partitions;
2. record each row's partition and its position inside it (``monotonically_increasing_id``
   encodes both) and write them with the rows, so both passes read the same labels;
3. count rows per partition (one row per partition), turn the counts into starting
   offsets with a tiny window over the partition ids, and join them back with a
   broadcast (its size is the partition count, not the data size);
4. global 0-based rank = offset + position; N = total count.

The ordering must be total (append a unique key as tie-break) so that a recomputed
partition yields identical ranks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.caching import materialize
from tidemark.session import shuffle_partitions

RANK = "_rank"
TOTAL = "_total"
_LOW_BITS = 33  # monotonically_increasing_id = partition_index << 33 | row_index


def distributed_rank(df: DataFrame, order: list[Column], num_partitions: int | None = None) -> DataFrame:
    """Return ``df`` plus ``_rank`` (0-based global position) and ``_total`` (row count)."""
    spark = df.sparkSession
    n = num_partitions or shuffle_partitions(spark)
    staged = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _LOW_BITS) - 1)))
    )
    # Written once: the count pass and the rank pass read the same labels and positions
    # (a cache could be rebuilt with re-sampled range bounds between them).
    staged = materialize(staged, "rank-ranges")
    counts = staged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: a window over the partition ids is bounded by n, not by data.
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part",
        F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset"),
        F.sum("_n").over(Window.partitionBy(F.lit(1))).alias(TOTAL),
    )
    ranked = staged.join(F.broadcast(offsets), "_part").withColumn(RANK, F.col("_offset") + F.col("_pos"))
    return ranked.drop("_part", "_pos", "_offset")


def ntile_of(rank0: Column, total: Column, k: int) -> Column:
    """Same buckets as SQL ``ntile(k)``: the first ``N mod k`` tiles get one extra row."""
    q = F.floor(total / k)
    m = total - q * k
    big = (q + 1) * m
    return (
        F.when(rank0 < big, F.floor(rank0 / (q + 1)))
        .otherwise(m + F.floor((rank0 - big) / F.greatest(q, F.lit(1))))
        + 1
    ).cast("int")


def distributed_ntile(df: DataFrame, order: list[Column], k: int, out: str = "ntile",
                      num_partitions: int | None = None) -> DataFrame:
    ranked = distributed_rank(df, order, num_partitions)
    return ranked.withColumn(out, ntile_of(F.col(RANK), F.col(TOTAL), k)).drop(RANK, TOTAL)


def assign_pages(df: DataFrame, order: list[Column], limit: int, group_by: list[str] | None = None,
                 num_partitions: int | None = None) -> DataFrame:
    """All pages of a paged listing in one pass.

    page = floor(rank / limit) + 1, total_pages = ceil(N / limit); equal to issuing
    ``ORDER BY ... LIMIT limit OFFSET (page-1)*limit`` for every page. With ``group_by``
    each group (e.g. a business date) is paged on its own: the global rank over
    (group, order) minus the group's first rank, and the group's own row count.
    """
    if limit <= 0:
        raise ValueError("limit must be positive")
    group_by = list(group_by or [])
    ranked = distributed_rank(df, [F.col(g) for g in group_by] + list(order), num_partitions)
    if group_by:
        # One row per group, written, so that the planner knows its size before it moves the rows: few groups go
        # to the rows, and a group with a large share of them stays spread over the tasks that ranked it.
        starts = materialize(ranked.groupBy(*group_by).agg(F.min(RANK).alias("_start"), F.count(F.lit(1)).alias("_n")), "rank-groups")
        ranked = (ranked.join(starts, group_by)
                  .withColumn(RANK, F.col(RANK) - F.col("_start"))
                  .withColumn(TOTAL, F.col("_n"))
                  .drop("_start", "_n"))
    return (
        ranked.withColumn("page", (F.floor(F.col(RANK) / limit) + 1).cast("bigint"))
        .withColumn("total_pages", F.ceil(F.col(TOTAL) / limit).cast("bigint"))
        .withColumn("row_in_page", (F.col(RANK) % limit + 1).cast("bigint"))
        .drop(RANK, TOTAL)
    )
