"""Skew-safe "previous row" (lag 1) within a key.

A plain ``lag(...).over(Window.partitionBy(k).orderBy(t))`` sends every row of a key to
one task; with a key that holds a third of all rows that task becomes the whole job.
Here the rows are first range-partitioned on (key, order) and each row is labelled with
its range (``_part``); the label is written with the rows (a table in the shared
folder), so every later pass sees the same labels. Then:

* lag inside each (key, range) group with the built-in window (a group is at most one
  range, so a hot key is spread over many balanced tasks);
* for each range, the last row (one aggregate row per range) and, through a window over
  those few rows, the last row of the previous non-empty range;
* the first row of a (key, range) group takes that carried row when its key matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.caching import materialize
from tidemark.session import shuffle_partitions


def lag_within(
    df: DataFrame,
    partition_by: list[str],
    order_by: list[str],
    value_cols: dict[str, str],
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``alias = lag(src, 1)`` for each ``src -> alias`` in ``value_cols``.

    ``order_by`` must make the order total within a key (add a unique column), so the
    result is deterministic.
    """
    spark = df.sparkSession
    n = num_partitions or shuffle_partitions(spark)
    keys, vals = list(partition_by), list(value_cols)
    ordering = keys + list(order_by)
    labelled = materialize(df.repartitionByRange(n, *ordering).withColumn("_part", F.spark_partition_id()),
                           "lag-ranges")

    w = Window.partitionBy(*keys, "_part").orderBy(*order_by)
    inner = labelled.select(
        "*", F.row_number().over(w).alias("_rn"),
        *[F.lag(src).over(w).alias(f"_in_{alias}") for src, alias in value_cols.items()])

    # last row of each range (one row per range), then the previous non-empty range's last row
    tails = labelled.groupBy("_part").agg(
        F.max_by(F.struct(*[F.col(c).alias(f"k_{c}") for c in keys], *[F.col(c).alias(f"v_{c}") for c in vals]),
                 F.struct(*ordering)).alias("_t"))
    carry = tails.select("_part", F.lag("_t").over(Window.orderBy("_part")).alias("_c"))  # rows = ranges

    joined = inner.join(F.broadcast(carry), "_part", "left")
    same_key: Column = F.col("_c").isNotNull()
    for k in keys:
        same_key = same_key & F.col(k).eqNullSafe(F.col(f"_c.k_{k}"))
    first = F.col("_rn") == 1
    outs = [F.when(first, F.when(same_key, F.col(f"_c.v_{src}"))).otherwise(F.col(f"_in_{alias}")).alias(alias)
            for src, alias in value_cols.items()]
    return joined.select(*df.columns, *outs)
