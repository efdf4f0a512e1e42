"""Repair, de-duplication and key checks of the cleaning layer.

All set operations on keys are joins; null keys never match, so a row with a null key
is never "already loaded" and is always "rejected".
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Replace nulls per column (only columns present in ``df``)."""
    present = {c: v for c, v in defaults.items() if c in df.columns}
    return df.na.fill(present) if present else df


def dedup_rows(df: DataFrame) -> DataFrame:
    """Full-row de-duplication; map-side partial aggregation collapses hot copies early."""
    return df.dropDuplicates()


def dedup_by_key(df: DataFrame, keys: list[str], first: list[str] | None = None) -> DataFrame:
    """One row per key: the smallest row in column order (nulls first).

    Same survivor as ``row_number() over (partition by keys order by <first>, <other
    columns>) = 1`` but computed as ``min(struct(...))``, an aggregate with a partial
    (map-side) step, so a key holding a large share of the rows is reduced before the
    shuffle instead of being sorted in one task.
    """
    first = [c for c in (first or []) if c not in keys]
    rest = first + [c for c in df.columns if c not in keys and c not in first]
    if not rest:
        return df.dropDuplicates(keys)
    best = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_best"))
    return best.select(*keys, *[F.col("_best")[c].alias(c) for c in rest]).select(*df.columns)


def ref_check_semi(df: DataFrame, ref: DataFrame, key: str, ref_key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` exists in ``ref.ref_key`` (referential check)."""
    r = ref.select(F.col(ref_key).alias("_ref_key"))
    return df.join(r, df[key] == r["_ref_key"], "left_semi")


def seen_keys(batch: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of ``existing`` that the batch holds too.

    The batch's distinct keys go against the big table first, so that what is held against the whole batch
    has at most as many rows as the batch has keys, however often a key repeats in ``existing``. Both
    joins are plain equi-joins: adaptive execution broadcasts a side whose measured size allows it.
    """
    wanted = batch.select(*keys).dropna().dropDuplicates()
    return existing.select(*keys).join(wanted, keys, "left_semi").dropDuplicates()


_seen_keys = seen_keys  # its former name


def new_rows_anti(batch: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``existing`` ("not yet loaded")."""
    return batch.join(seen_keys(batch, existing, keys), keys, "left_anti")


def dup_rows_semi(batch: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``batch`` whose key is already in ``existing`` (repeats → quarantine)."""
    return batch.join(seen_keys(batch, existing, keys), keys, "left_semi")


def rejected_rows_anti(batch: DataFrame, accepted: DataFrame, keys: list[str]) -> DataFrame:
    """batch − accepted on the key; a null key is always rejected."""
    return batch.join(accepted.select(*keys).dropDuplicates(), keys, "left_anti")
