"""MERGE semantics on immutable snapshots.

A keyed upsert is one full outer join between the current snapshot and the source; the
result is written as the next snapshot. Source keys must be unique (as MERGE requires).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update_cols: list[str],
    set_exprs: dict[str, Column] | None = None,
) -> DataFrame:
    """WHEN MATCHED UPDATE SET update_cols, WHEN NOT MATCHED INSERT *.

    ``set_exprs`` overrides the value written (on update and insert) for some columns,
    e.g. ``{"updated_at": as_of}``. Columns of the target not in ``update_cols`` keep
    their target value on a match. Target rows without a source match are kept.
    """
    set_exprs = set_exprs or {}
    t = target.select(*[F.col(c).alias(f"t__{c}") for c in target.columns], F.lit(True).alias("t__hit"))
    s = source.select(*[F.col(c).alias(f"s__{c}") for c in source.columns], F.lit(True).alias("s__hit"))
    cond = None
    for k in keys:
        e = F.col(f"t__{k}") == F.col(f"s__{k}")
        cond = e if cond is None else cond & e
    j = t.join(s, cond, "full_outer")
    s_hit = F.col("s__hit").isNotNull()
    t_hit = F.col("t__hit").isNotNull()
    out = []
    for c in target.columns:
        src = set_exprs.get(c, F.col(f"s__{c}") if c in source.columns else F.lit(None))
        if c in keys:
            val = F.coalesce(F.col(f"t__{c}"), F.col(f"s__{c}"))
        elif c in update_cols:
            val = F.when(s_hit, src).otherwise(F.col(f"t__{c}"))
        else:
            val = F.when(t_hit, F.col(f"t__{c}")).otherwise(src)
        out.append(val.cast(target.schema[c].dataType).alias(c))
    return j.select(*out)


def merge_update_only(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str]) -> DataFrame:
    """WHEN MATCHED UPDATE SET update_cols; never inserts."""
    s = source.select(*keys, *[F.col(c).alias(f"s__{c}") for c in update_cols], F.lit(True).alias("s__hit"))
    j = target.join(s, keys, "left")
    out = []
    for c in target.columns:
        if c in update_cols:
            out.append(F.when(F.col("s__hit").isNotNull(), F.col(f"s__{c}")).otherwise(F.col(c))
                       .cast(target.schema[c].dataType).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)
