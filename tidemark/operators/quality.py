"""Null-key split and the bad-row gate of the landing layer."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SplitRule:
    """Which rows are accepted and which are quarantined.

    The two predicates are independent on purpose: some tables accept and quarantine
    overlapping sets (a half-null composite key goes to both), others let a row fall
    into neither.
    """

    valid: Column
    invalid: Column


def all_present(*cols: str) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & F.col(c).isNotNull()
    return out


def any_present(*cols: str) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | F.col(c).isNotNull()
    return out


def any_missing(*cols: str) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | F.col(c).isNull()
    return out


def split_valid(df: DataFrame, rule: SplitRule) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined); both are filters over the same input, one scan each."""
    return df.filter(rule.valid), df.filter(rule.invalid)


GATE_COLS = ["rows", "bad_rows", "passed"]


def gate_passes(rows: int, bad_rows: int, max_bad_share: float = 0.3, strict: bool = False) -> bool:
    """The verdict on counts that are known: as :func:`quality_gate` has it."""
    limit = Decimal(rows) * Decimal(str(max_bad_share))
    return bad_rows <= limit if strict else bad_rows < limit


def quality_gate(df: DataFrame, rule: SplitRule, max_bad_share: float = 0.3, strict: bool = False, by: list[str] | None = None) -> DataFrame:
    """Verdict from a single aggregate: (rows, bad_rows, passed), one row, or one per value of the columns ``by``.

    The batch is rejected when ``bad >= share * rows`` (``strict`` → only when ``bad >
    share * rows``); the share is compared exactly as a decimal.
    """
    share = F.lit(Decimal(str(max_bad_share)))
    agg = df.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.coalesce(rule.invalid, F.lit(False))).alias("bad_rows"),
    )
    limit = F.col("rows").cast("decimal(20,0)") * share
    rejected = (F.col("bad_rows") > limit) if strict else (F.col("bad_rows") >= limit)
    return agg.select(*(by or []), "rows", "bad_rows", (~rejected).alias("passed"))
