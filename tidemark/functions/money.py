"""Money arithmetic: exact decimals inside, doubles only at the mart edge."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import MONEY


def money(c: Column | str) -> Column:
    """Cents-exact decimal(12,2) from a double or decimal column."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(MONEY)


def money_sum(c: Column | str) -> Column:
    """Exact sum of a money column (decimal accumulation, no float drift)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c.cast("decimal(18,2)"))


def money_out(c: Column) -> Column:
    """Publish a decimal as double (the mart edge)."""
    return c.cast("double")


def line_total(gross: Column, pct: Column) -> Column:
    """Line price after a percentage discount: gross * (1 - pct/100), rounded to cents.

    Written as a product with 0.01 so that the whole expression stays decimal.
    """
    return F.round(gross * (F.lit(100) - pct) * F.lit(0.01).cast("decimal(3,2)"), 2).cast(MONEY)


def half_up_mean(total: Column, count: Column, scale: int, total_scale: int) -> Column:
    """round(total / count, scale), HALF_UP, on decimals.

    ``total`` is narrowed to decimal(24, total_scale) and ``count`` to decimal(12,0) so the
    quotient keeps total_scale + 13 fraction digits before the single rounding step: a
    value that is not exactly a tie can never be rounded as one.
    """
    # no row to average → null (never a division by zero, which raises under ANSI mode)
    return F.when(count > 0, F.round(total.cast(f"decimal(24,{total_scale})") / count.cast("decimal(12,0)"), scale))
