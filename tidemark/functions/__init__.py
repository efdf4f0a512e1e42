"""Column expressions shared by the plans (all built-in Spark functions, no UDFs)."""

from tidemark.functions.money import (
    half_up_mean,
    line_total,
    money,
    money_out,
    money_sum,
)
from tidemark.functions.labels import churn_label, tier_label
from tidemark.functions.dates import as_date, date_str, days_from, ts_str

__all__ = [
    "half_up_mean", "line_total", "money", "money_out", "money_sum",
    "churn_label", "tier_label", "as_date", "date_str", "days_from", "ts_str",
]
