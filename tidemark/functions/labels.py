"""Label rules of the customer mart.

Fixed values that must equal the original pipeline's output, stated together:
tier labels by quartile 1..4 = 'Platinum', 'Gold', 'Silver', 'bronze' (lower case as
published); churn labels by days since last order: > 30 'High', > 15 'Medium', else 'Low'
(a missing last order date is 'Low').
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must match the published labels exactly).
TIER_LABELS = ("Platinum", "Gold", "Silver", "bronze")
CHURN_HIGH_DAYS = 30
CHURN_MEDIUM_DAYS = 15
CHURN_LABELS = ("High", "Medium", "Low")


def tier_label(tile: Column) -> Column:
    return (
        F.when(tile == 1, TIER_LABELS[0])
        .when(tile == 2, TIER_LABELS[1])
        .when(tile == 3, TIER_LABELS[2])
        .otherwise(TIER_LABELS[3])
    )


def churn_label(as_of: Column, last_order_date: Column) -> Column:
    gap = F.datediff(as_of, last_order_date)
    return (
        F.when(gap > CHURN_HIGH_DAYS, CHURN_LABELS[0])
        .when(gap > CHURN_MEDIUM_DAYS, CHURN_LABELS[1])
        .otherwise(CHURN_LABELS[2])
    )
