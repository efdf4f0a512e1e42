"""Date helpers."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: str | _dt.date | _dt.datetime) -> Column:
    """A typed date literal from a driver argument (first 10 chars of an ISO string)."""
    if isinstance(value, _dt.datetime):
        value = value.date()
    if isinstance(value, _dt.date):
        value = value.isoformat()
    return F.to_date(F.lit(str(value)[:10]))


def days_from(base: str, offset: Column) -> Column:
    """base date + offset days."""
    return F.date_add(F.to_date(F.lit(base)), offset.cast("int"))


def date_str(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd")


def ts_str(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
