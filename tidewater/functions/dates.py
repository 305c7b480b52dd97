"""Calendar helpers. Keys are computed arithmetically (no string formatting)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(d: Column) -> Column:
    """yyyyMMdd as INT, e.g. 2023-01-15 -> 20230115."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def iso_day_of_week(d: Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return ((F.dayofweek(d) + 5) % 7 + 1).cast("int")


def _check_month(start_month: int) -> int:
    if not 1 <= start_month <= 12:
        raise ValueError(f"fiscal start month must be 1..12, got {start_month}")
    return start_month


def fiscal_year(d: Column, start_month: int = 1) -> Column:
    """Fiscal year named after the calendar year in which it ends
    (July start: 2023-07-01 -> 2024, 2024-06-30 -> 2024)."""
    shift = (13 - _check_month(start_month)) % 12
    return F.year(F.add_months(d, shift)) if shift else F.year(d)


def fiscal_month(d: Column, start_month: int = 1) -> Column:
    s = _check_month(start_month)
    return ((F.month(d) - s + 12) % 12 + 1).cast("int")


def fiscal_quarter(d: Column, start_month: int = 1) -> Column:
    return (F.floor((fiscal_month(d, start_month) - 1) / 3) + 1).cast("int")
