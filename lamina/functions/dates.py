"""Dates relative to an injected business date, and the calendar."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def age_years(birth: Column | str, as_of: date) -> Column:
    """Whole years of 365.25 days between a birth date and ``as_of``."""
    return F.floor(F.datediff(F.lit(as_of), _col(birth)) / F.lit(365.25)).cast("int")


def days_since(day: Column | str, as_of: date) -> Column:
    return F.datediff(F.lit(as_of), _col(day))


def hour_of(clock: Column | str) -> Column:
    """Hour of an ``HH:MM:SS`` text; NULL when it is not a number."""
    return F.substring(_col(clock), 1, 2).try_cast("int")


def hours_flag(
    hour: Column, start: int, end: int, inside: str = "HABIL", outside: str = "NO_HABIL"
) -> Column:
    """Label for hours ``start..end``, both inclusive; anything else, NULL too, is outside."""
    return F.when(hour.between(start, end), F.lit(inside)).otherwise(F.lit(outside))


def month_index(year: Column | str, month: Column | str) -> Column:
    """Months as one running number, for frames over calendar months."""
    return _col(year) * F.lit(12) + _col(month)


def trailing_cutoff(df: DataFrame, day: str, months: int) -> DataFrame:
    """One row, one column ``cutoff``: the last day of the data minus ``months`` (month-end clamped)."""
    return df.agg(F.add_months(F.max(day), -months).alias("cutoff"))


def since_cutoff(df: DataFrame, day: str, cutoff: DataFrame) -> DataFrame:
    """Rows on or after a one-row cutoff, compared through a scalar subquery inside the plan.

    A table with year and month of the day (``<day>_year``, ``<day>_month``) is filtered by these too.
    """
    since = cutoff.scalar()
    df = df.where(F.col(day) >= since)
    year, month = f"{day}_year", f"{day}_month"
    if year in df.columns and month in df.columns:
        df = df.where(month_index(year, month) >= month_index(F.year(since), F.month(since)))
    return df


def calendar(bounds: DataFrame) -> DataFrame:
    """Every day from ``first`` to ``last`` of a one-row frame, with its parts.

    Grows with the length of the period, not with the data.
    """
    days = bounds.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("day"))
    return days.select(
        F.date_format("day", "yyyyMMdd").cast("int").alias("date_key"),
        "day",
        F.year("day").alias("year"),
        F.quarter("day").alias("quarter"),
        F.month("day").alias("month"),
        F.dayofmonth("day").alias("day_of_month"),
        (F.weekday("day") + 1).alias("day_of_week"),
        (F.weekday("day") >= 5).cast("int").alias("is_weekend"),
    )
