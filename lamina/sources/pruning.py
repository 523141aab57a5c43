"""Filters on a day that also name the year and month partitions the day lies in."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions.dates import month_index


def partitions_of(df: DataFrame, day: str) -> tuple[str, str] | None:
    """Names of the columns that hold year and month of ``day``, where the table has them."""
    names = (f"{day}_year", f"{day}_month")
    return names if set(names) <= set(df.columns) else None


def in_months(
    year: str, month: str, first: Column | None = None, last: Column | None = None
) -> Column:
    """The year and month lie between those of two days, both included; an open end without a day.

    A condition on the two columns alone, so that a table partitioned by them opens no folder of another month; the
    days may be literals or scalar subqueries, which are answered before the folders are listed.
    """
    at, met = month_index(year, month), F.lit(True)
    if first is not None:
        met = at >= month_index(F.year(first), F.month(first))
    if last is not None:
        met = met & (at <= month_index(F.year(last), F.month(last)))
    return met


def where_days(
    df: DataFrame,
    day: str,
    first: date | Column | None = None,
    last: date | Column | None = None,
    partitions: tuple[str, str] | None = None,
) -> DataFrame:
    """Rows whose day lies between ``first`` and ``last``, both included.

    Where the table has the year and month of the day (``<day>_year`` and ``<day>_month``, or the names given in
    ``partitions``), the filter is put to them as well. That changes no row as long as they are those of the day.
    """
    bounds = [F.lit(b) if isinstance(b, date) else b for b in (first, last)]
    for bound, keep in zip(bounds, (lambda b: F.col(day) >= b, lambda b: F.col(day) <= b)):
        if bound is not None:
            df = df.where(keep(bound))
    named = partitions or partitions_of(df, day)
    bounded = any(b is not None for b in bounds)
    return df.where(in_months(*named, *bounds)) if named and bounded else df
