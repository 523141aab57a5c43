"""Amounts, rates and ratios. Amounts are computed as decimals so that half-up rounding is exact."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def money(col: Column | str) -> Column:
    return _col(col).cast(MONEY)


def _number(x: float | str | Decimal) -> Column:
    return F.lit(Decimal(str(x)))


def convert(amount: Column | str, rate: float | str | Decimal, places: int = 2) -> Column:
    """Amount in another currency at one fixed rate, rounded."""
    return F.round(money(amount) * _number(rate), places)


def convert_by_code(
    amount: Column | str, code: Column | str, rates: Mapping[str, float], places: int = 2
) -> Column:
    """Amount converted at the rate of its currency code; an unknown code gives NULL.

    The rate table is configuration (one entry per currency), so it travels as a literal map in
    the expression and the query needs no join.
    """
    pairs = [x for k, v in rates.items() for x in (F.lit(k), _number(v).cast("decimal(18,8)"))]
    return F.round(money(amount) * F.create_map(*pairs)[_col(code)], places)


def periodic_rate(annual: Column | str, periods: int = 12, places: int = 6) -> Column:
    """Rate per period that compounds to the effective annual rate."""
    per = F.pow(F.lit(1.0) + _col(annual).cast("double"), F.lit(1.0 / periods))
    return F.round(per - F.lit(1.0), places)


def provision(balance: Column | str, share: Column | str, places: int = 0) -> Column:
    """Provision on a balance, rounded half up; NULL when the balance is."""
    return F.round(money(balance) * _col(share).cast("decimal(9,6)"), places)


def percent(part: Column | str, whole: Column | str, places: int = 2) -> Column:
    """``part / whole`` in percent; NULL when the whole is zero."""
    return F.round(F.try_divide(_col(part), _col(whole)) * F.lit(100), places)


def ratio(part: Column | str, whole: Column | str, places: int = 4) -> Column:
    """``part / whole``; NULL when the whole is zero."""
    return F.round(F.try_divide(_col(part), _col(whole)), places)
