"""Rolling statistics and outlier flags per key, over days instead of over raw rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.operators.joins import DEFAULT_SKEW, SkewPolicy, lookup_join
from lamina.runtime import materialize


@dataclass(frozen=True)
class OutlierRule:
    """A value is an outlier above ``mean + threshold * deviation`` of its frame.

    ``frame="days"`` takes the last ``days`` days up to and including the row's own day with all
    its rows; ``frame="history"`` takes every row of the key. ``exclude_current`` leaves the row
    itself out; without it no frame of fewer than eleven rows can exceed three deviations.
    """

    threshold: float = 3.0
    days: int = 30
    frame: str = "days"
    exclude_current: bool = False

    def __post_init__(self):
        if self.frame not in ("days", "history"):
            raise ValueError(f"unknown frame {self.frame!r}")


_ROWS, _OWN, _OTHERS = "__rows", "__own", "__others"


def _moments_by_day(df: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """One row per key and day, reduced in each task before the shuffle.

    Values that are all the same have exactly their value as mean and no spread.
    """
    v = F.col(value).cast("double")
    constant = F.min(v) == F.max(v)
    moments = F.struct(
        F.count(v).cast("double").alias("n"),
        F.coalesce(F.when(constant, F.min(v)).otherwise(F.avg(v)), F.lit(0.0)).alias("mean"),
        F.coalesce(F.when(constant, 0.0).otherwise(F.var_pop(v) * F.count(v)), F.lit(0.0)).alias("m2"),
    )
    return (
        df.where(F.col(key).isNotNull() & F.col(day).isNotNull())
        .groupBy(key, day)
        .agg(F.count(F.lit(1)).alias(_ROWS), moments.alias(_OWN))
    )


def _moments(n: Column, mean: Column, m2: Column) -> Column:
    return F.struct(n.alias("n"), mean.alias("mean"), m2.alias("m2"))


def _merged(a: Column, b: Column) -> Column:
    """Moments of two sets of values together, from the distance of their means.

    No large sums are subtracted from each other, so a key whose level has moved loses no digits.
    """
    n = a["n"] + b["n"]
    away = b["mean"] - a["mean"]
    both = _moments(n, a["mean"] + away * (b["n"] / n), a["m2"] + b["m2"] + away * away * (a["n"] * b["n"] / n))
    return F.when(b["n"] == 0, a).when(a["n"] == 0, b).otherwise(both)


def _all_merged(days: Column) -> Column:
    none = _moments(F.lit(0.0), F.lit(0.0), F.lit(0.0))
    return F.aggregate(days, none, _merged)


def _without(a: Column, v: Column) -> Column:
    """Moments without one value of the set; nothing is left of a set of one."""
    n = a["n"] - 1
    mean = a["mean"] - (v - a["mean"]) / n
    m2 = F.greatest(a["m2"] - (v - a["mean"]) * (v - mean), F.lit(0.0))
    # A set without spread has none after it either, and keeps its mean exactly.
    rest = F.when(a["m2"] == 0, _moments(n, a["mean"], F.lit(0.0))).otherwise(_moments(n, mean, m2))
    return F.when(v.isNull(), a).when(n < 1, _moments(F.lit(0.0), F.lit(0.0), F.lit(0.0))).otherwise(rest)


def _frames(moments: DataFrame, key: str, day: str, days: int | None) -> DataFrame:
    """Per (key, day): moments of the own day, and of the other days of its frame.

    For a frame of days the window holds at most that many, however many rows the key has. For the
    whole history the moments of all days of a key are merged once and joined back to its days; they
    are then those of the own day too, and there are no others.
    """
    if days is not None:
        frame = Window.partitionBy(key).orderBy(F.unix_date(day)).rangeBetween(-days, -1)
        return moments.select(key, day, _OWN, _all_merged(F.collect_list(_OWN).over(frame)).alias(_OTHERS))
    # One entry per day, in the order of the days, so that every run adds up alike.
    dated = F.sort_array(F.collect_list(F.struct(F.col(day).alias("day"), F.col(_OWN).alias("own"))))
    whole = moments.groupBy(key).agg(dated.alias("__days"))
    whole = whole.select(key, _all_merged(F.transform("__days", lambda d: d["own"])).alias(_OWN))
    nothing = _moments(F.lit(0.0), F.lit(0.0), F.lit(0.0))
    return moments.select(key, day).join(whole, key).select(key, day, _OWN, nothing.alias(_OTHERS))


def rolling_stats(
    df: DataFrame,
    key: str,
    day: str,
    value: str,
    days: int | None = 30,
    mean: str = "rolling_avg",
    deviation: str = "rolling_std",
    exclude_current: bool = False,
    policy: SkewPolicy = DEFAULT_SKEW,
) -> DataFrame:
    """Add mean and sample deviation of the key's last ``days`` days (None: its whole history).

    The own day belongs to the frame with all its rows. A single value has no deviation. Rows
    without a key or day have neither.

    With ``exclude_current`` the row is taken out of its own day (for the whole history, out of the
    whole) by subtraction, which loses digits only where that one value makes nearly all the spread.

    The daily moments are written to the scratch folder first: they tell which (key, day) groups
    need splitting, and the frames are built from them without reading the rows again.
    """
    moments = materialize(_moments_by_day(df, key, day, value), "daily-moments")
    frames = _frames(moments, key, day, days)
    joined = lookup_join(
        df, frames, [key, day], "left", policy, right_is_large=True, counted=(moments, _ROWS)
    )
    own = F.col(_OWN)
    if exclude_current:
        own = _without(own, F.col(value).cast("double"))
    # Rows without a key or day found no frame: their moments are NULL.
    joined = joined.withColumn("__frame", _merged(F.col(_OTHERS), own)).drop(_OWN, _OTHERS)
    n, m2 = F.col("__frame.n"), F.col("__frame.m2")
    return joined.withColumns(
        {
            mean: F.when(n > 0, F.col("__frame.mean")),
            deviation: F.when(n > 1, F.sqrt(m2 / (n - 1))),
        }
    ).drop("__frame")


def flag_outliers(
    df: DataFrame,
    key: str,
    day: str,
    value: str,
    rule: OutlierRule = OutlierRule(),
    mean: str = "rolling_avg",
    deviation: str = "rolling_std",
    flag: str = "is_outlier",
    policy: SkewPolicy = DEFAULT_SKEW,
) -> DataFrame:
    """Add the statistics of the rule's frame and a 0/1 flag for values above its limit."""
    days = rule.days if rule.frame == "days" else None
    df = rolling_stats(df, key, day, value, days, mean, deviation, rule.exclude_current, policy)
    above = (F.col(deviation) > 0) & (
        F.col(value).cast("double") > F.col(mean) + F.lit(rule.threshold) * F.col(deviation)
    )
    return df.withColumn(flag, F.when(above, F.lit(1)).otherwise(F.lit(0)))


def trailing_sum(
    df: DataFrame, key: str, order: list[str], value: str, rows: int, alias: str
) -> DataFrame:
    """Sum over the last ``rows`` rows per key. For frames already reduced to one row per period."""
    frame = Window.partitionBy(key).orderBy(*order).rowsBetween(1 - rows, 0)
    return df.withColumn(alias, F.sum(value).over(frame))


def trailing_sum_over(
    df: DataFrame, key: str, index: Column, value: str, span: int, alias: str
) -> DataFrame:
    """Sum over the last ``span`` periods of a running period number, gaps counting as periods."""
    frame = Window.partitionBy(key).orderBy(index).rangeBetween(1 - span, 0)
    return df.withColumn(alias, F.sum(value).over(frame))
