"""Numbers of distinct values from sketches that are stored per period and merged later."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH = "sketch"


def distinct_sketches(df: DataFrame, by: Sequence[str], col: str, lg: int = 12) -> DataFrame:
    """One row per group with a sketch of the different values of ``col``; NULL is not a value.

    A sketch takes at most about ``2**lg`` bytes, however many values it has seen, and is combined in each task, so a
    group with a third of all rows sends one sketch per task.
    """
    return df.groupBy(*by).agg(F.hll_sketch_agg(col, lg).alias(SKETCH))


def merged(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketches of several groups or periods as one per ``by``; values that occur in several count once."""
    return sketches.groupBy(*by).agg(F.hll_union_agg(SKETCH).alias(SKETCH))


def estimate(sketch: str = SKETCH) -> Column:
    return F.hll_sketch_estimate(sketch)


def error_bound(lg: int = 12, deviations: float = 3.0) -> float:
    """The relative error that an estimate stays within, but for one in several hundred at three deviations.

    1.04 / sqrt(2**lg) is the standard error of merged sketches: 1.6 % at ``lg = 12``, so the bound is 4.9 %.
    """
    return deviations * 1.04 / math.sqrt(2**lg)


def within(estimated: Column, exact: Column, lg: int = 12, deviations: float = 3.0) -> Column:
    """Whether an estimate is as near to the exact number as the bound says (one more or less at small numbers)."""
    return F.abs(estimated - exact) <= F.greatest(F.lit(1.0), F.lit(error_bound(lg, deviations)) * exact)
