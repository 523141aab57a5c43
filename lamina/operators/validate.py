"""Rules over rows, all evaluated in one pass, and routing of the rows that fail."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.context import RunContext
from lamina.functions.clean import CAST_ERROR
from lamina.operators.joins import DEFAULT_SKEW, SkewPolicy, lookup_join
from lamina.runtime import materialize

ERROR = "_error_type"
_VANISHED = "__vanished"


@dataclass(frozen=True)
class Rule:
    """A named condition a row must meet.

    ``test`` builds the condition when the rule is applied. Its NULL means that the row has
    nothing to compare; ``null_reason`` is what such a row is rejected for under the ``reject``
    policy. ``null_passes`` accepts it instead. ``attach`` adds helper columns the condition
    reads, and ``helpers`` names them for removal.
    """

    reason: str
    test: Callable[[], Column]
    null_reason: str | None = None
    null_passes: bool = False
    attach: Callable[[DataFrame, SkewPolicy], DataFrame] | None = None
    helpers: tuple[str, ...] = field(default=())


def not_null(col: str, reason: str = "null_primary_key") -> Rule:
    return Rule(reason, lambda: F.col(col).isNotNull())


def castable(reason: str = "invalid_type") -> Rule:
    """No value was lost by ``standardize(..., flag=True)``."""
    return Rule(reason, lambda: F.col(CAST_ERROR).isNull(), helpers=(CAST_ERROR,))


def not_after(col: str, day: date, reason: str = "future_date") -> Rule:
    return Rule(reason, lambda: F.col(col) <= F.lit(day), f"null_{col}")


def not_before(col: str, day: date, reason: str) -> Rule:
    return Rule(reason, lambda: F.col(col) >= F.lit(day), f"null_{col}")


def at_least(col: str, low: float, reason: str) -> Rule:
    return Rule(reason, lambda: F.col(col) >= F.lit(low), f"null_{col}")


def positive(col: str, reason: str) -> Rule:
    return Rule(reason, lambda: F.col(col) > F.lit(0), f"null_{col}")


def at_most_column(col: str, bound: str, reason: str) -> Rule:
    return Rule(reason, lambda: F.col(col) <= F.col(bound), f"null_{col}")


def in_set(col: str, values: Sequence, reason: str, null_passes: bool = False) -> Rule:
    values = list(values)
    return Rule(reason, lambda: F.col(col).isin(values), f"null_{col}", null_passes)


def between(col: str, low, high, reason: str, null_passes: bool = True) -> Rule:
    return Rule(reason, lambda: F.col(col).between(low, high), f"null_{col}", null_passes)


def satisfies(reason: str, test: Callable[[], Column], null_reason: str | None = None) -> Rule:
    """Any other condition."""
    return Rule(reason, test, null_reason)


def foreign_key(
    col: str,
    parent: DataFrame,
    parent_col: str | None = None,
    reason: str = "referential_integrity_fail",
) -> Rule:
    """The value is a key of ``parent``. NULL is an orphan."""
    marker = f"__in_parent_{col}"
    keys = (
        parent.select(F.col(parent_col or col).alias(col))
        .where(F.col(col).isNotNull())
        .distinct()
        .withColumn(marker, F.lit(True))
    )

    def attach(df: DataFrame, policy: SkewPolicy) -> DataFrame:
        return lookup_join(df, keys, [col], "left", policy)

    return Rule(reason, lambda: F.col(marker).isNotNull(), attach=attach, helpers=(marker,))


def unique(cols: Sequence[str], reason: str) -> Rule:
    """No other row has the same values. Rows with a NULL among them are not compared.

    Repeated keys come from an aggregate, written out and joined back, so a heavily repeated key is never
    gathered in one task as it would be by a window over the key.
    """
    cols = list(cols)
    marker = "__repeated_" + "_".join(cols)

    def attach(df: DataFrame, policy: SkewPolicy) -> DataFrame:
        counts = df.dropna(subset=cols).groupBy(*cols).agg(F.count(F.lit(1)).alias(marker))
        repeated = materialize(counts.where(F.col(marker) > 1), "repeated-keys")
        return lookup_join(
            df, repeated, cols, "left", policy, right_is_large=True, counted=(repeated, marker)
        )

    return Rule(reason, lambda: F.col(marker).isNull(), attach=attach, helpers=(marker,))


def tag(
    df: DataFrame,
    rules: Sequence[Rule],
    null_policy: str = "reject",
    policy: SkewPolicy = DEFAULT_SKEW,
) -> DataFrame:
    """Add ``_error_type``: the reason of the first rule a row fails, NULL for a valid row.

    A row a rule cannot decide, because an input is NULL, is rejected under ``reject`` and taken
    out of both results under ``drop``.
    """
    if null_policy not in ("reject", "drop"):
        raise ValueError(f"unknown null policy {null_policy!r}")
    helpers = []
    for rule in rules:
        if rule.attach:
            df = rule.attach(df, policy)
        helpers += rule.helpers
    reasons = []
    for rule in rules:
        ok = rule.test()
        reasons.append(F.when(~ok, F.lit(rule.reason)))
        if not rule.null_passes:
            undecided = _VANISHED if null_policy == "drop" else rule.null_reason or rule.reason
            reasons.append(F.when(ok.isNull(), F.lit(undecided)))
    tagged = df.withColumn(ERROR, F.coalesce(*reasons, F.lit(None).cast("string")))
    if null_policy == "drop":
        tagged = tagged.where(F.col(ERROR).isNull() | (F.col(ERROR) != _VANISHED))
    return tagged.drop(*helpers)


def valid(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(ERROR).isNull()).drop(ERROR)


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(ERROR).isNotNull())


def envelope(rejects: DataFrame, ctx: RunContext, source_table: str) -> DataFrame:
    """Rejected rows with the columns of the error table."""
    return rejects.withColumns(
        {
            "_error_timestamp": F.lit(ctx.utc).cast("timestamp"),
            "_source_table": F.lit(source_table),
            "_batch_id": F.lit(ctx.batch_id),
        }
    )


def union_rejects(*frames: DataFrame) -> DataFrame:
    """Rejects of several tables as one frame; columns a table lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
