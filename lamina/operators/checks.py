"""Data-quality checks: every check of one table is answered by one aggregation over it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.context import RunContext
from lamina.operators.joins import DEFAULT_SKEW, SkewPolicy, lookup_join

RESULT = "check_name string, table string, status string, details string, severity string"


@dataclass(frozen=True)
class Check:
    """A check on one table.

    ``measure`` is an aggregate counting what is wrong (for ``min_rows``: what is there), and
    ``passes`` turns that number into a verdict.
    """

    name: str
    table: str
    measure: Callable[[], Column]
    passes: Callable[[Column], Column]
    unit: str
    severity: str = "error"
    parent: str | None = None
    on: tuple[str, str] | None = None


def _none(n: Column) -> Column:
    return n == 0


def min_rows(table: str, least: int = 1, name: str = "row_count_not_zero") -> Check:
    return Check(name, table, lambda: F.count(F.lit(1)), lambda n: n >= least, "rows")


def no_nulls(table: str, col: str, name: str = "no_null_primary_keys") -> Check:
    return Check(name, table, lambda: F.count_if(F.col(col).isNull()), _none, f"nulls in {col}")


def not_after(table: str, col: str, day: date, name: str = "valid_date_ranges") -> Check:
    late = lambda: F.count_if(F.col(col) > F.lit(day))
    return Check(name, table, late, _none, f"rows with {col} after {day}")


def not_before(table: str, col: str, day: date, name: str = "valid_date_ranges_min") -> Check:
    early = lambda: F.count_if(F.col(col) < F.lit(day))
    return Check(name, table, early, _none, f"rows with {col} before {day}")


def unique_key(table: str, col: str, name: str = "no_exact_duplicates") -> Check:
    """Rows beyond the first of each key; NULL counts as one key."""

    def copies() -> Column:
        nulls = F.coalesce(F.max(F.col(col).isNull().cast("int")), F.lit(0))
        return F.count(F.lit(1)) - F.count_distinct(F.col(col)) - nulls

    return Check(name, table, copies, _none, f"repeated keys in {col}")


def references(
    table: str, col: str, parent: str, parent_col: str | None = None,
    name: str = "referential_integrity",
) -> Check:
    """Every value of ``col`` is a key of the parent table; NULL is an orphan."""
    marker = f"__in_{parent}_{col}"
    return Check(
        name, table, lambda: F.count_if(F.col(marker).isNull()), _none,
        f"rows without {parent}", parent=parent, on=(col, parent_col or col),
    )


def _with_parents(df, checks, tables, policy):
    for check in checks:
        if check.parent:
            col, parent_col = check.on
            keys = tables[check.parent]().select(F.col(parent_col).alias(col)).dropna().distinct()
            keys = keys.withColumn(f"__in_{check.parent}_{col}", F.lit(True))
            df = lookup_join(df, keys, [col], "left", policy)
    return df


def _answers(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    row = df.agg(*[c.measure().cast("bigint").alias(f"m{i}") for i, c in enumerate(checks)])
    results = [
        F.struct(
            F.lit(c.name).alias("check_name"),
            F.lit(table).alias("table"),
            F.when(c.passes(F.col(f"m{i}")), F.lit("PASSED")).otherwise(F.lit("FAILED")).alias("status"),
            F.concat(F.col(f"m{i}").cast("string"), F.lit(f" {c.unit}")).alias("details"),
            F.lit(c.severity).alias("severity"),
        )
        for i, c in enumerate(checks)
    ]
    return row.select(F.explode(F.array(*results)).alias("r")).select("r.*")


def run_checks(
    spark: SparkSession,
    tables: Mapping[str, Callable[[], DataFrame]],
    checks: Sequence[Check],
    policy: SkewPolicy = DEFAULT_SKEW,
    isolate: bool = False,
) -> DataFrame:
    """Results of all checks, one row each.

    ``tables`` maps names to functions opening the table. A table that cannot be opened fails its
    checks and keeps the message; the others still run. ``isolate`` runs each table's aggregation
    here, so that one that breaks while it is read does the same; otherwise the result is lazy.
    """
    frames = []
    for table in dict.fromkeys(c.table for c in checks):
        mine = [c for c in checks if c.table == table]
        try:
            answers = _answers(_with_parents(tables[table](), mine, tables, policy), table, mine)
            if isolate:  # one row per check
                answers = spark.createDataFrame(answers.collect(), RESULT)
        except Exception as error:  # an unreadable table is a finding, not the end of the run
            text = f"error: {error}"
            rows = [(c.name, table, "FAILED", text, c.severity) for c in mine]
            answers = spark.createDataFrame(rows, RESULT)
        frames.append(answers)
    return reduce(DataFrame.unionByName, frames)


def for_log(results: DataFrame, ctx: RunContext) -> DataFrame:
    return results.withColumns(
        {
            "timestamp": F.lit(ctx.utc).cast("timestamp"),
            "batch_id": F.lit(ctx.batch_id),
        }
    )


def summary(results: DataFrame) -> DataFrame:
    """One row: checks run, passed and failed, and the outcome of the run.

    Warnings alone (checks of severity ``warning``) do not change the outcome.
    """
    failed = F.col("status") == "FAILED"
    hard = F.count_if(failed & (F.col("severity") != "warning"))
    return results.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~failed).alias("passed"),
        F.count_if(failed).alias("failed"),
        F.when(hard == 0, F.lit("ALL_CHECKS_PASSED"))
        .otherwise(F.concat(F.lit("QUALITY_WARNINGS:"), hard.cast("string")))
        .alias("outcome"),
    )
