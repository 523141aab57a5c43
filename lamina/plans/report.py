"""The run report and the volume check, from the log tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.context import RunContext


def run_volumes(ingest_log: DataFrame) -> DataFrame:
    """Rows ingested per batch."""
    return ingest_log.groupBy("batch_id").agg(
        F.min("run_ts").alias("run_ts"), F.sum("row_count").alias("row_count")
    )


def volume_history(volumes: DataFrame, threshold_pct: float, runs: int = 7, least: int = 2) -> DataFrame:
    """Each batch beside the mean of up to ``runs`` batches before it.

    ``volumes`` has one row per batch (see ``run_volumes``): the ordered frame holds runs, not
    data. With fewer than ``least`` earlier batches nothing is flagged.
    """
    earlier = Window.orderBy("run_ts", "batch_id").rowsBetween(-runs, -1)
    seen = volumes.withColumns(
        {"earlier_runs": F.count("row_count").over(earlier), "mean_rows": F.avg("row_count").over(earlier)}
    )
    return _flagged(seen, threshold_pct, least)


def volume_check(
    ingest_log: DataFrame, batch_id: str, threshold_pct: float, runs: int = 7, least: int = 2
) -> DataFrame:
    """One row: this batch against the mean of the last ``runs`` batches before it."""
    volumes = run_volumes(ingest_log)
    now = volumes.where(F.col("batch_id") == batch_id)
    before = (
        volumes.where((F.col("batch_id") != batch_id) & (F.col("run_ts") <= now.select("run_ts").scalar()))
        .orderBy(F.desc("run_ts"), F.desc("batch_id"))
        .limit(runs)
        .agg(F.count("row_count").alias("n"), F.avg("row_count").alias("mean"))
    )
    seen = now.withColumns(
        {
            "earlier_runs": before.select("n").scalar(),
            "mean_rows": before.select("mean").scalar(),
        }
    )
    return _flagged(seen, threshold_pct, least)


def _flagged(seen: DataFrame, threshold_pct: float, least: int) -> DataFrame:
    deviation = F.abs(F.col("row_count") - F.col("mean_rows"))
    away = F.try_divide(deviation, F.col("mean_rows")) * 100
    flagged = (F.col("earlier_runs") >= least) & (away > F.lit(threshold_pct))
    return seen.withColumns(
        {"deviation_pct": away, "is_anomaly": F.when(flagged, F.lit(1)).otherwise(F.lit(0))}
    )


def run_report(
    ingest_log: DataFrame,
    quality_report: DataFrame,
    checks: DataFrame,
    ctx: RunContext,
    name: str,
    volume_anomaly: bool = False,
) -> DataFrame:
    """One row with the JSON report of a batch: rows in, rows rejected, checks passed and failed.

    A volume anomaly adds its alert; without one the report has no such field.
    """
    mine = F.col("batch_id") == ctx.batch_id
    rows = ingest_log.where(mine).agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows"))
    rejected = quality_report.where(mine & F.col("metric").like("%rejected%")).agg(
        F.coalesce(F.sum("value"), F.lit(0)).cast("bigint").alias("rejected")
    )
    verdicts = checks.where(mine).agg(
        F.count_if(F.col("status") == "PASSED").alias("passed"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
    )
    return verdicts.select(
        F.lit(ctx.batch_id).alias("batch_id"),
        F.lit(ctx.utc).cast("timestamp").alias("run_ts"),
        F.to_json(
            F.struct(
                F.lit(name).alias("pipeline"),
                F.lit("SUCCESS").alias("status"),
                F.lit(ctx.batch_id).alias("batch_id"),
                F.lit(str(ctx.run_ts)).alias("timestamp"),
                F.struct(
                    rows.scalar().alias("bronze_total_rows"),
                    rejected.scalar().alias("silver_rejected_records"),
                    F.col("passed").alias("gold_quality_checks_passed"),
                    F.col("failed").alias("gold_quality_checks_failed"),
                ).alias("summary"),
                F.lit(True if volume_anomaly else None).cast("boolean").alias("volume_anomaly_alert"),
            )
        ).alias("report_json"),
    )


def failure_report(ctx: RunContext, name: str, error: str) -> str:
    """The JSON report of a run that failed."""
    return json.dumps(
        {
            "pipeline": name,
            "status": "FAILED",
            "batch_id": ctx.batch_id,
            "timestamp": str(ctx.run_ts),
            "error": error,
        }
    )
