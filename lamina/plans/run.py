"""All layers in order, for one run."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lamina.context import RunContext
from lamina.plans import bronze, gold, quality, report, silver, tables
from lamina.plans.tables import TableSpec
from lamina.runtime import tune
from lamina.settings import Settings
from lamina.sources.store import TableStore, log_frame

REPORTS = "daily_execution_reports"
NAME = "layered_run"


@dataclass(frozen=True)
class Layers:
    """The stores of a deployment, one folder per layer under a common root."""

    bronze: TableStore
    silver: TableStore
    gold: TableStore
    errors: TableStore
    logs: TableStore

    @classmethod
    def under(cls, spark: SparkSession, root: str, fmt: str = "parquet") -> Layers:
        names = ("bronze", "silver", "gold", "errors", "logs")
        return cls(*[TableStore(spark, f"{root.rstrip('/')}/{n}", fmt) for n in names])


@dataclass(frozen=True)
class RunResult:
    outcome: str
    report_json: str
    volume_anomaly: bool


def run_layers(
    spark: SparkSession,
    read: Callable[[str], DataFrame],
    layers: Layers,
    ctx: RunContext,
    settings: Settings = Settings(),
    mode: str = "full",
    specs: Sequence[TableSpec] = tables.ALL,
    database: str | None = None,
) -> RunResult:
    """Ingest, clean, model, check and report. ``read`` opens a source table by name.

    With a ``database``, its external tables of the dimensional layer are pointed to what the run
    wrote. A failing run leaves a report too, before its error is raised.
    """
    tune(spark)
    try:
        bronze.ingest_all(specs, read, layers.bronze, layers.logs, ctx, mode)
        silver.process_all(
            layers.bronze, layers.silver, layers.errors, layers.logs, ctx, settings, specs
        )
        gold.build_all(layers.silver, layers.gold, ctx, settings)
        verdict = quality.check_gold(
            layers.gold, layers.logs, ctx, settings, layers.silver
        ).first()
        if database is not None:
            for name in gold.TABLES:
                layers.gold.create_table(name, f"{database}.{name}")
        if settings.keep_versions is not None:
            _prune(layers, specs, settings.keep_versions)
    except Exception as error:
        _log_report(spark, layers, ctx, report.failure_report(ctx, NAME, str(error)), "FAILED", False)
        raise
    return _report(spark, layers, ctx, settings, verdict["outcome"])


def _prune(layers: Layers, specs: Sequence[TableSpec], keep: int) -> None:
    for spec in specs:
        for path in layers.bronze.prune(spec.source, keep):
            # What was appended to a version that is gone.
            layers.bronze.delete_appended(bronze.increments_of(spec, path))
        layers.silver.prune(spec.silver, keep)
    for name in gold.TABLES:
        layers.gold.prune(name, keep)


def _report(
    spark: SparkSession, layers: Layers, ctx: RunContext, settings: Settings, outcome: str
) -> RunResult:
    ingest_log = layers.logs.read_all(bronze.LOG)
    volume = report.volume_check(ingest_log, ctx.batch_id, settings.volume_threshold_pct).first()
    anomaly = bool(volume and volume["is_anomaly"])
    row = report.run_report(
        ingest_log,
        layers.logs.read_all(silver.REPORT, ctx.batch_id),
        layers.logs.read_all(quality.RESULTS, ctx.batch_id),
        ctx,
        NAME,
        anomaly,
    ).first()
    _log_report(spark, layers, ctx, row["report_json"], outcome, anomaly)
    return RunResult(outcome, row["report_json"], anomaly)


def _log_report(
    spark: SparkSession, layers: Layers, ctx: RunContext, text: str, outcome: str, anomaly: bool
) -> None:
    line = [(ctx.batch_id, ctx.utc, text, outcome, anomaly)]
    schema = (
        "batch_id string, run_ts timestamp, report_json string, outcome string, "
        "volume_anomaly_alert boolean"
    )
    layers.logs.append(log_frame(spark, line, schema), REPORTS, ctx.batch_id)
