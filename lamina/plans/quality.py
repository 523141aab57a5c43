"""The checks run on the dimensional layer."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.context import RunContext
from lamina.operators import checks
from lamina.operators.checks import Check
from lamina.plans import silver
from lamina.plans.tables import ALL
from lamina.runtime import scratch_scope
from lamina.settings import Settings
from lamina.sources.store import TableStore

RESULTS = "gold_quality_checks"

# Tables that must hold rows, primary keys, and the first plausible day.
NOT_EMPTY = (
    "dim_clientes", "dim_productos", "dim_geografia", "dim_canal",
    "fact_transacciones", "fact_cartera", "fact_rentabilidad_cliente", "kpi_cartera_diaria",
)
PRIMARY_KEYS = {
    "dim_clientes": "id_cli",
    "dim_productos": "producto_id",
    "dim_canal": "cod_suc",
    "fact_transacciones": "id_mov",
    "fact_cartera": "id_oblig",
}
FIRST_DAY = date(2020, 1, 1)


def gold_checks(as_of: date) -> list[Check]:
    facts = ("fact_transacciones", "fact_cartera")
    return [
        *[checks.min_rows(t) for t in NOT_EMPTY],
        *[checks.no_nulls(t, k) for t, k in PRIMARY_KEYS.items()],
        *[checks.references(t, "id_cli", "dim_clientes") for t in facts],
        checks.not_after("fact_transacciones", "fec_mov", as_of),
        checks.not_before("fact_transacciones", "fec_mov", FIRST_DAY),
        *[checks.unique_key(t, PRIMARY_KEYS[t]) for t in facts],
    ]


def conformity_results(logs: TableStore, ctx: RunContext, minimum: float) -> DataFrame:
    """A result per clean table whose conformity rate this batch reported."""
    rates = logs.read_all(silver.REPORT, ctx.batch_id).where(F.col("metric") == "conformity_rate")
    passed = F.col("value") >= F.lit(minimum)
    return rates.select(
        F.lit("min_conformity_rate").alias("check_name"),
        "table",
        F.when(passed, F.lit("PASSED")).otherwise(F.lit("FAILED")).alias("status"),
        F.concat(F.col("value").cast("string"), F.lit(f" of {minimum}")).alias("details"),
        F.lit("warning").alias("severity"),
    )


def exposure_results(stores: Sequence[TableStore], names: Sequence[str], personal: set[str]) -> DataFrame:
    """A result per table: no column of personal data in its schema."""
    rows = []
    for store in stores:
        for name in names:
            if store.exists(name):
                clear = sorted(personal & set(store.read(name).columns))
                status = "FAILED" if clear else "PASSED"
                rows.append(("no_clear_personal_data", name, status, ", ".join(clear) or "none", "error"))
    return stores[0].spark.createDataFrame(rows, checks.RESULT)


def check_gold(
    gold: TableStore,
    logs: TableStore,
    ctx: RunContext,
    settings: Settings = Settings(),
    clean: TableStore | None = None,
) -> DataFrame:
    """Run the checks, log their results and return the summary row; never raises for a finding.

    With a minimum conformity rate in the settings, the clean layer's rates are checked too; with
    sensitive columns, so are the schemas of the clean and the dimensional layer.
    """
    tables = {name: (lambda name=name: gold.read(name)) for name in NOT_EMPTY}
    with scratch_scope(gold.spark):
        results = checks.run_checks(
            gold.spark, tables, gold_checks(ctx.as_of), settings.skew, isolate=True
        )
        if settings.min_conformity is not None:
            results = results.unionByName(conformity_results(logs, ctx, settings.min_conformity))
        if settings.sensitive:
            stores = [gold] if clean is None else [gold, clean]
            names = [*NOT_EMPTY, *[t.silver for t in ALL]]
            results = results.unionByName(exposure_results(stores, names, set(settings.sensitive)))
        logs.append(checks.for_log(results, ctx), RESULTS, ctx.batch_id)
    return checks.summary(logs.read_all(RESULTS, ctx.batch_id))
