"""From the raw to the clean layer: standardise, mask, validate, reject, enrich."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.context import RunContext
from lamina.functions.clean import CAST_ERROR, normalize_text, standardize
from lamina.functions.dates import hour_of, hours_flag
from lamina.functions.mask import mask_columns
from lamina.functions.money import ratio
from lamina.operators import impute, rolling, validate
from lamina.operators.dedup import business_columns, drop_business_copies, drop_exact
from lamina.operators.profile import metric_rows
from lamina.operators.validate import Rule
from lamina.plans import tables
from lamina.plans.bronze import read_raw
from lamina.plans.tables import TableSpec
from lamina.runtime import materialize, scratch_scope
from lamina.settings import Settings
from lamina.sources.files import CORRUPT
from lamina.sources.store import TableStore

REJECTS = "silver_rejected"
REPORT = "silver_quality_report"


def cleaned(raw: DataFrame, spec: TableSpec, settings: Settings) -> DataFrame:
    """Deduplicated, typed, normalised and masked rows, before any rule.

    Masking comes before validation, so rejected rows carry no clear personal data either.
    """
    if spec.copies == "business":
        df = drop_business_copies(raw, spec.key)
    else:
        df = drop_exact(raw)
    df = standardize(df, spec.types, flag=True)
    if CORRUPT in df.columns:
        # The line holds unmasked values: only that it did not fit is kept.
        lost = F.when(F.col(CORRUPT).isNotNull(), F.lit(CORRUPT))
        df = df.withColumn(CAST_ERROR, F.coalesce(CAST_ERROR, lost)).drop(CORRUPT)
    df = normalize_text(df, spec.upper, spec.trim)
    return mask_columns(df, settings.masks.get(spec.source, {}))


def rules_for(spec: TableSpec, clients: DataFrame | None, ctx: RunContext) -> list[Rule]:
    """The rules of a table, in the order in which they decide."""
    key = validate.not_null(spec.key)
    to_client = [validate.foreign_key("id_cli", clients)] if clients is not None else []
    by_table = {
        tables.MOVEMENTS.source: [validate.not_after("fec_mov", ctx.as_of)],
        tables.LOANS.source: [
            validate.at_least("dias_mora_act", 0, "negative_dias_mora"),
            validate.at_most_column("sdo_capital", "vr_aprobado", "sdo_exceeds_aprobado"),
        ],
    }
    return [key, validate.castable(), *by_table.get(spec.source, []), *to_client]


def tagged(
    raw: DataFrame, spec: TableSpec, clients: DataFrame | None, ctx: RunContext, settings: Settings
) -> DataFrame:
    """Cleaned rows with the reason each is rejected for, NULL for the valid ones."""
    rules = rules_for(spec, clients, ctx)
    df = cleaned(raw, spec, settings)
    return validate.tag(df, rules, settings.null_policy, settings.skew)


def enriched(df: DataFrame, spec: TableSpec, settings: Settings) -> DataFrame:
    """Derived columns of valid rows."""
    given = business_columns(df, spec.key)
    if spec.source == tables.MOVEMENTS.source:
        start, end = settings.hours
        df = df.withColumn("flag_horario", hours_flag(hour_of("hra_mov"), start, end))
        df = rolling.flag_outliers(
            df, "id_cli", "fec_mov", "vr_mov", settings.outlier,
            "avg_30d", "std_30d", "ind_sospechoso", settings.skew,
        )
    named = settings.null_handling or {}
    wanted = [c for c in given if c in named or settings.null_default]
    if wanted:
        df = impute.handle_nulls(df, settings.null_default or "flag", named, wanted)
    return df


def process(
    spec: TableSpec,
    bronze: TableStore,
    silver: TableStore,
    errors: TableStore,
    logs: TableStore,
    ctx: RunContext,
    settings: Settings = Settings(),
    clients: DataFrame | None = None,
) -> DataFrame:
    """Build one clean table with its rejects and quality metrics; returns the written table.

    The tagged rows are written once to the scratch folder: the valid part, the rejects and the
    reject counts are all read from there, with the filter pushed to the scan. Counts come from
    written tables, so they are exact whatever had to be recomputed.
    """
    with scratch_scope(bronze.spark):
        raw = read_raw(spec, bronze)
        staged = materialize(tagged(raw, spec, clients, ctx, settings), spec.silver)
        good = enriched(validate.valid(staged), spec, settings)
        good = good.withColumn("_silver_timestamp", F.lit(ctx.utc).cast("timestamp"))
        silver.write(good, spec.silver, settings.partitions.get(spec.silver, ()))
        written = silver.read(spec.silver)
        bad = validate.envelope(validate.rejected(staged), ctx, spec.source)
        errors.append(bad, REJECTS, ctx.batch_id, spec.source)
        reasons = [rule.reason for rule in rules_for(spec, clients, ctx)]
        # Rows that "drop" leaves out are no duplicates: count before the rules, which costs the
        # deduplication once more under that policy alone.
        counted = cleaned(raw, spec, settings) if settings.null_policy == "drop" else staged
        measured = metric_rows(spec.source, metrics(raw, staged, written, reasons, counted.count()), ctx)
        logs.append(measured, REPORT, ctx.batch_id, spec.source)
    return written


def metrics(
    raw: DataFrame, staged: DataFrame, written: DataFrame, reasons: Sequence[str] = (),
    kept: int | None = None,
) -> DataFrame:
    """One row of numbers: rows in, duplicates, NULL shares, rejects per reason, rows out.

    ``kept`` is the number of rows behind the deduplication, that of ``staged`` if not given.
    Reasons that rejected nothing count 0. One aggregation over the raw table; the others read one column or none of what was written.
    """
    n = F.count(F.lit(1))
    rejects = dict.fromkeys(reasons, 0)
    rejects |= {r["_error_type"]: r["n"] for r in _reject_counts(staged).collect()}
    kept = staged.count() if kept is None else kept
    flags = [c for c in ("ind_sospechoso",) if c in written.columns]
    out = written.agg(n.alias("rows"), *[F.sum(c).alias(c) for c in flags]).first()
    nulls = [
        F.nullif(ratio(F.count_if(F.col(c).isNull()), n), F.lit(0.0)).alias(f"null_pct_{c}")
        for c in raw.columns
        if c != CORRUPT
    ]
    measured = raw.agg(n.alias("bronze_row_count"), *nulls)
    return measured.withColumns(
        {
            "duplicates_removed": F.col("bronze_row_count") - F.lit(kept),
            **{f"rejected_{reason}": F.lit(count) for reason, count in sorted(rejects.items())},
            "silver_row_count": F.lit(out["rows"]),
            **{f"{c}_flagged": F.lit(out[c]) for c in flags},
            "conformity_rate": ratio(F.lit(out["rows"]), "bronze_row_count"),
        }
    )


def _reject_counts(staged: DataFrame) -> DataFrame:
    return validate.rejected(staged).groupBy("_error_type").agg(F.count(F.lit(1)).alias("n"))


def process_all(
    bronze: TableStore,
    silver: TableStore,
    errors: TableStore,
    logs: TableStore,
    ctx: RunContext,
    settings: Settings = Settings(),
    specs: Sequence[TableSpec] = tables.ALL,
) -> dict[str, DataFrame]:
    """Every clean table; those that refer to clients are checked against the written clients.

    Clients come first wherever ``specs`` lists them. Where it leaves them out, those of an earlier
    run count, and without any the run fails rather than skip the check.
    """
    out = {}
    clients = silver.read(tables.CLIENTS.silver) if silver.exists(tables.CLIENTS.silver) else None
    for spec in sorted(specs, key=lambda s: s.key != "id_cli"):
        refers = "id_cli" in spec.types and spec.key != "id_cli"
        if refers and clients is None:
            raise ValueError(f"{spec.source} refers to clients, and there are none to check against")
        parent = clients.select("id_cli") if refers else None
        out[spec.source] = process(spec, bronze, silver, errors, logs, ctx, settings, parent)
        if spec.key == "id_cli":
            clients = out[spec.source]
    return out
