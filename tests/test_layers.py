"""All layers, from source tables with known flaws to the report."""

import json
import os
from dataclasses import replace
from datetime import date, datetime, timedelta
from decimal import Decimal
from functools import partial

import pytest
from pyspark.sql import functions as F

from lamina import RunContext, Settings, from_mapping
from lamina.operators.joins import SkewPolicy, lookup_join
from lamina.plans import bronze, gold, silver, tables
from lamina.plans.run import Layers, run_layers
from lamina.runtime import scratch_dir
from lamina.sources import files
from lamina.sources.store import TableStore
from tests.support import plan, rows

DAY = date(2025, 3, 1)
CTX = RunContext("run1", datetime(2025, 3, 1, 2, 0), DAY, "core")


def D(x):
    return Decimal(str(x))


def source(spark):
    clients = spark.createDataFrame(
        [
            (1, " ana ", "paz", "CC", "100", date(1990, 1, 1), date(2020, 1, 1), "01", 700, " lima ", "lima", "activo", "APP_MOVIL"),
            (2, "luz", "rey", "CC", "200", date(1950, 1, 1), date(2021, 1, 1), "04", None, "cali", None, "activo", None),
            (2, "luz", "rey", "CC", "200", date(1950, 1, 1), date(2021, 1, 1), "04", None, "cali", None, "activo", None),
            (3, "eva", "sol", "CE", "300", date(2003, 1, 1), date(2023, 1, 1), "99", 500, "quito", "p", "activo", "OFICINA"),
            (None, "x", "y", "CC", "400", date(2003, 1, 1), date(2023, 1, 1), "01", 500, "quito", "p", "activo", "OFICINA"),
        ],
        "id_cli int, nomb_cli string, apell_cli string, tip_doc string, num_doc string, fec_nac date, "
        "fec_alta date, cod_segmento string, score_buro int, ciudad_res string, depto_res string, "
        "estado_cli string, canal_adquis string")
    products = spark.createDataFrame(
        [("PRD-001", " Libre ", "credito_rotativo", D("0.2000"), 36, D("10.00"), D("1.00"), "activo"),
         ("PRD-002", "Cuenta", "CUENTA_AHORRO", D("0.0000"), 0, D("0.00"), D("0.00"), "activo")],
        "cod_prod string, desc_prod string, tip_prod string, tasa_ea decimal(8,4), plazo_max_meses int, "
        "cuota_min decimal(15,2), comision_admin decimal(15,2), estado_prod string")
    branches = spark.createDataFrame(
        [("SUC-1", "Uno", "digital", "lima", "lima", D("1.5"), D("2.5"), True),
         ("SUC-2", "Dos", "kiosco", "lima", "lima", None, None, False)],
        "cod_suc string, nom_suc string, tip_punto string, ciudad string, depto string, "
        "latitud decimal(10,6), longitud decimal(10,6), activo boolean")
    moves = [(i, 1, "PRD-002", "CTA-1", DAY - timedelta(days=i), "10:00:00", D("100.00"), "pago", "app",
              "lima", "aprobado", "DEV-1") for i in range(1, 15)]
    moves += [
        (100, 1, "PRD-002", "CTA-1", DAY, "23:00:00", D("90000.00"), "pago", "app", "lima", "aprobado", "DEV-9"),
        (101, 1, "PRD-002", "CTA-1", DAY, "23:00:00", D("90000.00"), "pago", "app", "lima", "aprobado", "DEV-9"),
        (102, 1, "PRD-002", "CTA-1", DAY + timedelta(days=1), "10:00:00", D("5.00"), "pago", "app", None, "aprobado", None),
        (103, 77, "PRD-002", "CTA-1", DAY, "10:00:00", D("5.00"), "pago", "app", None, "aprobado", "DEV-7"),
        (104, 2, "PRD-002", "CTA-2", DAY, "07:30:00", D("1000.00"), "pago", "app", None, "rechazado", None),
    ]
    movements = spark.createDataFrame(
        moves, "id_mov bigint, id_cli int, cod_prod string, num_cuenta string, fec_mov date, hra_mov string, "
        "vr_mov decimal(18,2), tip_mov string, cod_canal string, cod_ciudad string, cod_estado_mov string, "
        "id_dispositivo string")
    loan = lambda i, client, days, balance, rating: (
        i, client, "PRD-001", D("1000.00"), D("900.00"), D(balance), None, date(2024, 1, 1), date(2026, 1, 1),
        days, 10, rating)
    loans = spark.createDataFrame(
        [loan(1, 1, 0, "500.00", "A"), loan(2, 1, 45, "300.00", "C"), loan(3, 2, -3, "10.00", "A"),
         loan(4, 2, 5, "2000.00", "B"), loan(5, 88, 5, "10.00", "B")],
        "id_oblig int, id_cli int, cod_prod string, vr_aprobado decimal(18,2), vr_desembolsado decimal(18,2), "
        "sdo_capital decimal(18,2), vr_cuota decimal(18,2), fec_desembolso date, fec_venc date, "
        "dias_mora_act int, num_cuotas_pend int, calif_riesgo string")
    fees = spark.createDataFrame(
        [(1, 1, "PRD-001", date(2025, 2, 1), D("50.00"), "ADMIN", "cobrado"),
         (2, 2, "PRD-001", date(2025, 2, 1), D("70.00"), None, "COBRADO"),
         (3, 2, "PRD-001", date(2020, 2, 1), D("70.00"), None, "COBRADO")],
        "id_comision int, id_cli int, cod_prod string, fec_cobro date, vr_comision decimal(15,2), "
        "tip_comision string, estado_cobro string")
    return dict(zip([t.source for t in tables.ALL], [clients, products, branches, movements, loans, fees]))


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    layers = Layers.under(spark, str(tmp_path_factory.mktemp("lake")))
    frames = source(spark)
    result = run_layers(spark, frames.__getitem__, layers, CTX)
    return layers, frames, result


def test_all_checks_pass(done):
    layers, _, result = done
    assert result.outcome == "ALL_CHECKS_PASSED"
    results = layers.logs.read_all("gold_quality_checks")
    assert results.count() == 19 and results.where("status = 'FAILED'").count() == 0


def test_report_counts_rows(done):
    summary = json.loads(done[2].report_json)["summary"]
    assert summary == {"bronze_total_rows": 5 + 2 + 2 + 19 + 5 + 3, "silver_rejected_records": 6,
                       "gold_quality_checks_passed": 19, "gold_quality_checks_failed": 0}
    assert done[2].volume_anomaly is False


def test_rejects_carry_one_reason_and_no_clear_data(done):
    bad = done[0].errors.read_all(silver.REJECTS)
    assert rows(bad.groupBy("_source_table", "_error_type").count()) == [
        ("TB_CLIENTES_CORE", "null_primary_key", 1),
        ("TB_MOV_FINANCIEROS", "future_date", 1),
        ("TB_MOV_FINANCIEROS", "referential_integrity_fail", 1),
        ("TB_OBLIGACIONES", "negative_dias_mora", 1),
        ("TB_OBLIGACIONES", "referential_integrity_fail", 1),
        ("TB_OBLIGACIONES", "sdo_exceeds_aprobado", 1),
    ]
    assert not {c for cols in tables.PERSONAL.values() for c in cols} & set(bad.columns)


def test_no_clear_personal_column_beyond_bronze(done):
    layers = done[0]
    personal = {c for cols in tables.PERSONAL.values() for c in cols}
    for spec in tables.ALL:
        assert not personal & set(layers.silver.read(spec.silver).columns)
    for name in ("dim_clientes", "fact_transacciones", "fact_cartera"):
        assert not personal & set(layers.gold.read(name).columns)


def test_outlier_hours_and_duplicates(done):
    moves = done[0].silver.read("silver_movimientos")
    assert moves.count() == 16
    assert rows(moves.where("ind_sospechoso = 1").select("id_mov", "flag_horario")) == [(100, "NO_HABIL")]
    assert rows(moves.where("id_mov = 104").select("flag_horario", "cod_estado_mov", "std_30d")) == [
        ("HABIL", "RECHAZADO", None)]


def test_client_dimension(done):
    dim = done[0].gold.read("dim_clientes").orderBy("id_cli").collect()
    assert [(r["id_cli"], r["edad"], r["grupo_edad"], r["segmento_desc"], r["ciudad_res"]) for r in dim] == [
        (1, 35, "35-44", "Básico", "LIMA"), (2, 75, "65+", "Elite", "CALI"), (3, 22, "18-24", None, "QUITO")]
    assert len(dim[0]["nombre_completo_hash"]) == 129
    assert dim[0]["antiguedad_dias"] == (DAY - date(2020, 1, 1)).days


def test_product_and_place_dimensions(done):
    gold = done[0].gold
    assert rows(gold.read("dim_productos").select(
        "producto_id", "producto_nombre", "familia_producto", "tasa_mensual_equivalente")) == [
        ("PRD-001", "Libre", "Crédito", 0.015309), ("PRD-002", "Cuenta", "Ahorro", 0.0)]
    assert rows(gold.read("dim_geografia").select("ciudad", "depto", "geo_id")) == [("LIMA", "LIMA", 1)]
    assert rows(gold.read("dim_canal").select("cod_suc", "canal_tipo", "activo")) == [
        ("SUC-1", "Digital", 1), ("SUC-2", "Otro", 0)]
    assert gold.read("dim_fecha").count() == 15


def test_portfolio_and_kpi(done):
    gold = done[0].gold
    assert rows(gold.read("fact_cartera").select(
        "id_oblig", "bucket_mora", "calif_regulatoria", "pct_provision", "provision_estimada")) == [
        (1, "Al día", "A", 0.01, D("5")), (2, "Rango 2", "C", 0.117, D("35"))]
    kpi = gold.read("kpi_cartera_diaria").collect()
    assert len(kpi) == 1
    assert (kpi[0]["segmento_desc"], kpi[0]["total_obligaciones_activas"], kpi[0]["monto_total_cartera"],
            kpi[0]["monto_en_mora"], kpi[0]["clientes_con_mora"], kpi[0]["tasa_mora_pct"]) == (
        "Básico", 2, D("800.00"), D("300.00"), 1, D("37.50"))


def test_profitability_joins_both_sides(done):
    got = rows(done[0].gold.read("fact_rentabilidad_cliente").select(
        "id_cli", "periodo_year", "periodo_month", F.col("total_movimientos").cast("double"),
        "num_comisiones", F.col("ingreso_total").cast("double"), F.col("cltv_12m").cast("double")))
    assert got == [
        (1, 2025, 2, 1400.0, 1, 71.0, 71.0),
        (1, 2025, 3, 90000.0, 0, 1350.0, 1421.0),
        (2, 2025, 2, 0.0, 1, 70.0, 70.0),
    ]


def test_quality_metrics(done):
    report = done[0].logs.read_all(silver.REPORT)
    mine = report.where("table = 'TB_MOV_FINANCIEROS'")
    values = {r["metric"]: r["value"] for r in mine.collect()}
    assert values["bronze_row_count"] == 19 and values["duplicates_removed"] == 1
    assert values["rejected_null_primary_key"] == 0
    assert values["rejected_future_date"] == 1 and values["silver_row_count"] == 16
    assert values["ind_sospechoso_flagged"] == 1
    assert values["conformity_rate"] == 0.8421
    assert values["null_pct_cod_ciudad"] == 0.1579


def test_running_again_changes_nothing(spark, done):
    layers, frames, _ = done
    names = ["fact_transacciones", "fact_cartera", "kpi_cartera_diaria", "dim_geografia"]
    before = {n: rows(layers.gold.read(n)) for n in names}
    logged = layers.logs.read_all(bronze.LOG).count()
    again = run_layers(spark, frames.__getitem__, layers, CTX)
    assert again.outcome == "ALL_CHECKS_PASSED"
    assert {n: rows(layers.gold.read(n)) for n in names} == before
    assert layers.logs.read_all(bronze.LOG).count() == logged


@pytest.mark.parametrize("mode", ["incremental", "append"])
def test_increments_update_and_add(spark, folder, mode):
    layers = Layers.under(spark, folder)
    frames = source(spark)
    spec = tables.MOVEMENTS
    bronze.ingest_all([spec], frames.__getitem__, layers.bronze, layers.logs, CTX)
    late = replace(CTX, batch_id="run2", run_ts=CTX.run_ts + timedelta(days=1))
    base = frames[spec.source]
    # The day of the watermark is read again: 100 and 104 come once more, 105 is new.
    changed = base.withColumn("vr_mov", F.col("vr_mov") + 1).unionByName(
        base.where("id_mov = 104").withColumn("id_mov", F.lit(105).cast("bigint")))
    for _ in range(2):  # the same batch run again gives the same table
        [result] = bronze.ingest_all(
            [spec], lambda _: changed, layers.bronze, layers.logs, late, mode)
        raw = bronze.read_raw(spec, layers.bronze)
        assert raw.count() == 20
        got = rows(raw.where("id_mov IN (1, 100, 104, 105)").select(
            "id_mov", F.col("vr_mov").cast("double"), "_batch_id"))
        assert got == [(1, 100.0, "run1"), (100, 90001.0, "run2"), (104, 1001.0, "run2"), (105, 1000.0, "run2")]
    assert (result.status, result.row_count) == ("SUCCESS", 6)
    before = rows(raw)
    folded = bronze.increments(spec, layers.bronze)
    # The increment is more than a quarter of the table: one mode folds it at once.
    assert bool(layers.bronze.slots(folded)) == (mode == "append")
    bronze.compact(spec, layers.bronze)
    assert not layers.bronze.slots(folded)
    assert rows(bronze.read_raw(spec, layers.bronze).select(*raw.columns)) == before
    assert not layers.bronze.slots(bronze.increments(spec, layers.bronze))


def test_failed_run_leaves_a_report(spark, folder):
    layers = Layers.under(spark, folder)

    def read(name):
        raise OSError("source is down")

    with pytest.raises(RuntimeError):
        run_layers(spark, read, layers, CTX)
    row = layers.logs.read_all("daily_execution_reports").first()
    assert row["outcome"] == "FAILED" and json.loads(row["report_json"])["status"] == "FAILED"


def test_one_failing_table_does_not_stop_the_others(spark, folder):
    layers = Layers.under(spark, folder)
    frames = source(spark)

    def read(name):
        if name == "TB_PRODUCTOS_CAT":
            raise OSError("no such table")
        return frames[name]

    with pytest.raises(RuntimeError, match="TB_PRODUCTOS_CAT"):
        bronze.ingest_all(tables.ALL, read, layers.bronze, layers.logs, CTX)
    log = layers.logs.read_all(bronze.LOG)
    assert rows(log.groupBy("status").count()) == [("FAILED", 1), ("SUCCESS", 5)]
    assert log.where("status = 'FAILED'").first()["error"] == "no such table"
    with pytest.raises(ValueError):
        bronze.ingest_all([], read, layers.bronze, layers.logs, CTX, mode="sometimes")


def test_curves_and_daily_sketches_are_settings(spark, done, folder):
    layers, _, _ = done
    into = TableStore(spark, folder)
    settings = Settings(
        curves={"fact_transacciones": ("id_cli", "fec_mov"), "fact_cartera": ("id_cli", "dias_mora_act")}, daily_sketches=True)
    for day in (CTX.as_of, CTX.as_of + timedelta(days=1), CTX.as_of):  # a day that runs again replaces its sketches
        gold.build_all(layers.silver, into, replace(CTX, as_of=day), settings)
    for name in ("fact_transacciones", "fact_cartera"):
        drop = "_gold_timestamp"
        assert rows(into.read(name).drop(drop).select(sorted(set(into.read(name).columns) - {drop}))) == rows(
            layers.gold.read(name).select(sorted(set(into.read(name).columns) - {drop})))
    stored = into.read_all(gold.LATE_CLIENTS)
    assert stored.select("fec_reporte").distinct().count() == 2
    late = gold.late_clients_over(stored, CTX.as_of, CTX.as_of + timedelta(days=1))
    exact = into.read("fact_cartera").where("dias_mora_act > 0").groupBy("cod_prod").agg(F.count_distinct("id_cli"))
    assert rows(late) == rows(exact)
    assert from_mapping({"pipeline": {"gold": {"zorder_columns": {"fact_cartera": ["id_cli", "cod_prod"]}}}}).curves == {
        "fact_cartera": ("id_cli", "cod_prod")}


def test_poisoned_gold_is_reported(spark, done, folder):
    from lamina.plans import quality

    layers, _, _ = done
    poisoned = Layers.under(spark, folder)
    for name in quality.NOT_EMPTY:
        df = layers.gold.read(name)
        if name == "fact_transacciones":
            wrong = df.limit(1).withColumns({"id_mov": F.lit(None).cast("bigint"), "id_cli": F.lit(-1),
                                             "fec_mov": F.lit(date(2030, 1, 1))})
            df = df.unionByName(wrong).unionByName(df.where("id_mov = 104"))
        if name == "dim_canal":
            df = df.limit(0)
        poisoned.gold.write(df, name)
    row = quality.check_gold(poisoned.gold, poisoned.logs, CTX).first()
    failed = poisoned.logs.read_all(quality.RESULTS).where("status = 'FAILED'")
    assert rows(failed.select("check_name", "table")) == [
        ("no_exact_duplicates", "fact_transacciones"), ("no_null_primary_keys", "fact_transacciones"),
        ("referential_integrity", "fact_transacciones"), ("row_count_not_zero", "dim_canal"),
        ("valid_date_ranges", "fact_transacciones")]
    assert row["outcome"] == "QUALITY_WARNINGS:5"


def test_imputation_is_a_setting(spark, folder):
    layers = Layers.under(spark, folder)
    frames = source(spark)
    bronze.ingest_all([tables.CLIENTS], frames.__getitem__, layers.bronze, layers.logs, CTX)
    settings = Settings(null_handling={"score_buro": "impute_median", "canal_adquis": "impute_mode"})
    clean = silver.process(
        tables.CLIENTS, layers.bronze, layers.silver, layers.errors, layers.logs, CTX, settings)
    assert rows(clean.where("id_cli = 2").select("score_buro", "canal_adquis", "is_null_score_buro")) == [
        (600, "APP_MOVIL", 1)]


def test_settings_from_a_configuration():
    raw = {
        "business_rules": {
            "fx_rates": {"COP_USD": 0.5, "USD_COP": 2},
            "mora_buckets": [{"name": "ok", "min_days": 0, "max_days": 9}],
            "regulatory_classification": [{"rating": "Z", "mora_range": [0, 9], "provision_pct": 0.2}],
            "suspicious_transaction": {"std_dev_threshold": 2, "rolling_window_days": 7},
            "business_hours": {"start": 8, "end": 17}, "cltv": {"lookback_months": 6},
            "segmentos": {"01": "Uno"},
        },
        "pipeline": {
            "silver": {"pii_columns": {"T": ["c"]}, "masking_strategy": "sha256_hash",
                       "null_handling": {"default": "flag", "overrides": {"score_buro": "impute_median"}}},
            "gold": {"partition_dimensions": {"fact_cartera": ["calif_riesgo"]}},
            "quality": {"min_conformity_rate": 0.9},
        },
        "governance": {"sensitive_columns": [{"table": "T", "columns": ["c", "amount"]}]},
        "orchestration": {"alerts": {"volume_anomaly_threshold_pct": 12}},
    }
    s = from_mapping(raw)
    assert s.fx_to_usd == {"COP": 0.5} and s.segments == {"01": "Uno"}
    assert (s.outlier.threshold, s.outlier.days, s.hours, s.lookback_months) == (2.0, 7, (8, 17), 6)
    assert s.buckets[0].value == "ok" and s.ratings[0].value == "Z" and s.provisions[0].value == 0.2
    assert s.masks["T"]["c"].how == "hash" and not s.masks["T"]["c"].clear_stays
    assert s.null_handling == {"score_buro": "impute_median"} and s.null_default == "flag"
    amounts = from_mapping({"pipeline": {"silver": {"pii_columns": {"TB_OBLIGACIONES": ["sdo_capital"]}}}})
    mask = amounts.masks["TB_OBLIGACIONES"]["sdo_capital"]
    assert mask.how == "hash" and mask.clear_stays
    with pytest.raises(ValueError):
        from_mapping({"pipeline": {"silver": {"pii_columns": {}, "masking_strategy": "rot13"}}})
    assert s.partitions["fact_cartera"] == ("calif_riesgo",) and "fact_transacciones" in s.partitions
    assert (s.min_conformity, s.volume_threshold_pct) == (0.9, 12.0)
    assert s.sensitive == ("c",)
    assert from_mapping({}) == Settings()


def test_export_files_and_declared_gates(spark, folder):
    """A run from CSV exports, with the conformity gate and the personal-data check turned on.

    Two earlier runs of two rows make its volume unusual, and only the last versions are kept.
    """
    frames = source(spark)
    for name, df in frames.items():
        if name == "TB_SUCURSALES_RED":
            df = df.withColumn("activo", F.col("activo").cast("int"))
        files.write_csv(df, f"{folder}/in/{name}.csv")
    layers = Layers.under(spark, f"{folder}/lake")
    strict = Settings(
        min_conformity=0.83, sensitive=("num_doc", "id_dispositivo", "nomb_cli"), keep_versions=1
    )
    for day in (1, 2):
        earlier = replace(CTX, batch_id=f"early{day}", run_ts=CTX.run_ts - timedelta(days=day))
        bronze.ingest_all([tables.PRODUCTS], frames.__getitem__, layers.bronze, layers.logs, earlier)
    read = files.reader(spark, f"{folder}/in", "csv", tables.SOURCE_SCHEMAS)
    scratch = f"{scratch_dir(spark)}/{spark.sparkContext.applicationId}"
    before = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    result = run_layers(spark, read, layers, CTX, strict)
    results = layers.logs.read_all("gold_quality_checks")
    gate = results.where("check_name = 'min_conformity_rate'")
    assert rows(gate.select("table", "status", "details")) == [
        ("TB_CLIENTES_CORE", "FAILED", "0.6 of 0.83"), ("TB_COMISIONES_LOG", "PASSED", "1.0 of 0.83"),
        ("TB_MOV_FINANCIEROS", "PASSED", "0.8421 of 0.83"), ("TB_OBLIGACIONES", "FAILED", "0.4 of 0.83"),
        ("TB_PRODUCTOS_CAT", "PASSED", "1.0 of 0.83"), ("TB_SUCURSALES_RED", "PASSED", "1.0 of 0.83")]
    clear = results.where("check_name = 'no_clear_personal_data'")
    assert clear.count() == 14 and clear.where("status = 'FAILED'").count() == 0
    # The gate warns; it does not change the outcome of the run.
    assert result.outcome == "ALL_CHECKS_PASSED"
    # What the run kept in the scratch folder is gone with it.
    assert set(os.listdir(scratch)) == before
    assert result.volume_anomaly is True
    assert json.loads(result.report_json)["volume_anomaly_alert"] is True
    assert len(layers.bronze._glob("TB_PRODUCTOS_CAT/version=*")) == 1
    with pytest.raises(ValueError):
        files.reader(spark, folder, "xlsx", {})


def test_foreign_keys_are_never_skipped(spark, folder):
    layers = Layers.under(spark, folder)
    ctx = RunContext.now(source_system="t")
    with pytest.raises(ValueError, match="clients"):
        silver.process_all(layers.bronze, layers.silver, layers.bronze, layers.bronze, ctx, specs=[tables.FEES])


def test_lines_that_do_not_fit_are_rejected(spark, folder):
    spec = tables.FEES
    types = dict.fromkeys([*spec.upper, *spec.trim], "string") | dict(spec.types)
    schema = ", ".join(f"{c} {t}" for c, t in types.items())
    values = {c: {"date": "2024-01-02", "string": "x"}.get(str(t), "1") for c, t in types.items()}
    amount = next(c for c, t in types.items() if str(t).startswith("decimal"))
    os.makedirs(f"{folder}/in")
    with open(f"{folder}/in/{spec.source}.csv", "w") as out:
        out.write(",".join(values) + "\n" + ",".join(values.values()) + "\n")
        out.write(",".join((values | {amount: "abc", spec.key: "2"}).values()) + "\n")
    read = files.reader(spark, f"{folder}/in", "csv", {spec.source: schema})
    cleaned = silver.cleaned(read(spec.source).cache(), spec, Settings())
    assert files.CORRUPT not in cleaned.columns
    assert sorted(str(r["_cast_error"]) for r in cleaned.collect()) == ["None", files.CORRUPT]


def test_indicators_sum_per_client_before_the_join(spark, monkeypatch):
    """Clients unknown, missing or given twice, and nothing that a hot client brings to one task."""
    loans = [(i, 7, "a", D(10), 5, D(1)) for i in range(2000)] + [
        (3001, 8, "a", D(4), 0, D(1)), (3002, 8, "a", None, None, None), (3003, None, "a", D(2), 9, D(1)),
        (3004, 9, "b", D(6), 3, D(1)), (3005, 9, "b", D(6), 0, D(1)), (3006, 5, None, D(0), 1, D(0)),
    ]
    schema = "id_oblig long, id_cli long, cod_prod string, sdo_capital decimal(18,2), dias_mora_act int, provision_estimada decimal(28,0)"
    portfolio = spark.createDataFrame(loans, schema)
    clients = spark.createDataFrame(
        [(7, "s", "x"), (8, "s", "x"), (9, "s", "y"), (9, "s", "y"), (9, "t", "y")],
        "id_cli long, segmento_desc string, ciudad_res string",
    )
    joins = []
    plain = gold.lookup_join
    monkeypatch.setattr(gold, "lookup_join", lambda left, *a, **kw: joins.append(left) or plain(left, *a, **kw))
    for limit in (200_000, 0):
        kpi = gold.portfolio_kpi(portfolio, clients, DAY, SkewPolicy(broadcast_rows=limit))
        # product, segment, city: loans, total, late, late clients, provision, rate
        assert rows(kpi.drop("fec_reporte")) == sorted([
            ("a", "s", "x", 2002, D("20004.00"), D("20000.00"), 1, D(2001), D("99.98")),
            ("a", None, None, 1, D("2.00"), D("2.00"), 0, D(1), D("100.00")),
            ("b", "s", "y", 4, D("24.00"), D("12.00"), 1, D(4), D("50.00")),
            ("b", "t", "y", 2, D("12.00"), D("6.00"), 1, D(2), D("50.00")),
            (None, None, None, 1, D("0.00"), D("0.00"), 1, D(0), None),
        ], key=repr)
        assert dict(kpi.dtypes)["monto_en_mora"] == "decimal(28,2)"
        assert joins.pop().groupBy("id_cli").count().agg({"count": "max"}).first()[0] <= 2


def test_indicators_read_the_loans_once(spark, tmp_path, monkeypatch):
    """Lines meet orders in one shuffled join, with the columns of the indicators and no others."""
    from bindings import common, model

    large = partial(lookup_join, policy=SkewPolicy(broadcast_rows=0))
    monkeypatch.setattr(common, "lookup_join", large)
    monkeypatch.setattr(model, "lookup_join", large)
    joined, lines = [], model.lines_with_orders
    monkeypatch.setattr(model, "lines_with_orders", lambda *a: joined.append(a) or lines(*a))
    text = plan(model.kpi_portfolio_daily(spark, "/root/testdata/sf0.001"))
    assert len(joined) == 1
    carried = [line for line in text.split("\n") if line.startswith("Input") and "l_partkey" in line and "o_custkey" in line]
    assert carried and not any("l_returnflag" in line or "l_linestatus" in line for line in carried)
