"""The dimensional layer: dimensions, facts and the portfolio indicators."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.context import RunContext
from lamina.functions import classify, dates, money
from lamina.operators import sketches
from lamina.operators.dedup import keep_one
from lamina.operators.joins import DEFAULT_SKEW, SkewPolicy, lookup_join
from lamina.operators.keys import dense_key
from lamina.operators.rolling import trailing_sum, trailing_sum_over
from lamina.runtime import scratch_scope
from lamina.settings import AGE_EDGES, AGE_LABELS, CHANNEL_TYPES, PRODUCT_FAMILIES, Settings
from lamina.sources.store import TableStore


def dim_clients(clients: DataFrame, as_of: date, settings: Settings = Settings()) -> DataFrame:
    """One row per client; of several source rows the one loaded last."""
    one = keep_one(clients, ["id_cli"], ["_ingestion_timestamp"], last=True)
    age = dates.age_years("fec_nac", as_of)
    return one.select(
        "id_cli",
        F.concat("nomb_cli_hash", F.lit("|"), "apell_cli_hash").alias("nombre_completo_hash"),
        "num_doc_hash",
        "tip_doc",
        "fec_nac",
        age.alias("edad"),
        classify.by_band(age, AGE_EDGES, AGE_LABELS, settings.age_null_label).alias("grupo_edad"),
        "fec_alta",
        dates.days_since("fec_alta", as_of).alias("antiguedad_dias"),
        "cod_segmento",
        classify.by_code("cod_segmento", settings.segments).alias("segmento_desc"),
        "score_buro",
        "ciudad_res",
        "depto_res",
        "estado_cli",
        "canal_adquis",
    )


# Names of the product dimension.
PRODUCT_NAMES = {
    "cod_prod": "producto_id",
    "desc_prod": "producto_nombre",
    "tip_prod": "tipo_producto",
    "tasa_ea": "tasa_efectiva_anual",
    "plazo_max_meses": "plazo_maximo_meses",
    "cuota_min": "cuota_minima",
    "comision_admin": "comision_administracion",
    "estado_prod": "estado_producto",
}


def dim_products(products: DataFrame) -> DataFrame:
    """Products under their business names, with monthly rate and family."""
    return products.select(
        *[F.col(old).alias(new) for old, new in PRODUCT_NAMES.items()],
        money.periodic_rate("tasa_ea").alias("tasa_mensual_equivalente"),
        classify.by_set("tip_prod", PRODUCT_FAMILIES, "Transaccional").alias("familia_producto"),
    )


def dim_geography(branches: DataFrame) -> DataFrame:
    """Distinct places with a number that stays the same as long as the places do."""
    return dense_key(branches.select("ciudad", "depto").distinct(), ["ciudad", "depto"], "geo_id")


def dim_channels(branches: DataFrame) -> DataFrame:
    return branches.select(
        "cod_suc", "nom_suc", "tip_punto", "ciudad", "depto", "latitud", "longitud", "activo",
        classify.by_set("tip_punto", CHANNEL_TYPES, "Otro").alias("canal_tipo"),
    )


def dim_dates(movements: DataFrame, day: str = "fec_mov") -> DataFrame:
    """Every day between the first and the last movement."""
    return dates.calendar(movements.agg(F.min(day).alias("first"), F.max(day).alias("last")))


def fact_transactions(movements: DataFrame, settings: Settings = Settings()) -> DataFrame:
    rate = settings.fx_to_usd[settings.home_currency]
    return movements.select(
        "id_mov", "id_cli", "cod_prod", "num_cuenta", "fec_mov", "hra_mov", "vr_mov",
        money.convert("vr_mov", rate).alias("vr_mov_usd"),
        "tip_mov", "cod_canal", "cod_ciudad", "cod_estado_mov", "flag_horario",
        "ind_sospechoso", "avg_30d", "std_30d",
        F.year("fec_mov").alias("fec_mov_year"),
        F.month("fec_mov").alias("fec_mov_month"),
    )


def fact_portfolio(loans: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Loans with delinquency bucket, regulatory rating and provision."""
    days = F.col("dias_mora_act")
    share = classify.by_range(days, settings.provisions, 1.0)
    return loans.select(
        "id_oblig", "id_cli", "cod_prod",
        "vr_aprobado", "vr_desembolsado", "sdo_capital", "vr_cuota",
        "fec_desembolso", "fec_venc", "dias_mora_act",
        classify.by_range(days, settings.buckets, "Desconocido").alias("bucket_mora"),
        "calif_riesgo",
        classify.by_range(days, settings.ratings, "E").alias("calif_regulatoria"),
        "num_cuotas_pend",
        share.alias("pct_provision"),
        money.provision("sdo_capital", share).alias("provision_estimada"),
    )


def monthly(
    df: DataFrame, key: str, day: str, amount: str, counted: str, total: str, number: str
) -> DataFrame:
    """Sum and count per key and month; at most one row per key and month leaves each task."""
    return df.groupBy(
        key, F.year(day).alias("periodo_year"), F.month(day).alias("periodo_month")
    ).agg(F.sum(money.money(amount)).alias(total), F.count(counted).alias(number))


def client_profitability(
    movements: DataFrame, fees: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Monthly income per client and its sum over the last twelve months with activity.

    Both facts are reduced to client months before they meet, and the frame runs over those.
    """
    months = settings.lookback_months
    cutoff = dates.trailing_cutoff(movements, "fec_mov", months)
    moved = monthly(
        dates.since_cutoff(movements, "fec_mov", cutoff).where(F.col("cod_estado_mov") == "APROBADO"),
        "id_cli", "fec_mov", "vr_mov", "id_mov", "total_movimientos", "num_transacciones",
    )
    charged = monthly(
        dates.since_cutoff(fees, "fec_cobro", cutoff).where(F.col("estado_cobro") == "COBRADO"),
        "id_cli", "fec_cobro", "vr_comision", "id_comision",
        "total_comisiones_cobradas", "num_comisiones",
    )
    period = ["id_cli", "periodo_year", "periodo_month"]
    measures = ["total_movimientos", "num_transacciones", "total_comisiones_cobradas", "num_comisiones"]
    both = moved.join(charged, period, "full_outer").fillna(0, subset=measures)
    income = F.col("total_movimientos") * F.lit(str(settings.income_share)).cast("decimal(9,6)")
    both = both.withColumn("ingreso_total", income + F.col("total_comisiones_cobradas"))
    if settings.calendar_lookback:
        index = dates.month_index("periodo_year", "periodo_month")
        return trailing_sum_over(both, "id_cli", index, "ingreso_total", months, "cltv_12m")
    return trailing_sum(
        both, "id_cli", ["periodo_year", "periodo_month"], "ingreso_total", months, "cltv_12m"
    )


def portfolio_kpi(
    portfolio: DataFrame, clients: DataFrame, as_of: date, policy: SkewPolicy = DEFAULT_SKEW
) -> DataFrame:
    """Portfolio, arrears and provisions per product, segment and city.

    Loans are summed per client and product before they meet the clients. The loans of a client with very
    many are combined in each task, so none is hot in the join, and the portfolio is planned once.
    """
    late = F.coalesce(F.col("dias_mora_act") > 0, F.lit(False))
    own = portfolio.groupBy("id_cli", "cod_prod", late.alias("late")).agg(
        F.count("id_oblig").alias("total_obligaciones_activas"),
        F.sum("sdo_capital").alias("monto_total_cartera"),
        F.sum("provision_estimada").alias("total_provision_estimada"),
    )
    known = clients.select("id_cli", "segmento_desc", "ciudad_res")
    placed = lookup_join(own, known, ["id_cli"], "left", policy, even=True)

    def total(name: str, of: Column | None = None) -> Column:
        return F.sum(F.col(name) if of is None else of).cast(own.schema[name].dataType)

    rows, amount, provision = own.columns[3:]
    # A client given twice in a place counts once there. Its rows lie together, so this takes no shuffle.
    place = ["cod_prod", "segmento_desc", "ciudad_res"]
    once = placed.groupBy(*place, "id_cli", "late").agg(*[total(c).alias(c) for c in (rows, amount, provision)])
    kpi = once.groupBy(F.lit(as_of).alias("fec_reporte"), *place).agg(
        total(rows).alias(rows),
        total(amount).alias(amount),
        total(amount, F.when(F.col("late"), F.col(amount)).otherwise(0)).alias("monto_en_mora"),
        F.count(F.when(F.col("late"), F.col("id_cli"))).alias("clientes_con_mora"),
        total(provision).alias(provision),
    )
    return kpi.withColumn("tasa_mora_pct", money.percent("monto_en_mora", "monto_total_cartera"))


def late_client_sketches(portfolio: DataFrame, as_of: date, lg: int = 12) -> DataFrame:
    """Sketches of the clients in arrears, per product, of one day; to be appended to those of other days."""
    late = portfolio.where(F.col("dias_mora_act") > 0)
    found = sketches.distinct_sketches(late, ["cod_prod"], "id_cli", lg)
    return found.select(F.lit(as_of).alias("fec_reporte"), "cod_prod", sketches.SKETCH)


def late_clients_over(daily: DataFrame, first: date, last: date, by: Sequence[str] = ("cod_prod",)) -> DataFrame:
    """Clients that were in arrears on any of several days, about as many as ``sketches.error_bound`` says.

    From the stored sketches alone: the portfolios of those days are not read again.
    """
    days = daily.where(F.col("fec_reporte").between(F.lit(first), F.lit(last)))
    return sketches.merged(days, by).select(*by, sketches.estimate().alias("clientes_con_mora_aprox"))


LATE_CLIENTS = "kpi_clientes_mora_sketches"
TABLES = (
    "dim_clientes", "dim_productos", "dim_geografia", "dim_canal", "dim_fecha",
    "fact_transacciones", "fact_cartera", "fact_rentabilidad_cliente", "kpi_cartera_diaria",
)


def build_all(
    silver: TableStore, gold: TableStore, ctx: RunContext, settings: Settings = Settings()
) -> dict[str, int]:
    """Write every gold table; returns rows per table.

    With ``daily_sketches`` the day's sketches of clients in arrears are added to those of other days. Indicators read the written facts and dimensions instead of planning them a second time.
    """
    clients, products = silver.read("silver_clientes"), silver.read("silver_productos")
    branches, movements = silver.read("silver_sucursales"), silver.read("silver_movimientos")
    loans, fees = silver.read("silver_obligaciones"), silver.read("silver_comisiones")
    steps = {
        "dim_clientes": lambda: dim_clients(clients, ctx.as_of, settings),
        "dim_productos": lambda: dim_products(products),
        "dim_geografia": lambda: dim_geography(branches),
        "dim_canal": lambda: dim_channels(branches),
        "dim_fecha": lambda: dim_dates(movements),
        "fact_transacciones": lambda: fact_transactions(movements, settings),
        "fact_cartera": lambda: fact_portfolio(loans, settings),
        "fact_rentabilidad_cliente": lambda: client_profitability(movements, fees, settings),
        "kpi_cartera_diaria": lambda: portfolio_kpi(
            gold.read("fact_cartera"), gold.read("dim_clientes"), ctx.as_of, settings.skew
        ),
    }
    rows = {}
    for name in TABLES:
        curves = settings.curves.get(name, ())
        with scratch_scope(gold.spark):
            df = steps[name]().withColumn("_gold_timestamp", F.lit(ctx.utc).cast("timestamp"))
            gold.write(df, name, settings.partitions.get(name, ()), curves, along_curve=bool(curves))
        rows[name] = gold.read(name).count()
    if settings.daily_sketches:
        daily = late_client_sketches(gold.read("fact_cartera"), ctx.as_of)
        gold.append(daily, LATE_CLIENTS, ctx.as_of.isoformat())
    return rows
