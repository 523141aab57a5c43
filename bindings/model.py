"""Dimensions, facts, profitability and portfolio indicators, on the driver's tables.

Orders play the movements, order lines the loans and fees, customers the clients, parts the
products and suppliers the branches; the builders themselves are those of the library.
"""

from dataclasses import replace
from datetime import date

from pyspark.sql import functions as F

from bindings.common import (
    AS_OF, BUCKET_SQL, CTX, LINES_SQL, RATING_SQL, SHARE_SQL, events, lineitem, lines_with_orders,
    orders, table,
)
from lamina.functions import dates
from lamina.functions.mask import Mask, mask_columns
from lamina.operators import validate
from lamina.operators.joins import lookup_join
from lamina.operators.keys import hashed_key
from lamina.plans import gold, silver, tables
from lamina.plans.tables import MOVEMENTS
from lamina.runtime import materialize
from lamina.settings import Settings

DIM_AS_OF = date(2024, 1, 1)
SEGMENTS = {"BUILDING": "Básico", "MACHINERY": "Estándar", "FURNITURE": "Premium", "HOUSEHOLD": "Elite"}


def _doubles(df, *cols):
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def _nations(spark, folder):
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("nation"), F.col("n_name").alias("ciudad_res"), "n_regionkey"
    )


def _clients(spark, folder):
    """Customers as clean-layer clients; the date of their first order is their opening date."""
    first = orders(spark, folder).groupBy(F.col("o_custkey").alias("id_cli")).agg(
        F.min("o_orderdate").alias("fec_alta")
    )
    people = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id_cli"),
        F.col("c_name").alias("nomb_cli"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("apell_cli"),
        F.col("c_name").alias("num_doc"),
        F.col("c_mktsegment").alias("cod_segmento"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").cast("int").alias("score_buro"),
    )
    people = lookup_join(people, first, ["id_cli"], "left", right_is_large=True)
    people = lookup_join(people, _nations(spark, folder), ["nation"], "left")
    masked = mask_columns(people, {"nomb_cli": Mask(), "apell_cli": Mask(), "num_doc": Mask()})
    return masked.withColumns(
        {
            "fec_nac": F.col("fec_alta"),
            "tip_doc": F.lit("CC"),
            "depto_res": F.col("n_regionkey").cast("string"),
            "estado_cli": F.lit("ACTIVO"),
            "canal_adquis": F.lit(None).cast("string"),
            "_ingestion_timestamp": F.lit(CTX.utc).cast("timestamp"),
        }
    )


def dim_customer(spark, folder):
    return gold.dim_clients(_clients(spark, folder), DIM_AS_OF, Settings(segments=SEGMENTS))


def dim_product(spark, folder):
    products = table(spark, folder, "part").select(
        F.col("p_partkey").alias("cod_prod"),
        F.col("p_name").alias("desc_prod"),
        F.when(F.col("p_type") == "PROMO", "CUENTA_AHORRO")
        .when(F.col("p_type") == "ECONOMY", "CREDITO_ROTATIVO")
        .otherwise(F.col("p_type"))
        .alias("tip_prod"),
        (F.col("p_size") / 100).alias("tasa_ea"),
        F.col("p_size").alias("plazo_max_meses"),
        F.col("p_retailprice").alias("cuota_min"),
        F.lit(None).cast("double").alias("comision_admin"),
        F.col("p_brand").alias("estado_prod"),
    )
    return gold.dim_products(products)


def _branches(spark, folder):
    points = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("cod_suc"),
        F.col("s_name").alias("nom_suc"),
        F.col("s_nationkey").alias("nation"),
        F.col("s_acctbal").alias("latitud"),
        F.lit(None).cast("double").alias("longitud"),
        (F.col("s_acctbal") >= 0).cast("int").alias("activo"),
    )
    region = table(spark, folder, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("depto"))
    placed = lookup_join(points, _nations(spark, folder), ["nation"], "left")
    placed = lookup_join(placed, region, ["n_regionkey"], "left")
    kind = F.when(F.col("depto") == "ASIA", "DIGITAL").when(F.col("depto") == "EUROPE", "OFICINA")
    return placed.withColumnRenamed("ciudad_res", "ciudad").withColumn(
        "tip_punto", kind.when(F.col("depto") == "AFRICA", "CORRESPONSAL").otherwise("KIOSCO")
    )


def dim_geography(spark, folder):
    return gold.dim_geography(_branches(spark, folder))


def dim_geography_hashed(spark, folder):
    return hashed_key(_branches(spark, folder).select("ciudad", "depto").distinct(), ["ciudad", "depto"], "geo_key")


def dim_channel(spark, folder):
    return gold.dim_channels(_branches(spark, folder))


def dim_date(spark, folder):
    return gold.dim_dates(orders(spark, folder), "o_orderdate")


EVENT_AS_OF = date(2024, 1, 25)
MOVEMENT_SETTINGS = Settings(home_currency="MXN")


def _first_load(spark, folder):
    """Events as raw movements."""
    return events(spark, folder).select(
        F.col("event_id").alias("id_mov"),
        F.col("user_id").alias("id_cli"),
        F.col("event_type").alias("cod_prod"),
        F.col("props").alias("num_cuenta"),
        F.col("event_day").alias("fec_mov"),
        F.date_format("ts", "HH:mm:ss").alias("hra_mov"),
        F.col("value").alias("vr_mov"),
        F.concat(F.lit(" "), "event_type").alias("tip_mov"),
        F.lit("app ").alias("cod_canal"),
        F.lit(None).cast("string").alias("cod_ciudad"),
        F.lit("aprobado").alias("cod_estado_mov"),
        F.get_json_object("props", "$.k").alias("id_dispositivo"),
    )


def _raw_movements(spark, folder):
    """Two loads of movements: the second brings the purchases again under new keys."""
    e = _first_load(spark, folder)
    again = e.where(F.col("cod_prod") == "purchase").withColumn("id_mov", F.col("id_mov") + 1_000_000_000)
    return e.unionByName(again)


def _tagged_movements(spark, folder):
    clients = table(spark, folder, "customer").where(F.col("c_acctbal") >= 0)
    clients = clients.select(F.col("c_custkey").alias("id_cli"))
    ctx = replace(CTX, as_of=EVENT_AS_OF)
    return silver.tagged(_raw_movements(spark, folder), MOVEMENTS, clients, ctx, MOVEMENT_SETTINGS)


def staged_movements(spark, folder):
    """Raw movements, the tagged ones and the clean ones.

    The tagged rows are written once, as in a run: statistics and the rows they are joined to, and
    the rejects, share the cleaning.
    """
    staged = materialize(_tagged_movements(spark, folder), "movements")
    clean = silver.enriched(validate.valid(staged), MOVEMENTS, MOVEMENT_SETTINGS)
    return _raw_movements(spark, folder), staged, clean


def silver_movements(spark, folder):
    clean = staged_movements(spark, folder)[2]
    return _doubles(clean.drop("avg_30d", "std_30d"), "vr_mov")


def silver_rejects(spark, folder):
    bad = validate.rejected(_tagged_movements(spark, folder))
    return bad.groupBy("_error_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("vr_mov").cast("double").alias("amount")
    )


def fact_transactions(spark, folder):
    """The transaction fact over all events: one row each, straight from the clean layer."""
    cleaned = materialize(silver.cleaned(_first_load(spark, folder), MOVEMENTS, MOVEMENT_SETTINGS), "movements")
    clean = silver.enriched(cleaned.drop("_cast_error"), MOVEMENTS, MOVEMENT_SETTINGS)
    fact = gold.fact_transactions(clean, MOVEMENT_SETTINGS).drop("avg_30d", "std_30d")
    return _doubles(fact, "vr_mov", "vr_mov_usd")


def _loans(spark, folder):
    brands = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    lines = lookup_join(
        lines_with_orders(spark, folder), brands, ["l_partkey"], "left", skew_of=lineitem(spark, folder),
        spread_by=["l_orderkey"],
    )
    amount = F.col("l_extendedprice").cast(tables.MONEY)
    return lines.select(
        F.col("l_orderkey").alias("id_oblig"),
        F.col("o_custkey").alias("id_cli"),
        F.col("p_brand").alias("cod_prod"),
        amount.alias("vr_aprobado"),
        amount.alias("vr_desembolsado"),
        amount.alias("sdo_capital"),
        F.lit(None).cast(tables.MONEY).alias("vr_cuota"),
        F.col("o_orderdate").alias("fec_desembolso"),
        F.col("l_shipdate").alias("fec_venc"),
        F.col("days").alias("dias_mora_act"),
        F.col("l_returnflag").alias("calif_riesgo"),
        F.col("l_linenumber").alias("num_cuotas_pend"),
    )


def fact_portfolio(spark, folder):
    fact = gold.fact_portfolio(_loans(spark, folder)).drop("vr_aprobado", "vr_desembolsado", "vr_cuota")
    return _doubles(fact, "sdo_capital", "provision_estimada")


def kpi_portfolio_daily(spark, folder):
    clients = lookup_join(
        table(spark, folder, "customer").withColumnRenamed("c_nationkey", "nation"),
        _nations(spark, folder), ["nation"], "left",
    ).select(
        F.col("c_custkey").alias("id_cli"), F.col("c_mktsegment").alias("segmento_desc"), "ciudad_res"
    )
    loans = gold.fact_portfolio(_loans(spark, folder))
    kpi = gold.portfolio_kpi(loans, clients, AS_OF)
    return _doubles(
        kpi, "monto_total_cartera", "monto_en_mora", "total_provision_estimada", "tasa_mora_pct"
    )


def _movements(spark, folder):
    return orders(spark, folder).select(
        F.col("o_orderkey").alias("id_mov"),
        F.col("o_custkey").alias("id_cli"),
        F.col("o_orderdate").alias("fec_mov"),
        F.col("o_totalprice").alias("vr_mov"),
        F.when(F.col("o_orderstatus") == "F", "APROBADO").otherwise("PENDIENTE").alias("cod_estado_mov"),
    )


def _fees(spark, folder):
    fee = F.col("l_extendedprice").cast(tables.MONEY) * F.col("l_tax").cast("decimal(4,2)")
    return lines_with_orders(spark, folder).select(
        F.col("l_linenumber").alias("id_comision"),
        F.col("o_custkey").alias("id_cli"),
        F.col("l_shipdate").alias("fec_cobro"),
        F.round(fee, 2).alias("vr_comision"),
        F.when(F.col("l_returnflag") == "A", "COBRADO").otherwise("PENDIENTE").alias("estado_cobro"),
    )


def cutoff_12m(spark, folder):
    return dates.trailing_cutoff(orders(spark, folder), "o_orderdate", 12)


def monthly_activity(spark, folder):
    movements = _movements(spark, folder)
    recent = dates.since_cutoff(movements, "fec_mov", dates.trailing_cutoff(movements, "fec_mov", 12))
    recent = recent.where(F.col("cod_estado_mov") == "APROBADO")
    return _doubles(gold.monthly(recent, "id_cli", "fec_mov", "vr_mov", "id_mov", "total", "n"), "total")


def monthly_fees(spark, folder):
    cutoff = dates.trailing_cutoff(orders(spark, folder), "o_orderdate", 12)
    recent = dates.since_cutoff(_fees(spark, folder), "fec_cobro", cutoff)
    recent = recent.where(F.col("estado_cobro") == "COBRADO")
    return _doubles(
        gold.monthly(recent, "id_cli", "fec_cobro", "vr_comision", "id_comision", "total", "n"), "total"
    )


def _profitability(spark, folder, settings):
    fact = gold.client_profitability(_movements(spark, folder), _fees(spark, folder), settings)
    return _doubles(fact, "total_movimientos", "total_comisiones_cobradas", "ingreso_total", "cltv_12m")


def customer_profitability(spark, folder):
    return _profitability(spark, folder, Settings())


def customer_profitability_calendar(spark, folder):
    return _profitability(spark, folder, Settings(calendar_lookback=True))


QUERIES = {
    "dim_customer": dim_customer,
    "dim_product": dim_product,
    "dim_geography": dim_geography,
    "dim_geography_hashed": dim_geography_hashed,
    "dim_channel": dim_channel,
    "dim_date": dim_date,
    "silver_movements": silver_movements,
    "silver_rejects": silver_rejects,
    "fact_transactions": fact_transactions,
    "fact_portfolio": fact_portfolio,
    "kpi_portfolio_daily": kpi_portfolio_daily,
    "cutoff_12m": cutoff_12m,
    "monthly_activity": monthly_activity,
    "monthly_fees": monthly_fees,
    "customer_profitability": customer_profitability,
    "customer_profitability_calendar": customer_profitability_calendar,
}

_PLACES_SQL = """places AS (
    SELECT s.*, n_name AS ciudad, r_name AS depto,
           CASE r_name WHEN 'ASIA' THEN 'DIGITAL' WHEN 'EUROPE' THEN 'OFICINA'
                       WHEN 'AFRICA' THEN 'CORRESPONSAL' ELSE 'KIOSCO' END AS tip_punto
    FROM supplier s JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey)"""

_PLACE_KEY = "sha256('=' || ciudad || chr(31) || '=' || depto)"

_MOVES_SQL = """moves AS (
    SELECT event_id AS id_mov, user_id::INTEGER AS id_cli, event_type AS cod_prod, props AS num_cuenta,
           CAST(ts AS DATE) AS fec_mov, strftime(ts, '%H:%M:%S') AS hra_mov, value AS vr_mov,
           upper(event_type) AS tip_mov, 'APP' AS cod_canal, CAST(NULL AS VARCHAR) AS cod_ciudad,
           'APROBADO' AS cod_estado_mov, sha256(json_extract_string(props, '$.k')) AS id_dispositivo_hash,
           CASE WHEN hour(ts) BETWEEN 7 AND 18 THEN 'HABIL' ELSE 'NO_HABIL' END AS flag_horario
    FROM events)"""

MOVES_ONCE_SQL = _MOVES_SQL + """,
once AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY id_cli, cod_prod, num_cuenta, fec_mov, hra_mov, vr_mov
                                     ORDER BY id_mov) AS rn FROM moves) WHERE rn = 1),
judged AS (
    SELECT once.*, CASE WHEN fec_mov > DATE '2024-01-25' THEN 'future_date'
                        WHEN c_custkey IS NULL THEN 'referential_integrity_fail' END AS reason
    FROM once LEFT JOIN customer ON c_custkey = id_cli AND c_acctbal >= 0)"""

OUTLIER_SQL = """CAST(CASE WHEN stddev_samp(vr_mov) OVER w > 0
                  AND vr_mov > avg(vr_mov) OVER w + 3 * stddev_samp(vr_mov) OVER w
                 THEN 1 ELSE 0 END AS INTEGER) AS ind_sospechoso"""

OUTLIER_WINDOW = """WINDOW w AS (PARTITION BY id_cli ORDER BY fec_mov
                 RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND CURRENT ROW)"""

_CUT_SQL = "(SELECT CAST(max(CAST(o_orderdate AS DATE)) - INTERVAL 12 MONTH AS DATE) FROM orders)"

_MOVED_SQL = f"""moved AS (
    SELECT o_custkey AS id_cli, year(o_orderdate)::INTEGER AS periodo_year,
           month(o_orderdate)::INTEGER AS periodo_month,
           sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total, count(*) AS n
    FROM orders WHERE o_orderstatus = 'F' AND CAST(o_orderdate AS DATE) >= {_CUT_SQL}
    GROUP BY 1, 2, 3)"""

_CHARGED_SQL = f"""charged AS (
    SELECT o_custkey AS id_cli, year(l_shipdate)::INTEGER AS periodo_year,
           month(l_shipdate)::INTEGER AS periodo_month,
           sum(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)), 2)) AS total,
           count(*) AS n
    FROM lines WHERE l_returnflag = 'A' AND l_shipdate >= {_CUT_SQL}
    GROUP BY 1, 2, 3)"""


def _profit_sql(frame: str) -> str:
    return f"""
        WITH {LINES_SQL}, {_MOVED_SQL}, {_CHARGED_SQL}, b AS (
            SELECT id_cli, periodo_year, periodo_month,
                   coalesce(m.total, 0) AS moved, coalesce(m.n, 0) AS num_transacciones,
                   coalesce(c.total, 0) AS charged, coalesce(c.n, 0) AS num_comisiones
            FROM moved m FULL OUTER JOIN charged c USING (id_cli, periodo_year, periodo_month)),
        i AS (SELECT *, CAST(moved * 0.015 + charged AS DECIMAL(38,6)) AS income FROM b)
        SELECT id_cli, periodo_year, periodo_month, moved::DOUBLE AS total_movimientos,
               num_transacciones, charged::DOUBLE AS total_comisiones_cobradas, num_comisiones,
               income::DOUBLE AS ingreso_total,
               CAST(sum(income) OVER (PARTITION BY id_cli ORDER BY {frame}) AS DOUBLE) AS cltv_12m
        FROM i"""


ORACLE = {
    "dim_customer": """
        WITH f AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first FROM orders GROUP BY 1),
        c AS (SELECT *, nullif(c_mktsegment, 'BUILDING') AS seg,
                     CAST(floor((DATE '2024-01-01' - first) / 365.25) AS INTEGER) AS edad
              FROM customer LEFT JOIN f ON o_custkey = c_custkey
                            LEFT JOIN nation ON n_nationkey = c_nationkey)
        SELECT c_custkey AS id_cli, sha256(c_name) || '|' || sha256(seg) AS nombre_completo_hash,
               sha256(c_name) AS num_doc_hash, 'CC' AS tip_doc, first AS fec_nac, edad,
               CASE WHEN edad < 25 THEN '18-24' WHEN edad < 35 THEN '25-34' WHEN edad < 45 THEN '35-44'
                    WHEN edad < 55 THEN '45-54' WHEN edad < 65 THEN '55-64' ELSE '65+' END AS grupo_edad,
               first AS fec_alta, CAST(DATE '2024-01-01' - first AS INTEGER) AS antiguedad_dias,
               c_mktsegment AS cod_segmento,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'Básico' WHEN 'MACHINERY' THEN 'Estándar'
                    WHEN 'FURNITURE' THEN 'Premium' WHEN 'HOUSEHOLD' THEN 'Elite' END AS segmento_desc,
               CAST(trunc(c_acctbal) AS INTEGER) AS score_buro, n_name AS ciudad_res,
               CAST(n_regionkey AS VARCHAR) AS depto_res, 'ACTIVO' AS estado_cli,
               CAST(NULL AS VARCHAR) AS canal_adquis
        FROM c""",
    "dim_product": """
        SELECT p_partkey AS producto_id, p_name AS producto_nombre,
               CASE p_type WHEN 'PROMO' THEN 'CUENTA_AHORRO' WHEN 'ECONOMY' THEN 'CREDITO_ROTATIVO'
                    ELSE p_type END AS tipo_producto,
               p_size / 100 AS tasa_efectiva_anual, p_size AS plazo_maximo_meses,
               p_retailprice AS cuota_minima, CAST(NULL AS DOUBLE) AS comision_administracion,
               p_brand AS estado_producto,
               round(pow(1 + p_size / 100, 1.0 / 12) - 1, 6) AS tasa_mensual_equivalente,
               CASE p_type WHEN 'PROMO' THEN 'Ahorro' WHEN 'ECONOMY' THEN 'Crédito'
                    ELSE 'Transaccional' END AS familia_producto
        FROM part""",
    "dim_geography": f"""
        WITH {_PLACES_SQL}
        SELECT ciudad, depto, row_number() OVER (ORDER BY {_PLACE_KEY}) AS geo_id
        FROM (SELECT DISTINCT ciudad, depto FROM places)""",
    "dim_geography_hashed": f"""
        WITH {_PLACES_SQL} SELECT DISTINCT ciudad, depto, {_PLACE_KEY} AS geo_key FROM places""",
    "dim_channel": f"""
        WITH {_PLACES_SQL}
        SELECT s_suppkey AS cod_suc, s_name AS nom_suc, tip_punto, ciudad, depto,
               s_acctbal AS latitud, CAST(NULL AS DOUBLE) AS longitud,
               CAST(s_acctbal >= 0 AS INTEGER) AS activo,
               CASE tip_punto WHEN 'DIGITAL' THEN 'Digital' WHEN 'CORRESPONSAL' THEN 'Corresponsal'
                    WHEN 'OFICINA' THEN 'Oficina' ELSE 'Otro' END AS canal_tipo
        FROM places""",
    "dim_date": """
        WITH d AS (SELECT CAST(unnest(generate_series(
                       (SELECT min(CAST(o_orderdate AS DATE)) FROM orders),
                       (SELECT max(CAST(o_orderdate AS DATE)) FROM orders), INTERVAL 1 DAY)) AS DATE) AS day)
        SELECT CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_key, day,
               CAST(year(day) AS INTEGER) AS year, CAST(quarter(day) AS INTEGER) AS quarter,
               CAST(month(day) AS INTEGER) AS month, CAST(dayofmonth(day) AS INTEGER) AS day_of_month,
               CAST(isodow(day) AS INTEGER) AS day_of_week,
               CAST(isodow(day) >= 6 AS INTEGER) AS is_weekend
        FROM d""",
    "silver_movements": f"""
        WITH {MOVES_ONCE_SQL}
        SELECT * EXCLUDE (reason), {OUTLIER_SQL} FROM judged WHERE reason IS NULL {OUTLIER_WINDOW}""",
    "silver_rejects": f"""
        WITH {MOVES_ONCE_SQL}
        SELECT reason AS _error_type, count(*) AS n,
               CAST(sum(CAST(vr_mov AS DECIMAL(18,2))) AS DOUBLE) AS amount
        FROM judged WHERE reason IS NOT NULL GROUP BY 1""",
    "fact_transactions": f"""
        WITH {MOVES_ONCE_SQL}
        SELECT * EXCLUDE (id_dispositivo_hash),
               CAST(round(CAST(vr_mov AS DECIMAL(18,2)) * CAST(0.058 AS DECIMAL(9,6)), 2) AS DOUBLE)
                   AS vr_mov_usd,
               {OUTLIER_SQL}, CAST(year(fec_mov) AS INTEGER) AS fec_mov_year,
               CAST(month(fec_mov) AS INTEGER) AS fec_mov_month
        FROM once {OUTLIER_WINDOW}""",
    "fact_portfolio": f"""
        WITH {LINES_SQL}
        SELECT l_orderkey AS id_oblig, o_custkey AS id_cli, p_brand AS cod_prod,
               l_extendedprice AS sdo_capital, o_orderdate AS fec_desembolso, l_shipdate AS fec_venc,
               days AS dias_mora_act, {BUCKET_SQL} AS bucket_mora, l_returnflag AS calif_riesgo,
               {RATING_SQL} AS calif_regulatoria, l_linenumber AS num_cuotas_pend,
               CAST({SHARE_SQL} AS DOUBLE) AS pct_provision,
               CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST({SHARE_SQL} AS DECIMAL(9,6)), 0)
                    AS DOUBLE) AS provision_estimada
        FROM lines LEFT JOIN part ON p_partkey = l_partkey""",
    "kpi_portfolio_daily": f"""
        WITH {LINES_SQL}, p AS (
            SELECT p_brand, c_mktsegment, n_name, l_orderkey, o_custkey, days,
                   CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
                   round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST({SHARE_SQL} AS DECIMAL(9,6)), 0)
                       AS provision
            FROM lines LEFT JOIN part ON p_partkey = l_partkey
                       LEFT JOIN customer ON c_custkey = o_custkey
                       LEFT JOIN nation ON n_nationkey = c_nationkey),
        k AS (
            SELECT p_brand, c_mktsegment, n_name, count(*) AS n, sum(amount) AS total,
                   sum(CASE WHEN days > 0 THEN amount ELSE 0 END) AS late,
                   count(DISTINCT CASE WHEN days > 0 THEN o_custkey END) AS late_clients,
                   sum(provision) AS provision
            FROM p GROUP BY 1, 2, 3)
        SELECT DATE '2001-01-01' AS fec_reporte, p_brand AS cod_prod, c_mktsegment AS segmento_desc,
               n_name AS ciudad_res, n AS total_obligaciones_activas,
               total::DOUBLE AS monto_total_cartera, late::DOUBLE AS monto_en_mora,
               late_clients AS clientes_con_mora, provision::DOUBLE AS total_provision_estimada,
               CAST((CAST(late * 100 AS HUGEINT) * 20000 + CAST(total * 100 AS HUGEINT))
                    // (CAST(total * 100 AS HUGEINT) * 2) AS DOUBLE) / 100 AS tasa_mora_pct
        FROM k""",
    "cutoff_12m": f"SELECT {_CUT_SQL} AS cutoff",
    "monthly_activity": f"""
        WITH {_MOVED_SQL} SELECT * REPLACE (total::DOUBLE AS total) FROM moved""",
    "monthly_fees": f"""
        WITH {LINES_SQL}, {_CHARGED_SQL} SELECT * REPLACE (total::DOUBLE AS total) FROM charged""",
    "customer_profitability": _profit_sql(
        "periodo_year, periodo_month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW"
    ),
    "customer_profitability_calendar": _profit_sql(
        "periodo_year * 12 + periodo_month RANGE BETWEEN 11 PRECEDING AND CURRENT ROW"
    ),
}
