"""The source tables of the retail-banking model and how each is cleaned.

Table and column names and the type of each column are those of the source system.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

MONEY = "decimal(18,2)"


@dataclass(frozen=True)
class TableSpec:
    """One source table: its key, its watermark, and the cleaning of its columns.

    ``copies`` tells what counts as a duplicate: ``exact`` rows, or rows equal in all ``business``
    columns whatever their key.
    """

    source: str
    silver: str
    key: str
    watermark: str | None = None
    types: Mapping[str, str] = field(default_factory=dict)
    upper: tuple[str, ...] = ()
    trim: tuple[str, ...] = ()
    copies: str = "exact"


CLIENTS = TableSpec(
    "TB_CLIENTES_CORE",
    "silver_clientes",
    "id_cli",
    types={"id_cli": "int", "fec_nac": "date", "fec_alta": "date", "score_buro": "int"},
    upper=("nomb_cli", "apell_cli", "ciudad_res", "depto_res", "estado_cli"),
)

PRODUCTS = TableSpec(
    "TB_PRODUCTOS_CAT",
    "silver_productos",
    "cod_prod",
    types={
        "tasa_ea": "double",
        "plazo_max_meses": "int",
        "cuota_min": MONEY,
        "comision_admin": MONEY,
    },
    upper=("tip_prod", "estado_prod"),
    trim=("desc_prod",),
)

BRANCHES = TableSpec(
    "TB_SUCURSALES_RED",
    "silver_sucursales",
    "cod_suc",
    types={"latitud": "double", "longitud": "double", "activo": "int"},
    upper=("ciudad", "depto", "tip_punto"),
)

MOVEMENTS = TableSpec(
    "TB_MOV_FINANCIEROS",
    "silver_movimientos",
    "id_mov",
    watermark="fec_mov",
    types={"id_mov": "bigint", "id_cli": "int", "fec_mov": "date", "vr_mov": MONEY},
    upper=("tip_mov", "cod_canal", "cod_estado_mov"),
    copies="business",
)

LOANS = TableSpec(
    "TB_OBLIGACIONES",
    "silver_obligaciones",
    "id_oblig",
    watermark="fec_desembolso",
    types={
        "id_oblig": "int",
        "id_cli": "int",
        "vr_aprobado": MONEY,
        "vr_desembolsado": MONEY,
        "sdo_capital": MONEY,
        "vr_cuota": MONEY,
        "dias_mora_act": "int",
        "num_cuotas_pend": "int",
        "fec_desembolso": "date",
        "fec_venc": "date",
    },
)

FEES = TableSpec(
    "TB_COMISIONES_LOG",
    "silver_comisiones",
    "id_comision",
    watermark="fec_cobro",
    types={"id_comision": "int", "id_cli": "int", "fec_cobro": "date", "vr_comision": MONEY},
    upper=("tip_comision", "estado_cobro"),
)

ALL = (CLIENTS, PRODUCTS, BRANCHES, MOVEMENTS, LOANS, FEES)

# Personal columns: a masked copy may be kept, the clear column may not leave bronze.
PERSONAL = {
    "TB_CLIENTES_CORE": ("nomb_cli", "apell_cli", "num_doc"),
    "TB_MOV_FINANCIEROS": ("id_dispositivo",),
}

# Columns and types of the source tables, for exports that carry no types.
SOURCE_SCHEMAS = {
    "TB_CLIENTES_CORE": (
        "id_cli int, nomb_cli string, apell_cli string, tip_doc string, num_doc string, fec_nac date, "
        "fec_alta date, cod_segmento string, score_buro double, ciudad_res string, depto_res string, "
        "estado_cli string, canal_adquis string"
    ),
    "TB_PRODUCTOS_CAT": (
        "cod_prod string, desc_prod string, tip_prod string, tasa_ea decimal(8,4), "
        "plazo_max_meses int, cuota_min decimal(15,2), comision_admin decimal(15,2), estado_prod string"
    ),
    "TB_SUCURSALES_RED": (
        "cod_suc string, nom_suc string, tip_punto string, ciudad string, depto string, "
        "latitud decimal(10,6), longitud decimal(10,6), activo int"
    ),
    "TB_MOV_FINANCIEROS": (
        "id_mov bigint, id_cli int, cod_prod string, num_cuenta string, fec_mov date, hra_mov string, "
        "vr_mov decimal(18,2), tip_mov string, cod_canal string, cod_ciudad string, "
        "cod_estado_mov string, id_dispositivo string"
    ),
    "TB_OBLIGACIONES": (
        "id_oblig int, id_cli int, cod_prod string, vr_aprobado decimal(18,2), "
        "vr_desembolsado decimal(18,2), sdo_capital decimal(18,2), vr_cuota decimal(18,2), "
        "fec_desembolso date, fec_venc date, dias_mora_act int, num_cuotas_pend double, "
        "calif_riesgo string"
    ),
    "TB_COMISIONES_LOG": (
        "id_comision int, id_cli int, cod_prod string, fec_cobro date, vr_comision decimal(15,2), "
        "tip_comision string, estado_cobro string"
    ),
}
