"""Rules and parameters of a run, as typed values that can be read from a YAML file."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from lamina.functions.classify import Range
from lamina.functions.mask import Mask
from lamina.operators.joins import DEFAULT_SKEW, SkewPolicy
from lamina.operators.rolling import OutlierRule

# The defaults below must equal the rules of the source system for right results.
SEGMENTS = {"01": "Básico", "02": "Estándar", "03": "Premium", "04": "Elite"}

DELINQUENCY_BUCKETS = (
    Range(0, 0, "Al día"),
    Range(1, 30, "Rango 1"),
    Range(31, 60, "Rango 2"),
    Range(61, 90, "Rango 3"),
    Range(91, 999999, "Deteriorado"),
)

RATINGS = (
    Range(0, 0, "A"),
    Range(1, 30, "B"),
    Range(31, 60, "C"),
    Range(61, 90, "D"),
    Range(91, 999999, "E"),
)

PROVISION_SHARES = (
    Range(0, 0, 0.01),
    Range(1, 30, 0.032),
    Range(31, 60, 0.117),
    Range(61, 90, 0.50),
    Range(91, 999999, 1.00),
)

FX_TO_USD = {"COP": 0.000245, "MXN": 0.058, "PEN": 0.267, "CLP": 0.00106, "ARS": 0.00114}

AGE_EDGES = (25, 35, 45, 55, 65)
AGE_LABELS = ("18-24", "25-34", "35-44", "45-54", "55-64", "65+")

PRODUCT_FAMILIES = {
    "Crédito": ("CREDITO_LIBRE_INVERSION", "CREDITO_ROTATIVO", "TARJETA_DIGITAL"),
    "Ahorro": ("CUENTA_AHORRO",),
}

CHANNEL_TYPES = {
    "Digital": ("DIGITAL",),
    "Corresponsal": ("CORRESPONSAL",),
    "Oficina": ("OFICINA",),
}

MASKS = {
    "TB_CLIENTES_CORE": {"nomb_cli": Mask(), "apell_cli": Mask(), "num_doc": Mask()},
    "TB_MOV_FINANCIEROS": {"id_dispositivo": Mask()},
    "TB_OBLIGACIONES": {"sdo_capital": Mask("scale"), "vr_desembolsado": Mask("scale")},
}

PARTITIONS = {
    "silver_movimientos": ("fec_mov",),
    "fact_transacciones": ("fec_mov_year", "fec_mov_month"),
    "fact_cartera": ("calif_regulatoria", "bucket_mora"),
    "fact_rentabilidad_cliente": ("periodo_year", "periodo_month"),
}

NULL_OVERRIDES = {"score_buro": "impute_median", "canal_adquis": "impute_mode"}


@dataclass(frozen=True)
class Settings:
    """Everything a run can be configured with; the defaults are the source system's rules."""

    segments: Mapping[str, str] = field(default_factory=lambda: dict(SEGMENTS))
    buckets: tuple[Range, ...] = DELINQUENCY_BUCKETS
    ratings: tuple[Range, ...] = RATINGS
    provisions: tuple[Range, ...] = PROVISION_SHARES
    fx_to_usd: Mapping[str, float] = field(default_factory=lambda: dict(FX_TO_USD))
    home_currency: str = "COP"
    outlier: OutlierRule = OutlierRule()
    hours: tuple[int, int] = (7, 18)
    income_share: float = 0.015
    lookback_months: int = 12
    calendar_lookback: bool = False
    masks: Mapping[str, Mapping[str, Mask]] = field(default_factory=lambda: dict(MASKS))
    partitions: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: dict(PARTITIONS))
    # Tables clustered along a curve by several columns, for readers that filter on any one of them.
    curves: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    # Keep daily sketches of the clients in arrears, for distinct numbers over several days.
    daily_sketches: bool = False
    null_policy: str = "reject"
    # None leaves missing values as they are; a mapping turns handling on for its columns.
    null_handling: Mapping[str, str] | None = None
    # How the other columns of a table are handled; None leaves those as they are.
    null_default: str | None = None
    # Checked only where given.
    min_conformity: float | None = None
    # Columns that must not appear in clear beyond the raw layer; checked only where given.
    sensitive: tuple[str, ...] = ()
    volume_threshold_pct: float = 30.0
    age_null_label: str | None = None
    # Former versions of each table are deleted after a run, down to this many; None keeps all.
    keep_versions: int | None = None
    skew: SkewPolicy = DEFAULT_SKEW


def _ranges(items, value_key: str, low_high) -> tuple[Range, ...]:
    return tuple(Range(*low_high(i), i[value_key]) for i in items)


def from_mapping(raw: Mapping, base: Settings = Settings()) -> Settings:
    """Settings from a parsed configuration; whatever it does not mention keeps its default."""
    new: dict = {}
    rules = raw.get("business_rules", {})
    if "segmentos" in rules:
        new["segments"] = dict(rules["segmentos"])
    if "mora_buckets" in rules:
        new["buckets"] = _ranges(
            rules["mora_buckets"], "name", lambda i: (i["min_days"], i["max_days"])
        )
    if "regulatory_classification" in rules:
        rated = rules["regulatory_classification"]
        new["ratings"] = _ranges(rated, "rating", lambda i: i["mora_range"])
        new["provisions"] = _ranges(rated, "provision_pct", lambda i: i["mora_range"])
    if "fx_rates" in rules:
        # Entries are named FROM_TO; rates to the reporting currency are the ones used.
        new["fx_to_usd"] = {
            pair[: -len("_USD")]: rate
            for pair, rate in rules["fx_rates"].items()
            if pair.endswith("_USD")
        }
    outlier = rules.get("suspicious_transaction", {})
    if outlier:
        new["outlier"] = replace(
            base.outlier,
            threshold=float(outlier.get("std_dev_threshold", base.outlier.threshold)),
            days=int(outlier.get("rolling_window_days", base.outlier.days)),
        )
    if "business_hours" in rules:
        new["hours"] = (rules["business_hours"]["start"], rules["business_hours"]["end"])
    if "cltv" in rules:
        new["lookback_months"] = rules["cltv"]["lookback_months"]

    layers = raw.get("pipeline", {})
    silver = layers.get("silver", {})
    if "pii_columns" in silver:
        strategy = silver.get("masking_strategy", "sha256_hash")
        if strategy != "sha256_hash":
            raise ValueError(f"unknown masking strategy {strategy!r}")
        # Amounts that the rules and facts compute with stay readable beside their digest.
        clear = {(t, c) for t, masks in base.masks.items() for c, m in masks.items() if m.clear_stays}
        new["masks"] = {
            table: {c: Mask("hash", keep_clear=(table, c) in clear) for c in cols}
            for table, cols in silver["pii_columns"].items()
        }
    if "null_handling" in silver:
        new["null_handling"] = dict(silver["null_handling"].get("overrides", {}))
        new["null_default"] = silver["null_handling"].get("default")
    partitions = layers.get("gold", {}).get("partition_dimensions", {})
    if partitions:
        new["partitions"] = {**base.partitions, **{t: tuple(c) for t, c in partitions.items()}}
    curves = layers.get("gold", {}).get("zorder_columns", {})
    if curves:
        new["curves"] = {**base.curves, **{t: tuple(c) for t, c in curves.items()}}
    if "min_conformity_rate" in layers.get("quality", {}):
        new["min_conformity"] = layers["quality"]["min_conformity_rate"]
    alerts = raw.get("orchestration", {}).get("alerts", {})
    if "volume_anomaly_threshold_pct" in alerts:
        new["volume_threshold_pct"] = float(alerts["volume_anomaly_threshold_pct"])
    masked = {c for cols in new.get("masks", base.masks).values() for c, m in cols.items() if not m.clear_stays}
    listed = raw.get("governance", {}).get("sensitive_columns", [])
    # Classified columns stay readable where the masking policy keeps them (amounts, dates).
    new["sensitive"] = tuple(sorted(masked & {c for entry in listed for c in entry["columns"]}))
    return replace(base, **new)


def from_yaml(path: str, base: Settings = Settings()) -> Settings:
    """Settings from a YAML file on the driver."""
    import yaml

    with open(path, encoding="utf-8") as handle:
        return from_mapping(yaml.safe_load(handle), base)
