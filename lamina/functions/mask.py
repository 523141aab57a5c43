"""Masking of sensitive columns, driven by a policy per column."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sha256_hex(col: Column | str, salt: str | None = None) -> Column:
    """Lower-case SHA-256 hex digest of the value's text; NULL stays NULL."""
    text = (F.col(col) if isinstance(col, str) else col).cast("string")
    return F.sha2(F.concat(F.lit(salt), text) if salt else text, 256)


def scaled(col: Column | str, unit: int = 1_000_000, places: int = 2) -> Column:
    """Coarse amount: the value in whole ``unit``s, rounded half up."""
    return F.round((F.col(col) if isinstance(col, str) else col) / F.lit(unit), places)


@dataclass(frozen=True)
class Mask:
    """How one column is masked.

    ``hash`` replaces it by ``<col>_hash``, ``scale`` adds ``<col>_masked``, ``drop`` removes it
    and ``keep`` leaves it. ``keep_clear`` decides whether the clear column stays beside its
    masked form; by default it stays for ``scale`` only.
    """

    how: str = "hash"
    keep_clear: bool | None = None
    salt: str | None = None
    unit: int = 1_000_000

    def __post_init__(self):
        if self.how not in ("hash", "scale", "drop", "keep"):
            raise ValueError(f"unknown masking strategy {self.how!r}")

    @property
    def clear_stays(self) -> bool:
        if self.keep_clear is not None:
            return self.keep_clear
        return self.how in ("scale", "keep")


def mask_columns(df: DataFrame, policy: Mapping[str, Mask]) -> DataFrame:
    """Apply a policy; columns of the policy missing from ``df`` are skipped."""
    present = {c: m for c, m in policy.items() if c in df.columns}
    new = {f"{c}_hash": sha256_hex(c, m.salt) for c, m in present.items() if m.how == "hash"}
    new |= {f"{c}_masked": scaled(c, m.unit) for c, m in present.items() if m.how == "scale"}
    gone = [c for c, m in present.items() if not m.clear_stays]
    return (df.withColumns(new) if new else df).drop(*gone)


def clear_columns(df: DataFrame, policy: Mapping[str, Mask]) -> list[str]:
    """Columns the policy wants gone that are still in the schema of ``df``."""
    return [c for c, m in policy.items() if not m.clear_stays and c in df.columns]


def exposure(df: DataFrame, policy: Mapping[str, Mask]) -> DataFrame:
    """One row per column of a policy: whether its clear form is in ``df``, and in how many rows.

    A column the policy removes must have ``is_clear`` 0; ``clear_values`` tells how much a
    violation would leak.
    """
    removed = [c for c, m in policy.items() if not m.clear_stays]
    here = [c for c in removed if c in df.columns]
    counts = df.agg(
        *[(F.count(c) if c in here else F.lit(0).cast("bigint")).alias(c) for c in removed],
        F.count(F.lit(1)).alias("checked_rows"),
    )
    clear = F.col("column_name").isin(here) if here else F.lit(False)
    return counts.unpivot(["checked_rows"], removed, "column_name", "clear_values").select(
        "column_name", clear.cast("int").alias("is_clear"), "clear_values", "checked_rows"
    )
