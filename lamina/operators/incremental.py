"""Audited ingest, high-water marks and upserts."""

from __future__ import annotations

import json
import operator
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.context import RunContext
from lamina.operators.dedup import keep_one
from lamina.operators.joins import DEFAULT_SKEW, SkewPolicy, lookup_join
from lamina.runtime import materialize

_BATCH = "_batch_id"
# Days beyond the business date that a watermark remembers, for the runs that will count them.
_LATER = 1000


@dataclass(frozen=True)
class Watermark:
    """The greatest value of a batch up to a business date, and the values beyond that date.

    ``later`` holds the least of them, all unless ``more``. What a later date lets in is known without the rows.
    """

    as_of: date
    mark: date | datetime | None
    later: tuple[date | datetime, ...] = ()
    more: bool = False

    def up_to(self, cap: date) -> tuple[bool, date | datetime | None]:
        """Whether the greatest value up to ``cap`` is known, and that value."""
        limit = _like(cap, self.later[0] if self.later else cap)
        if cap < self.as_of or (self.more and limit >= self.later[-1]):
            return False, None
        within = [v for v in self.later if v <= limit]
        return True, within[-1] if within else self.mark

    def to_json(self) -> str:
        told = lambda v: None if v is None else v.isoformat()
        return json.dumps(
            {"as_of": told(self.as_of), "mark": told(self.mark), "later": [told(v) for v in self.later], "more": self.more,
             "type": "timestamp" if isinstance(self.mark or (self.later or (None,))[0], datetime) else "date"}
        )

    @classmethod
    def from_json(cls, text: str) -> Watermark:
        held = json.loads(text)
        read = datetime.fromisoformat if held["type"] == "timestamp" else date.fromisoformat
        mark = None if held["mark"] is None else read(held["mark"])
        return cls(date.fromisoformat(held["as_of"]), mark, tuple(map(read, held["later"])), held["more"])


def _like(day: date, value: date | datetime) -> date | datetime:
    """A day as the midnight it begins with, where it is compared with timestamps."""
    return datetime(day.year, day.month, day.day) if isinstance(value, datetime) else day


def watermark_of(written: DataFrame, path: str, col: str, as_of: date) -> Watermark:
    """The watermark of a Parquet table written to ``path``, from the statistics in its footers.

    Rows are read only where the greatest value lies beyond ``as_of``, and then those of one column.
    """
    largest = footer_maximum(written, path, col).first()[0]
    if largest is None or largest <= _like(as_of, largest):
        return Watermark(as_of, largest)
    values = written.select(col)
    mark = high_watermark(values, col, cap=as_of)
    later = values.where(F.col(col) > F.lit(as_of)).distinct().orderBy(col).limit(_LATER + 1).collect()
    return Watermark(as_of, mark, tuple(r[0] for r in later[:_LATER]), len(later) > _LATER)


def footer_maximum(written: DataFrame, path: str, col: str) -> DataFrame:
    """``largest``, the greatest value of a column, by a plan that takes it from the footers where these tell it.

    A session of its own, since other queries keep the reader they have.
    """
    own = written.sparkSession.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.session.timeZone", "UTC")
    return own.read.schema(written.schema).parquet(path).agg(F.max(col).alias("largest"))


def with_audit(df: DataFrame, ctx: RunContext) -> DataFrame:
    """Add when, from where and by which batch the rows came, and the ingest date parts."""
    ts = ctx.utc
    return df.withColumns(
        {
            "_ingestion_timestamp": F.lit(ts).cast("timestamp"),
            "_source_system": F.lit(ctx.source_system),
            "_batch_id": F.lit(ctx.batch_id),
            "ingestion_year": F.lit(ts.year),
            "ingestion_month": F.lit(ts.month),
            "ingestion_day": F.lit(ts.day),
        }
    )


def watermark_frame(df: DataFrame, col: str, cap: date | None = None) -> DataFrame:
    """One row with ``watermark``: the greatest value, of those up to ``cap`` if given.

    The cap keeps rows dated in the future from hiding everything that arrives before that date.
    """
    if cap is not None:
        df = df.where(F.col(col) <= F.lit(cap))
    return df.agg(F.max(col).alias("watermark"))


def high_watermark(df: DataFrame, col: str, cap: date | None = None):
    """The watermark as a typed value, None for an empty table."""
    return watermark_frame(df, col, cap).first()[0]


def after_watermark(df: DataFrame, col: str, watermark, inclusive: bool = False) -> DataFrame:
    """Rows beyond the watermark, all rows without one.

    A plain comparison with a typed literal, so JDBC and Parquet sources filter it themselves.
    ``inclusive`` reads the boundary value again, for a watermark as coarse as a day; the upsert
    then removes the repeats.
    """
    if watermark is None:
        return df
    mark = F.lit(watermark)
    return df.where(F.col(col) >= mark if inclusive else F.col(col) > mark)


def upsert(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    policy: SkewPolicy = DEFAULT_SKEW,
    replaces: Sequence[str] = (),
) -> DataFrame:
    """The target with rows of equal key replaced by those of the source, and new rows added.

    Of several source rows with one key the last by ``order`` counts. Rows with a NULL in their key
    equal no other row: all of them stay, on both sides, for a later rule to reject; only those of the batches
    that the source brings again (``replaces``, values of ``_batch_id``) go from the target.
    Without a target the result is the source with one row per key. Only keys of the source take part
    in the join: those of a small increment are broadcast, and the target is filtered without a
    shuffle. Columns one side lacks are NULL there.
    """
    keys = list(keys)
    no_key = reduce(operator.or_, [F.col(k).isNull() for k in keys])
    latest = keep_one(source.where(~no_key), keys, order, last=True)
    if target is None:
        return latest.unionByName(source.where(no_key))
    # Measured, joined and added to the result: written once instead of reduced three times.
    latest = materialize(latest, "latest-rows")
    arrived = latest.unionByName(source.where(no_key))
    kept = lookup_join(target.where(~no_key), latest.select(*keys), keys, "left_anti", policy)
    loose = target.where(no_key)
    if replaces and _BATCH in target.columns:
        loose = loose.where(~F.coalesce(F.col(_BATCH).isin(list(replaces)), F.lit(False)))
    return arrived.unionByName(kept.unionByName(loose), allowMissingColumns=True)
