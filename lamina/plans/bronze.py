"""Ingest of source tables into the raw layer."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from lamina.context import RunContext
from lamina.operators.incremental import (
    Watermark, after_watermark, high_watermark, upsert, watermark_of, with_audit,
)
from lamina.plans.tables import TableSpec
from lamina.runtime import materialize, scratch_scope
from lamina.sources.store import TableStore, log_frame

LOG = "bronze_ingestion_log"
LOG_SCHEMA = (
    "table string, row_count bigint, duration_seconds double, status string, mode string, "
    "error string, output_path string, batch_id string, run_ts timestamp"
)
INGEST_PARTITIONS = ("ingestion_year", "ingestion_month", "ingestion_day")
# Notes beside the files of a version or an increment.
_WATERMARK, _FOLDED, _BATCH = "watermark", "folded", "batch"
_REMEMBERED = 64  # folded batches of earlier foldings that a version knows


@dataclass(frozen=True)
class IngestResult:
    table: str
    row_count: int
    duration_seconds: float
    status: str
    mode: str
    error: str | None = None
    output_path: str | None = None


def increments(spec: TableSpec, store: TableStore) -> str:
    """Name of the table holding what came in after the current version was written."""
    if store.fmt == "delta":  # merges in place and has none
        return f"{spec.source}_since"
    return increments_of(spec, store.path(spec.source))


def increments_of(spec: TableSpec, path: str) -> str:
    """Name of the table holding what came in after the version in ``path`` was written."""
    return f"{spec.source}_since_{path.rsplit('/', 1)[-1].replace('version=', '')}"


def read_raw(spec: TableSpec, store: TableStore) -> DataFrame:
    """The raw table as of now: its version, and the latest row of each key that came in since.

    Only the increments are reduced to one row per key; while their keys are few, the version
    itself is filtered without a shuffle. Rows without a key all stay; of a batch that is in the version and
    came once more, those that it brought last.
    """
    base = store.read(spec.source)
    name = increments(spec, store)
    slots = store.slots(name)
    if not slots:
        return base
    order = ["_ingestion_timestamp", *([spec.watermark] if spec.watermark else [])]
    folded = _folded(store, store.path(spec.source))
    again = [folded[slot] for slot in map(_slot_name, slots) if slot in folded]
    return upsert(base, store.read_all(name), [spec.key], order, replaces=again)


def _slot_name(path: str) -> str:
    return path.rsplit("/", 2)[1]


def _folded(store: TableStore, path: str) -> dict[str, str]:
    """The batches that a version was folded from, and the batch id of their rows."""
    return json.loads(store.note(path, _FOLDED) or "{}")


def append_increment(
    df: DataFrame, spec: TableSpec, store: TableStore, ctx: RunContext, *slot: str
) -> str:
    """Write what came in as one batch behind the current version; returns the folder written.

    The same batch (``slot``, by default the batch of the run) written again replaces its own rows only.
    """
    slot = slot or (ctx.batch_id,)
    path = store.append(with_audit(df, ctx), increments(spec, store), *slot)
    store.set_note(path, _BATCH, json.dumps(ctx.batch_id))
    _remember(spec, store, path, ctx)
    return path


def compact(spec: TableSpec, store: TableStore, ctx: RunContext | None = None) -> str:
    """Write the raw table as a new version, which later increments start from.

    The increments it holds now are deleted behind it. Readers that opened the table before must have
    finished, as with ``prune``. With the context of a run its watermark is noted at once.
    """
    folded = increments(spec, store)
    before = store.path(spec.source)
    slots = store.slots(folded)
    # A batch may come once more after a failure: the last one or two foldings are remembered.
    held = dict(list(_folded(store, before).items())[-_REMEMBERED:]) if store.fmt != "delta" else {}
    held |= {_slot_name(s): json.loads(store.note(s, _BATCH) or "null") for s in slots}
    with scratch_scope(store.spark):
        path = store.write(read_raw(spec, store), spec.source, INGEST_PARTITIONS)
    if store.fmt != "delta":
        store.set_note(path, _FOLDED, json.dumps({k: v for k, v in held.items() if v is not None}))
        if ctx is not None:
            _remember(spec, store, path, ctx)
        store.delete_appended(folded)
    return path


def compact_if_due(
    spec: TableSpec, store: TableStore, ctx: RunContext | None = None, share: float = 0.25, batches: int = 32
) -> bool:
    """Fold the increments once they hold ``share`` of the bytes of the version, or so many batches.

    Between two foldings the table grows by that share at least, or by that many runs, so that what foldings rewrite stays in
    proportion to what came in.
    """
    slots = store.slots(increments(spec, store))
    if len(slots) < batches:
        came = sum(map(store.bytes_of, slots))
        if not slots or came < share * store.bytes_of(store.path(spec.source)):
            return False
    compact(spec, store, ctx)
    return True


def ingest_table(
    spec: TableSpec,
    read: Callable[[str], DataFrame],
    store: TableStore,
    ctx: RunContext,
    mode: str = "full",
    inclusive: bool = True,
) -> tuple[int, str]:
    """Bring one table into the raw layer; returns the rows that came in and the folder written.

    ``full`` replaces the table. ``incremental`` writes what lies beyond the watermark as an increment, so its cost
    follows the increment and not the table; readers take the latest row per key (``read_raw``), and increments are
    folded into a new version once they are a quarter of it. ``append`` leaves the folding to the
    user (``compact``). A Delta table merges the increment in place in both modes.

    The source is read once: the incoming rows are written first, and counted from what was
    written (an exact number even where tasks had to run again). ``inclusive`` reads the day of
    the watermark again, since a day may still have received rows after the last run.
    """
    source = read(spec.source)
    if mode == "full" or not store.exists(spec.source):
        # All rows have the ingest date of this run: nothing to bring together.
        path = store.write(with_audit(source, ctx), spec.source, INGEST_PARTITIONS, gather=False)
        _remember(spec, store, path, ctx)
        return store.read(spec.source).count(), path
    if spec.watermark:
        mark = known_watermark(spec, store, ctx)
        source = after_watermark(source, spec.watermark, mark, inclusive)
    if store.fmt == "delta":
        with scratch_scope(store.spark):
            incoming = materialize(with_audit(source, ctx), f"incoming-{spec.source}")
            order = [spec.watermark] if spec.watermark else []
            store.merge(upsert(None, incoming, [spec.key], order), spec.source, [spec.key])
            return incoming.count(), store.path(spec.source)
    path = append_increment(source, spec, store, ctx)
    came = store.open(path).count()
    if mode == "incremental" and compact_if_due(spec, store, ctx):
        path = store.path(spec.source)
    return came, path


def _dated(spec: TableSpec, store: TableStore, path: str) -> bool:
    """Whether the watermark is a day or a moment, which footers tell and notes keep."""
    if spec.watermark is None or store.fmt != "parquet":
        return False
    return store.open(path).schema[spec.watermark].dataType.typeName() in ("date", "timestamp", "timestamp_ntz")


def _remember(spec: TableSpec, store: TableStore, path: str, ctx: RunContext) -> Watermark | None:
    """Note the watermark of a committed folder beside its files."""
    if not _dated(spec, store, path):
        return None
    mark = watermark_of(store.open(path), path, spec.watermark, ctx.as_of)
    store.set_note(path, f"{_WATERMARK}_{spec.watermark}", mark.to_json())
    return mark


def _known_mark(spec: TableSpec, store: TableStore, path: str, ctx: RunContext):
    """The watermark of a folder from its note; one that is lost, or of a later date, is made again."""
    noted = store.note(path, f"{_WATERMARK}_{spec.watermark}")
    if noted is not None:
        known, mark = Watermark.from_json(noted).up_to(ctx.as_of)
        if known:
            return mark
    mark = _remember(spec, store, path, ctx)
    if mark is None:  # neither a day nor a moment
        return high_watermark(store.open(path), spec.watermark, cap=ctx.as_of)
    return mark.mark


def known_watermark(spec: TableSpec, store: TableStore, ctx: RunContext):
    """The watermark over version and increments, from what was noted with each; no rows are read.

    What this very batch appended in an earlier attempt does not count: it is about to be replaced.
    """
    folders = [store.path(spec.source)]
    if store.fmt != "delta":
        name = increments(spec, store)
        own = store.slot_folder(name, ctx.batch_id)
        folders += [slot for slot in store.slots(name) if slot != own]
    marks = [_known_mark(spec, store, folder, ctx) for folder in folders]
    return max((m for m in marks if m is not None), default=None)


def ingest_all(
    specs: Sequence[TableSpec],
    read: Callable[[str], DataFrame],
    store: TableStore,
    logs: TableStore,
    ctx: RunContext,
    mode: str = "full",
    inclusive: bool = True,
) -> list[IngestResult]:
    """Ingest every table; one that fails does not stop the others.

    The log of the run is written in any case; failures are raised after it, together.
    """
    if mode not in ("full", "incremental", "append"):
        raise ValueError(f"unknown ingest mode {mode!r}")
    results = []
    for spec in specs:
        start = time.monotonic()
        try:
            rows, path = ingest_table(spec, read, store, ctx, mode, inclusive)
            outcome = (rows, "SUCCESS", None, path)
        except Exception as error:  # kept in the log, raised below with the others
            outcome = (0, "FAILED", str(error), None)
        rows, status, text, path = outcome
        seconds = round(time.monotonic() - start, 2)
        results.append(IngestResult(spec.source, rows, seconds, status, mode, text, path))
    rows = [
        (r.table, r.row_count, r.duration_seconds, r.status, r.mode, r.error, r.output_path,
         ctx.batch_id, ctx.utc)
        for r in results
    ]
    logs.append(log_frame(logs.spark, rows, LOG_SCHEMA), LOG, ctx.batch_id)
    failed = [r.table for r in results if r.status == "FAILED"]
    if failed:
        raise RuntimeError(f"ingest failed for: {', '.join(failed)}")
    return results
