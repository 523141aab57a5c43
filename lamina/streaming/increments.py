"""Incremental ingest of arriving files as a streaming job that ends when it has caught up."""

from __future__ import annotations

import json
from dataclasses import replace
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lamina.context import RunContext
from lamina.plans import bronze
from lamina.plans.tables import TableSpec
from lamina.runtime import read_note
from lamina.sources.store import TableStore


def ingest_arrivals(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    store: TableStore,
    spec: TableSpec,
    ctx: RunContext,
    progress: str,
    fmt: str = "parquet",
    fold: bool = True,
) -> StreamingQuery:
    """Bring all files not seen before into a raw table, as increments of their own.

    ``progress`` is the checkpoint folder of the stream: it remembers the files instead of a
    high-water mark, so rows that arrive late are never missed. Each micro-batch is a batch of its
    own, named by the stream (which a restart keeps) and its epoch: one that is repeated after a failure, in this run or a
    later one, replaces what it wrote before and nothing else, so rows without a key are neither lost nor doubled. The version of
    the table is not rewritten; with ``fold`` increments are folded into a new one when they are due, otherwise by
    ``bronze.compact``. Readers use ``bronze.read_raw``.
    """
    arrivals = spark.readStream.format(fmt).schema(schema).load(folder)

    def merge(batch: DataFrame, epoch: int) -> None:
        if not store.exists(spec.source):
            # The first version is empty, so that every epoch is an increment.
            nothing = spark.createDataFrame([], batch.schema)
            store.write(bronze.with_audit(nothing, ctx), spec.source, bronze.INGEST_PARTITIONS, gather=False)
        stream = json.loads(read_note(spark, f"{progress}/metadata"))["id"]
        # The ingest time tells which of two epochs of one run brought a row last.
        own = replace(ctx, batch_id=f"{stream}-{epoch}", run_ts=ctx.run_ts + timedelta(microseconds=epoch))
        bronze.append_increment(batch, spec, store, own, stream, str(epoch))
        if fold:
            bronze.compact_if_due(spec, store, ctx)

    return (
        arrivals.writeStream.foreachBatch(merge)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
