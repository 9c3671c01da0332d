"""Incremental ingest of a landing folder: each file is taken in once, however often it runs."""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.listener import StreamingQueryListener


#: How long the events of a query that has ended may take to arrive.
REPORT_SECONDS = 300


class _RowCount(StreamingQueryListener):
    """Rows of every batch of one run, however many batches there are."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        self.rows[run] = self.rows.get(run, 0) + event.progress.numInputRows

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.runId)].set()

    def of(self, run: str) -> int | None:
        # Events follow the query; its last one comes after all progress. The rows are committed either way.
        return self.rows.get(run, 0) if self.ended[run].wait(REPORT_SECONDS) else None


def land_increment(
    spark: SparkSession,
    source: str,
    schema: T.StructType | str,
    sink: str,
    checkpoint: str,
    source_format: str = "json",
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    unique_by: Sequence[str] | None = None,
    partition_by: Sequence[str] = (),
    files_per_batch: int | None = None,
    **reader_options: object,
) -> int | None:
    """Append the not yet seen files of ``source`` to the Parquet folder ``sink``; returns rows read, or None if
    they are landed but their count was not reported in time.

    The checkpoint remembers the files, so running again adds only new ones and a broken run is
    resumed without loss or repeats. ``unique_by`` also leaves out records whose key the sink has
    already (a replaced file that carries the same ones), however old they are; with
    ``partition_by`` only the sink partitions that a batch touches are read for that.
    """
    reader = spark.readStream.schema(schema).format(source_format).options(**reader_options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.load(source)
    if prepare:
        rows = prepare(rows)
    stream = rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    counter = _RowCount()
    spark.streams.addListener(counter)
    try:
        query = _started(stream, rows, sink, unique_by, partition_by)
        query.awaitTermination()
        return counter.of(str(query.runId))
    finally:
        spark.streams.removeListener(counter)


def _started(stream, rows: DataFrame, sink: str, unique_by: Sequence[str] | None, partition_by: Sequence[str]):
    if unique_by:
        return stream.foreachBatch(_append_new(sink, rows.schema, list(unique_by), list(partition_by))).start()
    if partition_by:
        stream = stream.partitionBy(*partition_by)
    return stream.format("parquet").start(sink)


def _append_new(sink: str, schema: T.StructType, keys: list[str], parts: list[str]):
    """Batch writer that a retry may run again: rows it wrote the first time are then known keys."""

    def write(batch: DataFrame, batch_id: int) -> None:
        fresh = batch.dropDuplicates(keys)
        known = _existing(batch.sparkSession, sink, schema)
        if known is not None:
            known = _touched(known, batch, parts).select(*[F.col(k).alias(f"__{k}") for k in keys])
            same = F.lit(True)
            for key in keys:
                same = same & F.col(key).eqNullSafe(F.col(f"__{key}"))
            fresh = fresh.join(known, same, "left_anti")
        if parts:
            fresh = fresh.hint("rebalance", *parts)
        writer = fresh.write.mode("append")
        (writer.partitionBy(*parts) if parts else writer).parquet(sink)

    return write


def _existing(spark: SparkSession, sink: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(sink)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _touched(known: DataFrame, batch: DataFrame, parts: list[str]) -> DataFrame:
    """Rows of the sink partitions that the batch touches; the join prunes the scan where it can."""
    if not parts:
        return known
    touched = batch.select(*[F.col(p).alias(f"__{p}") for p in parts]).distinct()
    same = F.lit(True)
    for part in parts:
        same = same & F.col(part).eqNullSafe(F.col(f"__{part}"))
    return known.join(touched, same, "left_semi")
