"""Hourly bars kept up to date by landing run, instead of being built again from all ticks.

A run folds its new ticks to bar states, a row for each symbol and hour with what merging needs: the moments of the
first and the last price. States are kept by day and run; the bars of a day are the merged states of all its runs.
Only days that a run touches are merged again, from states and never from ticks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.bars import bar_states, bars_of_states

DAY, RUN = "day", "run"


def update_hourly_bars(
    spark: SparkSession,
    source: str,
    schema: T.StructType | str,
    store: str,
    checkpoint: str,
    symbol: str,
    ts: str,
    price: str,
    volume: Column | str | None = None,
    tiebreak: str | None = None,
    source_format: str = "json",
    files_per_batch: int | None = None,
    **reader_options: object,
) -> None:
    """Take the not yet seen files of ``source`` into the bars under ``store``; ticks may come late and in any order.

    The checkpoint remembers the files. A run that breaks is done again under its own number, and both its states and
    the touched days are replaced, not added to: no tick counts twice. One checkpoint belongs to one store.
    """
    reader = spark.readStream.schema(schema).format(source_format).options(**reader_options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    ticks = reader.load(source)

    def take(batch: DataFrame, run: int) -> None:
        merge_states(bar_states(batch, symbol, ts, price, volume, tiebreak), store, run)

    query = ticks.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(take).start()
    query.awaitTermination()


def merge_states(states: DataFrame, store: str, run: int) -> None:
    """Keep the states of run ``run`` and bring the bars of the days they touch up to date."""
    spark = states.sparkSession
    new = states.withColumns({DAY: F.to_date("hour"), RUN: F.lit(run).cast("long")})
    _replace(new, f"{store}/states", [DAY, RUN])
    kept = spark.read.schema(_with(states.schema, (DAY, T.DateType()), (RUN, T.LongType()))).parquet(f"{store}/states")
    # Days that the run touches, from the folders' names: no more than the calendar has, so the scan gets a list.
    touched = [r[DAY] for r in kept.filter(F.col(RUN) == run).select(DAY).distinct().collect()]
    if touched:
        wanted = F.col(DAY).isin([d for d in touched if d is not None]) | F.lit(None in touched) & F.col(DAY).isNull()
        _replace(bars_of_states(kept.filter(wanted), [DAY]), f"{store}/bars", [DAY])


def read_hourly_bars(spark: SparkSession, store: str) -> DataFrame:
    """The bars under ``store``, in the columns of ``hourly_bars``; no run has been taken: no rows are there to read."""
    return spark.read.parquet(f"{store}/bars").drop(DAY)


def _replace(df: DataFrame, path: str, folders: list[str]) -> None:
    """Replace the partitions that ``df`` has rows for. A heavy day is written by as many tasks as it needs."""
    writer = df.hint("rebalance", *folders).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*folders).parquet(path)


def _with(schema: T.StructType, *more: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([*schema.fields, *(T.StructField(n, t) for n, t in more)])
