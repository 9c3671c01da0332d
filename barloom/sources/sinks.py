"""File sinks. Each row is written by whichever task has it, after a balancing shuffle where
partition folders would otherwise get a file from every task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from barloom.functions.scalars import column, hour_parts, snapshot_time

HOUR_PARTS = ("year", "month", "day", "hour")


def write_dual(df: DataFrame, parquet_path: str, csv_path: str) -> None:
    """Replace a Parquet and a CSV copy of the same rows.

    The CSV is written from the stored Parquet, so ``df`` is computed once, nothing is cached, and
    both copies agree even for expressions that change from run to run.
    """
    df.write.mode("overwrite").parquet(parquet_path)
    stored = df.sparkSession.read.schema(df.schema).parquet(parquet_path)
    stored.write.mode("overwrite").options(header=True, quote='"', escape='"').csv(csv_path)


def write_snapshot(df: DataFrame, path: str, taken_at: Column | str | None = None) -> None:
    """Add the rows as JSON under a ``run_ts=YYYYmmdd_HHMMSS`` folder; earlier runs stay untouched."""
    write_stamped(df.withColumn("run_ts", snapshot_time(taken_at)), path)


def write_stamped(df: DataFrame, path: str) -> None:
    """Add the rows as JSON under the folder of their ``run_ts``."""
    df.hint("rebalance", "run_ts").write.mode("append").partitionBy("run_ts").json(path)


def write_by_hour(df: DataFrame, path: str, ts: Column | str) -> None:
    """Land rows as JSON in year/month/day/hour folders, replacing only the hours present.

    The rebalance hint gives each hour as many files as its size needs, so one heavy hour is split
    over tasks and light hours do not shatter into small files.
    """
    parted = df.withColumns(dict(zip(HOUR_PARTS, hour_parts(column(ts)))))
    (
        parted.hint("rebalance", *HOUR_PARTS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*HOUR_PARTS)
        .json(path)
    )


def hour_landing_schema(schema: str) -> str:
    """``schema`` with the hour folders as text; otherwise Spark reads ``05`` back as 5."""
    return ", ".join([schema, *[f"{part} string" for part in HOUR_PARTS]])
