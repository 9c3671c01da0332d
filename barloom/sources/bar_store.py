"""Bars stored the way the windows read them: bucketed by series, sorted by time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Buckets of a new store. A bucket is one task of a window over the whole store.
BUCKETS = 512


def store_bars(
    bars: DataFrame, table: str, series: Sequence[str], order: Sequence[str], buckets: int = BUCKETS, spread: int = 1
) -> DataFrame:
    """Add ``bars`` to the table ``table``, bucketed by ``series`` and sorted by series and ``order`` in each
    file; returns the table. It is made if there is none; later calls must give the same layout.

    A window or an aggregate by ``series`` reads the table without a shuffle. The rows are dealt by series before
    they are written, so that a bucket gets one file a call and not one from every task. ``spread`` deals
    each series over so many tasks, and files, by its time: for a load in which one series is long.
    """
    series, order = list(series), list(order)
    keys = [F.col(c) for c in series]
    if spread > 1:
        # Whole hours or ranges of a text stay together: a file is a run of time, not a sample of it.
        keys.append(F.pmod(F.xxhash64(F.substring(F.col(order[0]).cast("string"), 1, 13)), F.lit(spread)))
    dealt = bars.repartition(max(buckets, buckets * spread), *keys)
    dealt.write.mode("append").bucketBy(buckets, *series).sortBy(*series, *order).saveAsTable(table)
    return bars.sparkSession.table(table)
