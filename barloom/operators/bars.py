"""Bar panels: build hourly bars from ticks, restrict, join to universes and names."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.scalars import column, first_number, hour_floor, local_micros, name_or_default

# Column order of the two bar layouts, and the price columns.
DOMESTIC_COLUMNS = ("Ticker", "Fullname", "Datetime", "Close", "High", "Low", "Open", "Volume")
FOREIGN_COLUMNS = ("Name", "Fullname", "Date", "Close", "High", "Low", "Open", "Volume")
PRICE_COLUMNS = ("Close", "High", "Low", "Open", "Volume")


def hourly_bars(
    ticks: DataFrame, symbol: str, ts: str, price: str, volume: Column | str | None = None, tiebreak: str | None = None
) -> DataFrame:
    """``(symbol, hour, Open, High, Low, Close, Volume)`` per symbol and hour.

    Every aggregate is combined before the shuffle, so an hour that holds a large share of all
    ticks sends one row per task. First and last follow (ts, tiebreak).
    """
    at = _moment(ticks, ts, tiebreak) if tiebreak else F.col(ts)
    size = F.count(F.lit(1)) if volume is None else F.sum(column(volume))
    return ticks.groupBy(F.col(symbol).alias("symbol"), hour_floor(ts).alias("hour")).agg(
        F.min_by(price, at).alias("Open"),
        F.max(price).alias("High"),
        F.min(price).alias("Low"),
        F.max_by(price, at).alias("Close"),
        size.cast("bigint").alias("Volume"),
    )


def bar_states(
    ticks: DataFrame, symbol: str, ts: str, price: str, volume: Column | str | None = None, tiebreak: str | None = None
) -> DataFrame:
    """Hourly bars of some of the ticks, with the moments of their first and last price: states that merge.

    ``(symbol, hour, first_at, Open, High, Low, last_at, Close, Volume)``.
    """
    at = _moment(ticks, ts, tiebreak) if tiebreak else F.col(ts)
    size = F.count(F.lit(1)) if volume is None else F.sum(column(volume))
    return ticks.groupBy(F.col(symbol).alias("symbol"), hour_floor(ts).alias("hour")).agg(
        F.min(at).alias("first_at"),
        F.min_by(price, at).alias("Open"),
        F.max(price).alias("High"),
        F.min(price).alias("Low"),
        F.max(at).alias("last_at"),
        F.max_by(price, at).alias("Close"),
        size.cast("bigint").alias("Volume"),
    )


def bars_of_states(states: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """The bars of all ticks whose ``bar_states`` are given, in any number of parts. ``more``: columns of
    the states that go with the hour and are kept."""
    return states.groupBy("symbol", "hour", *more).agg(
        F.min_by("Open", "first_at").alias("Open"),
        F.max("High").alias("High"),
        F.min("Low").alias("Low"),
        F.max_by("Close", "last_at").alias("Close"),
        F.sum("Volume").alias("Volume"),
    )


def _moment(ticks: DataFrame, ts: str, tiebreak: str) -> Column:
    """(ts, tiebreak) as one value to order by. A whole-number tiebreak is packed with a zone-less time
    into a decimal, which hash aggregation can hold; a struct would sort all ticks first. NULLs are least."""
    kinds = ticks.schema[ts].dataType, ticks.schema[tiebreak].dataType
    if not (isinstance(kinds[0], T.TimestampNTZType) and isinstance(kinds[1], T.IntegralType)):
        return F.struct(ts, tiebreak)
    whole = "decimal(38,0)"
    time = F.coalesce(local_micros(ts), F.lit(-(1 << 58))).cast("decimal(18,0)")
    # Decimal text, as a literal of this size is no bigint: 2^64 + 1 places a moment, NULL takes the first.
    place = F.coalesce(F.col(tiebreak).cast("decimal(20,0)") + F.lit("9223372036854775809").cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return (time * F.lit("18446744073709551617").cast("decimal(20,0)") + place).cast(whole)


def in_range(df: DataFrame, ts: str, start: dt.datetime | str, end: dt.datetime | str | Column) -> DataFrame:
    """Rows with ``start <= ts < end``; on stored bars the scan itself applies it."""
    kind = df.schema[ts].dataType
    upper = end if isinstance(end, Column) else F.lit(str(end))
    return df.filter((F.col(ts) >= F.lit(str(start)).cast(kind)) & (F.col(ts) < upper.cast(kind)))


def ticks_in_range(ticks: DataFrame, ts: str, start: dt.datetime | str, end: dt.datetime | str | Column) -> DataFrame:
    """Ticks that can fall into a bar of the range: an outer bound that the tick scan can apply."""
    kind = ticks.schema[ts].dataType
    upper = (end if isinstance(end, Column) else F.lit(str(end))).cast(kind) + F.make_dt_interval(F.lit(0), F.lit(1))
    return ticks.filter((F.col(ts) >= F.lit(str(start)).cast(kind)) & (F.col(ts) < upper))


def distinct_symbols(lists: Sequence[DataFrame], symbol: str = "Symbol") -> DataFrame:
    """Each symbol of any list once; a NULL counts as one symbol."""
    return reduce(DataFrame.union, [one.select(symbol) for one in lists]).distinct()


def concat_bars(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames by column name; a column some lack is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def universe_bars(universe: DataFrame, bars: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Bars of the universe's symbols with its columns.

    No broadcast is forced: Spark broadcasts a universe it measures as small and otherwise splits
    oversized bar partitions of a sort-merge join.
    """
    return bars.join(universe, symbol, "inner")


def missing_symbols(universe: DataFrame, bars: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Rows of the universe whose symbol has no bar.

    The bars shrink to their distinct symbols before the join, combined on the map side.
    """
    return universe.join(bars.select(symbol).distinct(), symbol, "left_anti")


def listed_only(ticks: DataFrame, universe: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Ticks of listed symbols, so that nothing else reaches a shuffle."""
    return ticks.join(universe.select(symbol).distinct(), symbol, "left_semi")


def with_fullname(bars: DataFrame, names: DataFrame, symbol: str = "symbol", fullname: str = "fullname") -> DataFrame:
    """Every bar with its symbol's full name, or the default where there is none."""
    return bars.join(names.select(symbol, fullname), symbol, "left").withColumn(fullname, name_or_default(fullname))


def unwrap_prices(bars: DataFrame, columns: Sequence[str] = PRICE_COLUMNS) -> DataFrame:
    """Numbers from text cells that hold a scalar or a one-element list."""
    return bars.withColumns({c: first_number(c) for c in columns})


def as_layout(bars: DataFrame, renames: Mapping[str, str], columns: Sequence[str]) -> DataFrame:
    """Rename, then the columns in their fixed order."""
    return bars.withColumnsRenamed(dict(renames)).select(*columns)


def run_report(bars: DataFrame, symbol: str) -> DataFrame:
    """Number of symbols and of rows.

    The rows are counted per symbol first, so the distinct count needs no exchange of all rows.
    """
    per_symbol = bars.groupBy(symbol).agg(F.count(F.lit(1)).alias("n"))
    return per_symbol.agg(F.count(symbol).alias("symbols"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
