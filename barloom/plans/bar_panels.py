"""Bar panels of a domestic universe and of foreign symbol lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from barloom.functions.scalars import hour_floor
from barloom.operators import bars as ops
from barloom.sources.sinks import write_dual


def _panel(
    universe: DataFrame, ticks: DataFrame, symbol: str, ts: str, price: str, volume, tiebreak: str | None, start, end
) -> DataFrame:
    """Bars of listed symbols in the range; the range and the list cut the ticks before any shuffle."""
    ticks = ops.ticks_in_range(ticks.withColumnRenamed(symbol, "symbol"), ts, start, end)
    cells = [c for c in (price, volume) if isinstance(c, str) and isinstance(ticks.schema[c].dataType, T.StringType)]
    ticks = ops.unwrap_prices(ticks, cells) if cells else ticks
    ticks = ops.listed_only(ticks, universe)
    return ops.in_range(ops.hourly_bars(ticks, "symbol", ts, price, volume, tiebreak), "hour", start, end)


def _seen(universe: DataFrame, ticks: DataFrame, symbol: str, ts: str, start, end) -> DataFrame:
    """Ticks of listed symbols whose bar is in the range: the hour decides, as in the panel."""
    ticks = ops.ticks_in_range(ticks.withColumnRenamed(symbol, "symbol"), ts, start, end)
    return ops.listed_only(ops.in_range(ticks.withColumn("hour", hour_floor(ts)), "hour", start, end), universe)


def domestic_bars(
    universe: DataFrame,
    ticks: DataFrame,
    start: str,
    end: str | Column,
    symbol: str = "symbol",
    ts: str = "ts",
    price: str = "price",
    volume: Column | str | None = "volume",
    tiebreak: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Hourly bars of a ``(symbol, fullname)`` universe from ticks, and the symbols without any."""
    panel = _panel(universe, ticks, symbol, ts, price, volume, tiebreak, start, end)
    bars = ops.as_layout(
        ops.universe_bars(universe, panel),
        {"symbol": "Ticker", "fullname": "Fullname", "hour": "Datetime"},
        ops.DOMESTIC_COLUMNS,
    )
    return bars, ops.missing_symbols(universe, _seen(universe, ticks, symbol, ts, start, end))


def foreign_bars(
    lists: Sequence[DataFrame],
    ticks: DataFrame,
    names: DataFrame,
    start: str,
    end: str | Column,
    symbol: str = "symbol",
    ts: str = "ts",
    price: str = "price",
    volume: Column | str | None = "volume",
    tiebreak: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Hourly bars of all symbols on any of the lists, full names looked up, and the symbols without any."""
    universe = ops.distinct_symbols(lists).withColumnRenamed("Symbol", "symbol")
    panel = _panel(universe, ticks, symbol, ts, price, volume, tiebreak, start, end)
    bars = ops.as_layout(
        ops.with_fullname(panel, names),
        {"symbol": "Name", "fullname": "Fullname", "hour": "Date"},
        ops.FOREIGN_COLUMNS,
    )
    return bars, ops.missing_symbols(universe, _seen(universe, ticks, symbol, ts, start, end))


def store_panel(bars: DataFrame, parquet_path: str, csv_path: str) -> None:
    write_dual(bars, parquet_path, csv_path)
