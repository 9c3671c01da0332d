"""How prices move after a sharp change: mean and median forward returns per change band."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators import quantiles
from barloom.operators.bands import BANDS, means, sharp_moves, to_long, to_matrix
from barloom.operators.windows import HORIZONS, SERIES, SLICE_ROWS, forward_returns
from barloom.session import stage


def change_conditions(
    bars: DataFrame,
    series: Sequence[str] = SERIES,
    order: str = "Date",
    close: str = "Close",
    tiebreak: str | None = None,
    horizons: Mapping[str, int] = HORIZONS,
    zero_div: str = "error",
    exact: bool = True,
    slice_rows: int | None = SLICE_ROWS,
    in_memory_rows: int = quantiles.IN_MEMORY_ROWS,
) -> DataFrame:
    """Metric by band matrix: one row per (horizon, mean or median), one column per band.

    The bars are shuffled and sorted once. Up to ``in_memory_rows`` bars (a footer count for stored
    bars) the rest is one lazy plan. Beyond that, with ``exact``, the qualifying moves, a narrow and
    small share of the bars, are stored and both statistics run over the stored rows;
    ``exact=False`` takes sketched medians instead, without storing anything.
    """
    returns = list(horizons)
    bars = bars.select(*series, order, close, *([tiebreak] if tiebreak else []))
    small = bars.count() <= min(in_memory_rows, slice_rows or in_memory_rows)
    scored = forward_returns(
        bars, series, order, close, tiebreak, horizons, zero_div, None if small else slice_rows
    )
    moves = sharp_moves(scored).select("condition", *returns)
    if exact and not small:
        moves = stage(moves, "moves")
        return condition_matrix(moves, returns, in_memory_rows=in_memory_rows)
    return condition_matrix(moves, returns, exact, None)


def condition_matrix(
    moves: DataFrame, returns: Sequence[str], exact: bool = True, in_memory_rows: int | None = quantiles.IN_MEMORY_ROWS
) -> DataFrame:
    """The matrix of banded moves. ``in_memory_rows=None``: the caller vouches that they are few."""
    metrics = [f"{r}_mean" for r in returns] + [f"{r}_median" for r in returns]
    by = ["condition"]
    if not exact or in_memory_rows is None or moves.count() <= in_memory_rows:
        middle = F.percentile if exact else F.percentile_approx
        per_band = moves.groupBy(*by).agg(
            *[F.avg(r).alias(f"{r}_mean") for r in returns],
            *[middle(r, 0.5).alias(f"{r}_median") for r in returns],
        )
    else:
        per_band = means(moves, returns, by).join(quantiles.percentiles_spread(moves, by, returns), "condition")
    return to_matrix(to_long(per_band, by, metrics, "METRIC", "value"), "METRIC", "condition", BANDS, "value")
