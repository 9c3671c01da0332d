"""Change bands: filter sharp moves, band them, aggregate per band, lay out the matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.scalars import column

# Band labels in column order, and the label of everything between the bands.
BANDS = ("Change > 10", "Change > 5", "Change <= -10", "Change <= -5")
OTHER_BAND = "Other"


def is_sharp(change: Column | str = "change") -> Column:
    """More than 5 percent up, or 5 percent or more down. NULL changes do not qualify."""
    change = column(change)
    return (change > 5) | (change <= -5)


def band_of(change: Column | str = "change") -> Column:
    change = column(change)
    up_much, up, down_much, down = BANDS
    return (
        F.when(change > 10, up_much)
        .when(change > 5, up)
        .when(change <= -10, down_much)
        .when(change <= -5, down)
        .otherwise(OTHER_BAND)
    )


def sharp_moves(scored: DataFrame, change: str = "change", band: str = "condition") -> DataFrame:
    """The qualifying rows with their band."""
    return scored.filter(is_sharp(change)).withColumn(band, band_of(change))


def band_counts(scored: DataFrame, change: str = "change", band: str = "condition") -> DataFrame:
    return scored.filter(is_sharp(change)).groupBy(band_of(change).alias(band)).agg(F.count(F.lit(1)).alias("n"))


def means(moves: DataFrame, values: Sequence[str], by: Sequence[str] = ("condition",)) -> DataFrame:
    return moves.groupBy(*by).agg(*[F.avg(v).alias(f"{v}_mean") for v in values])


def to_long(wide: DataFrame, keep: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    """One row per value column in a single pass; NULL cells stay as rows."""
    return wide.unpivot(list(keep), list(values), name, value)


def to_matrix(long: DataFrame, rows: str, columns: str, labels: Sequence[str], value: str) -> DataFrame:
    """One row per ``rows`` value and one column per label; a missing cell is NULL.

    The labels are given, so no extra pass looks for them; empty input gives no rows.
    """
    return long.groupBy(rows).pivot(columns, list(labels)).agg(F.max(value))
