"""Data-quality tests and gates. Every check is a mergeable count in one pass."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class GateFailed(Exception):
    """A data-quality test did not pass."""


def not_null_report(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """``(model, column, test, failures)``, one row per tested column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    lines = [
        F.struct(
            F.lit(model).alias("model"), F.lit(c).alias("column"),
            F.lit("not_null").alias("test"), F.col(f"n{i}").alias("failures"),
        )
        for i, c in enumerate(columns)
    ]
    return counts.select(F.inline(F.array(*lines)))


def require_pass(report: DataFrame) -> None:
    """Raise if a report has failures; reads only failing lines, at most one per tested column."""
    failed = report.filter(F.col("failures") > 0).collect()
    if failed:
        raise GateFailed("; ".join(f"{r.model}.{r.column} {r.test}: {r.failures}" for r in failed))


class NotNullGate:
    """A gate whose counts a write can take on its way; called with stored rows it counts them itself."""

    def __init__(self, columns: Sequence[str], model: str = "rows"):
        self.columns, self.model = list(columns), model

    def __call__(self, df: DataFrame) -> None:
        require_pass(not_null_report(df, self.model, self.columns))

    def metrics(self, among: Column | None = None) -> dict[str, Column]:
        """A name and an aggregate for each tested column, over the rows ``among``."""
        counted = F.lit(True) if among is None else among
        return {f"{self.model}.{c} not_null": F.count_if(F.col(f"`{c}`").isNull() & counted) for c in self.columns}

    def check(self, counts: Mapping[str, int]) -> None:
        """Raise if the observed counts have failures."""
        failed = [f"{name}: {counts[name]}" for name in self.metrics() if counts[name]]
        if failed:
            raise GateFailed("; ".join(failed))


def not_null_gate(columns: Sequence[str], model: str = "rows") -> NotNullGate:
    return NotNullGate(columns, model)


def counted_write(df: DataFrame, metrics: Mapping[str, Column], write: Callable[[DataFrame], None]) -> dict[str, int]:
    """``write(df)`` and the ``metrics`` of the rows it wrote, taken by the same job. ``df`` must reach the
    write without a shuffle behind it, so that a task that runs again is not counted twice."""
    if not metrics:
        write(df)
        return {}
    seen = Observation()
    columns = {f"m{i}": name for i, name in enumerate(metrics)}
    write(df.observe(seen, *[metrics[name].alias(m) for m, name in columns.items()]))
    return {name: seen.get[m] for m, name in columns.items()}


def complete(columns: Sequence[str]) -> Column:
    condition = F.lit(True)
    for name in columns:
        condition = condition & F.col(name).isNotNull()
    return condition


def split_required(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all required values, and the others."""
    return df.filter(complete(columns)), df.filter(~complete(columns))
