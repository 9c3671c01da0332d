"""Full refresh of a table from CSV: infer, load tolerantly, gate, publish."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from barloom.operators.inference import infer_types, inferred_struct
from barloom.operators.quality import GateFailed
from barloom.sources.files import read_text_csv
from barloom.sources.tables import publish_split
from barloom.sources.tolerant import REASON, RECORD, mark_tolerant_csv

#: Columns that hold symbols and names, in any case: text, so ``005930`` keeps its zeros.
TEXT_COLUMNS = ("Ticker", "Symbol", "Name", "Fullname", "Code")


def refresh_table(
    spark: SparkSession,
    csv_path: str,
    table: str,
    schema: T.StructType | None = None,
    gates: Sequence[Callable[[DataFrame], None]] = (),
    multi_line: bool = False,
    text_columns: Sequence[str] = TEXT_COLUMNS,
    max_reject_share: float | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Replace ``table`` by the good rows of the CSV; returns it and the ``<table>_rejects`` table.

    Without a ``schema`` the types are inferred, but ``text_columns`` are text. Rows of which none is
    good, or more than ``max_reject_share`` are not, are refused. A refusal leaves both tables as they
    were. The parsed rows, good and bad, are written once, and both tables are views of them.
    """
    loaded, rejected, _ = refresh_counted(spark, csv_path, table, schema, gates, multi_line, text_columns, max_reject_share)
    return loaded, rejected


def refresh_counted(
    spark: SparkSession,
    csv_path: str,
    table: str,
    schema: T.StructType | None = None,
    gates: Sequence[Callable[[DataFrame], None]] = (),
    multi_line: bool = False,
    text_columns: Sequence[str] = TEXT_COLUMNS,
    max_reject_share: float | None = None,
) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """``refresh_table``, and what its one write counted: ``rows``, ``rejects`` and the failures of the gates."""
    if schema is None:
        schema = inferred_struct(infer_types(read_text_csv(spark, csv_path, multi_line)), text_columns)

    def accept(counts: Mapping[str, int]) -> None:
        total, bad = counts["rows"], counts["rejects"]
        if bad and (bad == total or max_reject_share is not None and bad > max_reject_share * total):
            raise GateFailed(f"{bad} of {total} rows of {csv_path} are rejects")

    parsed = mark_tolerant_csv(spark, csv_path, schema, multi_line=multi_line)
    return publish_split(parsed, table, f"{table}_rejects", [RECORD, REASON], gates, accept)
