"""The model chain: raw source, inlined staging model, stored output model, and its test."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from barloom.operators.quality import not_null_report, require_pass
from barloom.plans.change_conditions import change_conditions
from barloom.sources.tables import SOURCES, materialise, source

# Name of the output model and the column its not-null test covers.
OUTPUT_MODEL = "foreign_stock_change_rate_conditions"
TESTED_COLUMN = "METRIC"


def staging_bars(raw: DataFrame) -> DataFrame:
    """The four columns the output model reads."""
    return raw.select("NAME", "FULLNAME", "DATE", "Close")


def run_models(
    spark: SparkSession,
    database: str | None = None,
    tables: Mapping[tuple[str, str], str] = SOURCES,
    **options: object,
) -> DataFrame:
    """Build the output table from the raw bars; ``options`` go to ``change_conditions``."""
    staged = materialise(staging_bars(source(spark, "raw", "fs_st_if_cpl", tables)), "staging_bars", "ephemeral")
    result = change_conditions(staged, series=("NAME", "FULLNAME"), order="DATE", **options)
    return materialise(result, _qualified(database), "table")


def test_models(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Run the declared tests; raises if one fails, otherwise returns the report."""
    report = not_null_report(spark.table(_qualified(database)), OUTPUT_MODEL, [TESTED_COLUMN])
    require_pass(report)
    return report


test_models.__test__ = False  # not a pytest case


def _qualified(database: str | None) -> str:
    return f"{database}.{OUTPUT_MODEL}" if database else OUTPUT_MODEL
