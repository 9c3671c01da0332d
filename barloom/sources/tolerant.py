"""CSV bulk load that goes on past bad rows and keeps them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.inference import typed_cell
from barloom.session import stage
from barloom.sources.records import read_records

#: Fixed value: width of a text column.
TEXT_WIDTH = 255

RECORD, REASON = "_record", "_reason"


def mark_tolerant_csv(
    spark: SparkSession, path: str, schema: T.StructType, text_width: int | None = TEXT_WIDTH, multi_line: bool = False
) -> DataFrame:
    """Rows by position under ``schema`` plus ``_record`` and ``_reason``; both NULL on a good row.

    A row is bad if it has the wrong number of fields, a cell that is no value of its type by the rule
    of the type inference, or text above ``text_width`` characters. Lazy: store it before reading only
    some of its columns, as the number of fields is only noticed where all are read.
    """
    lines = T.StructType([*(T.StructField(n, T.StringType()) for n in schema.names), T.StructField(RECORD, T.StringType())])
    if multi_line:
        read = read_records(spark, path, lines, header=True, corrupt=RECORD)
    else:
        options = dict(header=True, quote='"', escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord=RECORD)
        read = spark.read.schema(lines).options(**options).csv(path)
    typed = {f.name: typed_cell(f.name, f.dataType) for f in schema.fields}
    misfit = F.lit(False)
    for _, bad in typed.values():
        misfit = misfit | bad
    reason = F.when(F.col(RECORD).isNotNull() | misfit, F.lit("malformed"))
    for field in schema.fields:
        if text_width and isinstance(field.dataType, T.StringType):
            reason = reason.when(F.length(f"`{field.name}`") > text_width, F.lit(f"{field.name} longer than {text_width}"))
    line = F.to_csv(F.struct(*[f"`{n}`" for n in schema.names]), {"escape": '"'})
    return (
        read.withColumn(REASON, reason)
        .withColumn(RECORD, F.coalesce(RECORD, F.when(F.col(REASON).isNotNull(), line)))
        .withColumns({name: value for name, (value, _) in typed.items()})
    )


def parse_tolerant_csv(
    spark: SparkSession, path: str, schema: T.StructType, text_width: int | None = TEXT_WIDTH, multi_line: bool = False
) -> DataFrame:
    """``mark_tolerant_csv``, stored once: good rows and rejects are then two cheap scans."""
    return stage(mark_tolerant_csv(spark, path, schema, text_width, multi_line), "parsed")


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(REASON).isNull()).drop(RECORD, REASON)


def rejects(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(REASON).isNotNull()).select(RECORD, REASON)
