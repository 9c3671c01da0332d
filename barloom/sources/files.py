"""File readers and the generic file-to-table loader."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.sources.records import read_records
from barloom.sources.tables import append, publish

UNIVERSE_SCHEMA = "symbol string, fullname string"

# Source format names of the loader with their Spark names, and write dispositions.
SOURCE_FORMATS = {"CSV": "csv", "NEWLINE_DELIMITED_JSON": "json", "AVRO": "avro", "PARQUET": "parquet"}
WRITE_MODES = {"WRITE_APPEND": append, "WRITE_TRUNCATE": publish}

# Declared field types.
FIELD_TYPES = {
    "STRING": T.StringType(),
    "DATETIME": T.TimestampNTZType(),
    "TIMESTAMP": T.TimestampType(),
    "FLOAT": T.DoubleType(),
    "INTEGER": T.LongType(),
    "BOOLEAN": T.BooleanType(),
}


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_universe(spark: SparkSession, path: str) -> DataFrame:
    """Symbol universe; symbols are text, so ``005930`` keeps its zeros."""
    return scan_parquet(spark, path, UNIVERSE_SCHEMA)


def read_text_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """CSV with a header, every column as text. ``multi_line`` allows line breaks in quotes; the records are
    then cut out in parallel and stored first."""
    if multi_line:
        return read_records(spark, path, header=True)
    return spark.read.options(header=True, quote='"', escape='"').csv(path)


def read_indexed_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header whose first column is a row index, not data."""
    df = read_text_csv(spark, path)
    return df.drop(df.columns[0])


def read_json_arrays(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Files that each hold one JSON array: one row per element."""
    return spark.read.schema(schema).options(multiLine=True, mode="FAILFAST").json(path)


def struct_of(fields: Sequence[Mapping[str, str]]) -> T.StructType:
    """Spark schema of ``{name, mode, type}`` field declarations."""
    return T.StructType(
        [T.StructField(f["name"], FIELD_TYPES[f["type"].upper()], f.get("mode") != "REQUIRED") for f in fields]
    )


def required_names(fields: Sequence[Mapping[str, str]]) -> list[str]:
    return [f["name"] for f in fields if f.get("mode") == "REQUIRED"]


def with_required(df: DataFrame, fields: Sequence[Mapping[str, str]]) -> DataFrame:
    """Fail the job that reads a NULL in a REQUIRED field; no pass of its own."""
    for name in required_names(fields):
        missing = F.raise_error(F.lit(f"REQUIRED field {name} is NULL")).cast(df.schema[name].dataType)
        df = df.withColumn(name, F.coalesce(F.col(name), missing))
    return df


def read_files(
    spark: SparkSession,
    source: str | Sequence[str],
    fields: Sequence[Mapping[str, str]] | None = None,
    source_format: str = "CSV",
    quoted_newlines: bool = False,
    header: bool = False,
    strict_fields: bool = False,
    range_bytes: int | None = None,
) -> DataFrame:
    """Files of one of ``SOURCE_FORMATS`` (a path, a glob or several), failing on malformed records.

    ``strict_fields`` also fails on JSON records that carry undeclared fields. ``quoted_newlines``
    allows line breaks inside quoted CSV values: the records are cut out of ranges of the files and stored when this is
    called. Else the frame is lazy. Columns that an action does not read are not checked by it. ``load_files``
    writes all columns.
    """
    if source_format not in SOURCE_FORMATS:
        raise ValueError(f"no Spark reader for {source_format}")
    fmt = SOURCE_FORMATS[source_format]
    schema = struct_of(fields) if fields else None
    if fmt == "json" and strict_fields:
        if schema is None:
            raise ValueError("strict_fields needs declared fields")
        df = _strict_json(spark.read.text(source), schema)
    elif fmt == "csv" and quoted_newlines:
        df = read_records(spark, source, schema, header, "FAILFAST", range_bytes=range_bytes)
    else:
        reader = spark.read.format(fmt)
        if schema is not None:
            reader = reader.schema(schema)
        if fmt in ("csv", "json"):
            reader = reader.option("mode", "FAILFAST")
        if fmt == "csv":
            reader = reader.options(header=header, quote='"', escape='"')
        df = reader.load(source)
    return with_required(df, fields) if fields else df


def _strict_json(lines: DataFrame, schema: T.StructType) -> DataFrame:
    body = F.col("value")
    names = F.array(*[F.lit(n) for n in schema.names])
    extra = F.array_except(F.json_object_keys(body), names)
    checked = F.when(F.size(extra) > 0, F.raise_error(F.concat(F.lit("undeclared fields: "), F.array_join(extra, ", ")))).otherwise(body)
    return lines.filter(F.length(F.trim(body)) > 0).select(
        F.from_json(checked, schema, {"mode": "FAILFAST"}).alias("r")
    ).select("r.*")


def load_files(
    spark: SparkSession,
    source: str | Sequence[str],
    table: str,
    fields: Sequence[Mapping[str, str]] | None = None,
    source_format: str = "CSV",
    write_disposition: str = "WRITE_APPEND",
    quoted_newlines: bool = False,
    header: bool = False,
    strict_fields: bool = False,
    range_bytes: int | None = None,
) -> DataFrame:
    """Load files into a table and return the table: in one pass, CSV with ``quoted_newlines`` in two more.

    A malformed record or a NULL in a REQUIRED field fails the job before anything is committed.
    WRITE_TRUNCATE publishes a new version, so a failed load leaves the old rows; WRITE_APPEND adds
    to a plain table or to a published table's current version.
    """
    if write_disposition not in WRITE_MODES:
        raise ValueError(f"unknown write disposition {write_disposition}")
    df = read_files(spark, source, fields, source_format, quoted_newlines, header, strict_fields, range_bytes)
    return WRITE_MODES[write_disposition](df, table)


def to_records(df: DataFrame, name: str = "record") -> DataFrame:
    """Each row as one JSON object text; NULL fields are written out."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(name))


def from_records(records: DataFrame, schema: T.StructType | str, name: str | Column = "record") -> DataFrame:
    return records.select(F.from_json(name, schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
