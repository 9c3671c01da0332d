"""Weather responses: flatten, land by hour, take the landing folder in incrementally."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.scalars import column
from barloom.operators.weather import WEATHER_FIELDS, flatten_main
from barloom.sources.files import struct_of, with_required
from barloom.sources.sinks import write_by_hour
from barloom.streaming.landing import land_increment


INGEST_DATE = "ingest_date"
#: The ingest time and all readings: everything but the random id.
NATURAL_KEY = tuple(field["name"] for field in WEATHER_FIELDS if field["name"] != "uuid")


def land_weather(responses: DataFrame, ingested_at: Column | str, landing: str) -> None:
    """Records into the folder of their own ingest hour; a re-run of an hour replaces that hour."""
    records = flatten_main(responses.withColumn("__at", column(ingested_at)), "__at")
    write_by_hour(records, landing, F.col("resp_ingested_timestamp").cast("timestamp_ntz"))


def load_weather(
    spark: SparkSession,
    landing: str,
    table_path: str,
    checkpoint: str,
    unique_by: Sequence[str] = NATURAL_KEY,
) -> int:
    """Append new records of the landing folder to the table folder; returns rows read.

    A record that a re-run landed again, under a new file name and id, is recognised by its
    natural key, by default its time and all its readings, and not appended twice. The table is stored by ingest date, so only the dates of
    the new files are compared.
    """
    schema = struct_of(WEATHER_FIELDS)

    def prepare(rows: DataFrame) -> DataFrame:
        checked = with_required(rows.select(*schema.names), WEATHER_FIELDS)
        return checked.withColumn(INGEST_DATE, column("resp_ingested_timestamp").cast("date"))

    return land_increment(
        spark, landing, schema, table_path, checkpoint,
        prepare=prepare, unique_by=unique_by, partition_by=[INGEST_DATE], mode="FAILFAST",
    )


def read_weather(spark: SparkSession, table_path: str) -> DataFrame:
    """The loaded records, with the ingest date to filter on."""
    schema = struct_of(WEATHER_FIELDS).add(INGEST_DATE, "date")
    return spark.read.schema(schema).parquet(table_path)
