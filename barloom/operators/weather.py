"""Weather records from landed responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.scalars import record_id, record_time

# The declared fields of a weather record.
WEATHER_FIELDS = (
    {"name": "uuid", "mode": "REQUIRED", "type": "STRING"},
    {"name": "resp_ingested_timestamp", "mode": "NULLABLE", "type": "DATETIME"},
    {"name": "temp", "mode": "NULLABLE", "type": "FLOAT"},
    {"name": "feels_like", "mode": "NULLABLE", "type": "FLOAT"},
    {"name": "temp_min", "mode": "NULLABLE", "type": "FLOAT"},
    {"name": "temp_max", "mode": "NULLABLE", "type": "FLOAT"},
    {"name": "pressure", "mode": "NULLABLE", "type": "FLOAT"},
    {"name": "humidity", "mode": "NULLABLE", "type": "FLOAT"},
    {"name": "sea_level", "mode": "NULLABLE", "type": "FLOAT"},
    {"name": "grnd_level", "mode": "NULLABLE", "type": "FLOAT"},
)
MAIN_SCHEMA = ", ".join(f"{f['name']} double" for f in WEATHER_FIELDS[2:])
RESPONSE_SCHEMA = f"main struct<{MAIN_SCHEMA.replace(' double', ': double')}>"


def flatten_main(responses: DataFrame, ingested_at: Column | str | None = None) -> DataFrame:
    """The fields of ``main`` with a record id and the ingest time in front."""
    return responses.select(
        record_id().alias("uuid"),
        record_time(ingested_at).alias("resp_ingested_timestamp"),
        F.col("main.*"),
    )
