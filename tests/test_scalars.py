import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom.functions import scalars as fx


def one(spark, expr, row=None, schema="x string"):
    df = spark.createDataFrame([row if row is not None else ("",)], schema)
    return df.select(expr).first()[0]


@pytest.mark.parametrize("cell, want", [("[1.5,2.0]", 1.5), ("3.0", 3.0), ("[]", None), (None, None), ("text", None)])
def test_list_or_scalar_cell(spark, cell, want):
    assert one(spark, fx.first_number("x"), (cell,)) == want


def test_first_element(spark):
    for cell, want in (([1.5, 2.0], 1.5), ([], None), (None, None)):
        assert one(spark, fx.first_element("x"), (cell,), "x array<double>") == want


def test_json_int_default(spark):
    assert one(spark, fx.json_int("x", "$.a.b"), ('{"a": {"b": "71000"}}',)) == 71000
    assert one(spark, fx.json_int("x", "$.a.b"), ('{"a": {}}',)) == 0
    assert one(spark, fx.json_int("x", "$.a.b"), ('{"a": {"b": null}}',)) == 0
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, fx.json_int("x", "$.a.b"), ('{"a": {"b": ""}}',))


def test_name_default(spark):
    assert one(spark, fx.name_or_default("x"), (None,)) == "N/A"
    assert one(spark, fx.name_or_default("x"), ("Apple",)) == "Apple"


def test_time_formats(spark):
    at = dt.datetime(2024, 11, 5, 7, 8, 9, 123456)
    row = (at,)
    schema = "x timestamp_ntz"
    assert one(spark, fx.record_time("x"), row, schema) == "2024-11-05 07:08:09"
    assert one(spark, fx.snapshot_time("x"), row, schema) == "20241105_070809"
    assert one(spark, fx.iso_time("x"), row, schema) == at.isoformat()
    parts = spark.createDataFrame([row], schema).select(*fx.hour_parts("x")).first()
    assert tuple(parts) == ("2024", "11", "05", "07")
    assert one(spark, fx.hour_floor("x"), row, schema) == dt.datetime(2024, 11, 5, 7)


def test_zoneless_functions_ignore_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        gap = dt.datetime(2024, 3, 10, 2, 30)
        assert one(spark, fx.hour_floor("x"), (gap,), "x timestamp_ntz") == dt.datetime(2024, 3, 10, 2)
        assert one(spark, fx.epoch_millis_to_utc("x"), (1730764800123,), "x bigint") == dt.datetime(2024, 11, 5, 0, 0, 0, 123000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_exclusive_end(spark):
    assert one(spark, fx.exclusive_end("2024-12-31")) == "2025-01-01"
    assert one(spark, fx.exclusive_end(dt.date(2024, 2, 28))) == "2024-02-29"
    assert len(one(spark, fx.exclusive_end())) == 10


def test_quote_line(spark):
    row = ("삼성전자", "005930", 71000)
    assert one(spark, fx.quote_line("n", "c", "p"), row, "n string, c string, p bigint") == "삼성전자 (005930): 71000 KRW\n"


def test_record_ids_differ(spark):
    ids = [r[0] for r in spark.range(50).select(fx.record_id()).collect()]
    assert len(set(ids)) == 50


def test_pct_change_modes(spark):
    assert spark.range(1).select(fx.pct_change(F.lit(4.0), F.lit(5.0))).first()[0] == 25.0
    with pytest.raises(ValueError):
        fx.pct_change("a", "b", "maybe")


def test_texts_of_zoneless_times_know_no_zone(spark):
    """New York skips 02:30 in March and has 01:30 twice in November."""
    kept = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for at in (dt.datetime(2024, 3, 10, 2, 30, 5, 7), dt.datetime(2024, 11, 3, 1, 30), dt.datetime(2024, 11, 3, 1, 59, 59, 999999)):
            df = spark.createDataFrame([(at,)], "x timestamp_ntz")
            row = df.select(fx.record_time("x"), fx.snapshot_time("x"), fx.iso_time("x"), *fx.hour_parts("x"), fx.local_micros("x")).first()
            assert tuple(row[:3]) == (f"{at:%Y-%m-%d %H:%M:%S}", f"{at:%Y%m%d_%H%M%S}", f"{at:%Y-%m-%dT%H:%M:%S.%f}")
            assert tuple(row[3:7]) == (f"{at:%Y}", f"{at:%m}", f"{at:%d}", f"{at:%H}")
            assert row[7] == (at - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", kept)
    assert tuple(spark.createDataFrame([(None,)], "x timestamp_ntz").select(fx.iso_time("x"), *fx.hour_parts("x")).first()) == (None,) * 5


def test_texts_of_a_date_are_those_of_its_midnight(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 1),)], "x date")
    row = df.select(fx.record_time("x"), fx.snapshot_time("x"), fx.iso_time("x")).first()
    assert tuple(row) == ("2024-03-01 00:00:00", "20240301_000000", "2024-03-01T00:00:00.000000")
