"""Scalar column expressions. All of them stay in generated JVM code."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text that stands for an unknown full name.
UNKNOWN_NAME = "N/A"


def column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def pct_change(base: Column | str, new: Column | str, zero_div: str = "error") -> Column:
    """Percent change from ``base`` to ``new``.

    A zero ``base`` fails the query under ANSI mode; ``zero_div="null"`` yields NULL instead.
    """
    base, new = column(base), column(new)
    if zero_div == "error":
        return (new - base) / base * 100
    if zero_div == "null":
        return F.try_divide(new - base, base) * 100
    raise ValueError("zero_div must be 'error' or 'null'")


def first_element(cell: Column | str) -> Column:
    """First element of an array column; NULL for an empty or NULL array."""
    return F.get(column(cell), F.lit(0))


def first_number(cell: Column | str) -> Column:
    """A number from text that holds either a scalar or a JSON list of numbers."""
    cell = column(cell)
    listed = F.get(F.from_json(cell, "array<double>"), F.lit(0))
    return F.when(cell.like("[%"), listed).otherwise(cell.try_cast("double"))


def json_int(body: Column | str, path: str, default: int = 0) -> Column:
    """Integer at a JSON path, ``default`` where it is absent. Text that is no integer fails."""
    return F.coalesce(F.get_json_object(column(body), path).cast("bigint"), F.lit(default).cast("bigint"))


def name_or_default(name: Column | str, default: str = UNKNOWN_NAME) -> Column:
    return F.coalesce(column(name), F.lit(default))


def record_id() -> Column:
    """Random UUID text. Write the rows before using them twice."""
    return F.uuid()


def _time_text(ts: Column | str | None) -> Column:
    """A time as its clock shows it, ``yyyy-MM-dd HH:mm:ss`` and what there is of a fraction (years of four
    digits). The cast does not pass a zone-less time through the session zone, as formatting would."""
    return (F.current_timestamp() if ts is None else column(ts)).cast("string")


def record_time(ts: Column | str | None = None) -> Column:
    # A date's text ends early: midnight.
    return F.rpad(F.substring(_time_text(ts), 1, 19), 19, " 00:00:00")


def iso_time(ts: Column | str | None = None) -> Column:
    fraction = F.rpad(F.substring(_time_text(ts), 21, 6), 6, "0")
    return F.concat(F.translate(record_time(ts), " ", "T"), F.lit("."), fraction)


def snapshot_time(ts: Column | str | None = None) -> Column:
    return F.translate(record_time(ts), " -:", "_")


def hour_parts(ts: Column | str) -> list[Column]:
    """Zero-padded ``year, month, day, hour`` text columns of a timestamp."""
    ts = column(ts)
    parts = {"year": (F.year, 4), "month": (F.month, 2), "day": (F.dayofmonth, 2), "hour": (F.hour, 2)}
    return [F.lpad(part(ts).cast("string"), width, "0").alias(name) for name, (part, width) in parts.items()]


def hour_floor(ts: Column | str) -> Column:
    """Start of the hour of a zone-less timestamp, independent of the session zone."""
    ts = column(ts)
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.minute(ts), F.extract(F.lit("SECOND"), ts))


def local_micros(ts: Column | str) -> Column:
    """Microseconds since 1970 of a time as its clock shows it, whatever the session zone."""
    ts = column(ts)
    seconds = F.unix_date(ts.cast("date")).cast("bigint") * 86_400 + F.hour(ts) * 3_600 + F.minute(ts) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")


def exclusive_end(today: Column | dt.date | str | None = None) -> Column:
    """The day after ``today`` as ``yyyy-MM-dd`` text: the open end of an up-to-now range."""
    if today is None:
        day = F.current_date()
    else:
        day = (today if isinstance(today, Column) else F.lit(str(today))).cast("date")
    return F.date_format(F.date_add(day, 1), "yyyy-MM-dd")


def epoch_millis_to_utc(millis: Column | str) -> Column:
    """Epoch milliseconds as a zone-less UTC timestamp, independent of the session zone."""
    seconds = (column(millis).cast("decimal(18,0)") / 1000).cast("decimal(18,6)")
    zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return zero + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def quote_line(name: Column | str, code: Column | str, price: Column | str) -> Column:
    """One message line, ``name (code): price KRW`` and a line break."""
    return F.format_string("%s (%s): %d KRW\n", column(name), column(code), column(price))
