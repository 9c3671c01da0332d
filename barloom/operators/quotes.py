"""Quote snapshots from landed responses, and the message about them."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.scalars import iso_time, quote_line, snapshot_time

# The watch list, in message order; response fields; message heading; success status.
WATCH_LIST = (
    {"code": "005930", "name": "삼성전자"},
    {"code": "000660", "name": "SK하이닉스"},
    {"code": "373220", "name": "LG에너지솔루션"},
    {"code": "207940", "name": "삼성바이오로직스"},
    {"code": "005380", "name": "현대차"},
)
PRICE, VOLUME = "stck_prpr", "acml_vol"
BODY = f"output1 struct<{PRICE}: string, {VOLUME}: string>"
HEADING = "📈 Stock Price Update:\n"
SUCCESS = 200


def split_responses(responses: DataFrame, status: str = "status", success: object = SUCCESS) -> tuple[DataFrame, DataFrame]:
    """Successful responses, and the others."""
    ok = F.col(status).eqNullSafe(F.lit(success))
    return responses.filter(ok), responses.filter(~ok)


def watch_frame(like: DataFrame, watch: Sequence[Mapping[str, object]] = WATCH_LIST) -> DataFrame:
    """The watch list as ``(code, name, pos)``, typed after the ``code`` column of ``like``."""
    if not watch:
        raise ValueError("empty watch list")
    kind = like.schema["code"].dataType.simpleString()
    # One literal, however long the list.
    rows = json.dumps([{"code": w["code"], "name": w["name"], "pos": i} for i, w in enumerate(watch)])
    parsed = F.from_json(F.lit(rows), f"array<struct<code: {kind}, name: string, pos: int>>", {"mode": "FAILFAST"})
    return like.sparkSession.range(0, 1, 1, 1).select(F.inline(parsed).alias("code", "name", "pos"))


def watched(quotes: DataFrame, watch: Sequence[Mapping[str, object]] = WATCH_LIST) -> DataFrame:
    """Quotes of watched codes with name and list position; Spark sees the size of the list."""
    return quotes.join(watch_frame(quotes, watch), "code")


def of_watched(responses: DataFrame, watch: Sequence[Mapping[str, object]] = WATCH_LIST) -> DataFrame:
    """Responses of watched codes, columns unchanged, so that no other body is parsed."""
    return responses.join(watch_frame(responses, watch).select("code"), "code", "left_semi")


def parse_quotes(responses: DataFrame, taken_at: Column | str | None = None) -> DataFrame:
    """``(code, price, volume, timestamp, run_ts)`` of successful responses; an absent number is 0."""
    ok, _ = split_responses(responses)
    # Both numbers from one parse of the body; they may come as texts.
    output = F.from_json("body", BODY)["output1"]
    return ok.select(
        "code",
        F.coalesce(output[PRICE].cast("bigint"), F.lit(0).cast("bigint")).alias("price"),
        F.coalesce(output[VOLUME].cast("bigint"), F.lit(0).cast("bigint")).alias("volume"),
        iso_time(taken_at).alias("timestamp"),
        snapshot_time(taken_at).alias("run_ts"),
    )


def last_per_run(quotes: DataFrame) -> DataFrame:
    """One quote per run and code: the latest, of several the one with most volume, then price."""
    latest = F.max(F.struct("timestamp", "volume", "price")).alias("last")
    return quotes.groupBy("run_ts", "code").agg(latest).select("code", "last.price", "last.volume", "last.timestamp", "run_ts")


def message(quotes: DataFrame, by: Sequence[str] = ("run_ts",), heading: str = HEADING) -> DataFrame:
    """One text per ``by`` group, a run unless told otherwise: heading and one line per quote in list order.

    Give one quote per code and group (``last_per_run``), then the list bounds what a group gathers.
    """
    line = quote_line("name", "code", "price")
    lined = quotes.select(*by, "pos", line.alias("line"))
    ordered = F.expr("listagg(line, '') WITHIN GROUP (ORDER BY pos, line)")
    return lined.groupBy(*by).agg(F.concat(F.lit(heading), F.coalesce(ordered, F.lit(""))).alias("message"))
