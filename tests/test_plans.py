import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from barloom.functions import scalars as fx
from barloom.operators import bars, quotes, weather
from barloom.plans import bar_panels, models, snapshot, weather_load
from barloom.session import scratch_root, stage
from barloom.sources import tables

TICKS = "symbol string, id bigint, ts timestamp_ntz, price double, volume bigint"
DAY = dt.datetime(2024, 11, 1)


def at(hour, minute=0):
    return DAY + dt.timedelta(hours=hour, minutes=minute)


def ticks(spark):
    return spark.createDataFrame(
        [
            ("005930", 2, at(9, 5), 70.0, 10), ("005930", 1, at(9, 5), 69.0, 1), ("005930", 3, at(9, 59), 75.0, 5),
            ("005930", 4, at(10), 71.0, None), ("AAPL", 5, at(9), 200.0, 2), ("OTHER", 6, at(9), 1.0, 1),
            ("AAPL", 7, at(33), 210.0, 2),
        ],
        TICKS,
    )


def universe(spark):
    return spark.createDataFrame([("005930", "삼성전자"), ("AAPL", "Apple"), ("NONE", "No bars")], "symbol string, fullname string")


def test_hourly_bars(spark):
    got = {(r.symbol, r.hour.hour): tuple(r)[2:] for r in bars.hourly_bars(ticks(spark), "symbol", "ts", "price", "volume", "id").collect()}
    assert got[("005930", 9)] == (69.0, 75.0, 69.0, 75.0, 16)
    assert got[("005930", 10)] == (71.0, 71.0, 71.0, 71.0, None)


def test_domestic_bars(spark, tmp_path):
    built, missing = bar_panels.domestic_bars(universe(spark), ticks(spark), "2024-11-01", "2024-11-02", tiebreak="id")
    assert built.columns == list(bars.DOMESTIC_COLUMNS)
    assert sorted((r.Ticker, r.Datetime.hour, r.Close) for r in built.collect()) == [
        ("005930", 9, 75.0), ("005930", 10, 71.0), ("AAPL", 9, 200.0),
    ]
    assert [r.symbol for r in missing.collect()] == ["NONE"]
    bar_panels.store_panel(built, str(tmp_path / "p"), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 3


def test_foreign_bars_with_list_cells_and_unknown_names(spark):
    lists = [spark.createDataFrame([(s,) for s in symbols], "Symbol string") for symbols in (["AAPL", "005930"], ["AAPL", None], ["OTHER", None])]
    text = ticks(spark).withColumn("price", F.when(F.col("id") < 5, F.concat(F.lit("["), "price", F.lit("]"))).otherwise(F.col("price").cast("string")))
    text = text.withColumn("volume", F.concat(F.lit("["), "volume", F.lit("]")))
    built, missing = bar_panels.foreign_bars(lists, text, universe(spark), "2024-11-01", "2024-11-02", tiebreak="id")
    assert built.columns == list(bars.FOREIGN_COLUMNS)
    assert {(r.Name, r.Fullname) for r in built.collect()} == {("AAPL", "Apple"), ("005930", "삼성전자"), ("OTHER", "N/A")}
    assert {(r.Close, r.Volume) for r in built.filter("Name = '005930'").collect()} == {(75.0, 16), (71.0, None)}
    assert [r.symbol for r in missing.collect()] == [None]
    assert bars.distinct_symbols(lists).count() == 4


def test_panel_and_missing_part_the_universe(spark):
    seen = [("A", at(9) + dt.timedelta(minutes=45)), ("B", at(12) + dt.timedelta(minutes=45)), ("C", at(12) + dt.timedelta(minutes=10))]
    rows = spark.createDataFrame([(s, t, 1.0, 1) for s, t in seen], "symbol string, ts timestamp_ntz, price double, volume bigint")
    names = spark.createDataFrame([(s, s) for s in "ABCD"], "symbol string, fullname string")
    day = seen[0][1].date()
    for end in (f"{day} 12:30:00", F.lit(f"{day} 12:30:00").cast("timestamp_ntz")):
        built, missing = bar_panels.domestic_bars(names, rows, f"{day} 09:30:00", end)
        assert {r.Ticker for r in built.collect()} == {"B", "C"}
        assert {r.symbol for r in missing.collect()} == {"A", "D"}
    built, missing = bar_panels.domestic_bars(names, rows, str(day), fx.exclusive_end(F.lit(str(day))))
    assert {r.Ticker for r in built.collect()} == {"A", "B", "C"} and {r.symbol for r in missing.collect()} == {"D"}


def test_bars_are_hash_aggregated(spark):
    rows = [("A", at(9), 1, 1.0), ("A", at(9), None, 2.0), ("A", at(9), 2, 3.0), ("A", None, 5, 4.0), ("A", at(9), -3, 5.0)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, tie bigint, price double")
    built = bars.hourly_bars(df, "symbol", "ts", "price", tiebreak="tie")
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert {(r.hour, r.Open, r.Close) for r in built.collect()} == {(None, 4.0, 4.0), (at(9), 2.0, 3.0)}


def test_range_is_pushed_to_the_scan(spark, tmp_path):
    ticks(spark).write.parquet(str(tmp_path / "t"))
    built, _ = bar_panels.domestic_bars(universe(spark), spark.read.parquet(str(tmp_path / "t")), "2024-11-01", "2024-11-02")
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-11-01" in plan and "LessThan(ts,2024-11-02T01:00" in plan


def test_concat_fills_absent_columns(spark):
    df = bars.concat_bars([spark.range(1).withColumn("a", F.lit(1)), spark.range(2)])
    assert df.count() == 3 and df.filter("a is null").count() == 2


def test_run_report(spark):
    assert tuple(bars.run_report(ticks(spark), "symbol").first()) == (3, 7)
    assert tuple(bars.run_report(ticks(spark).limit(0), "symbol").first()) == (0, 0)


def responses(spark):
    def body(price, volume):
        return json.dumps({"output1": {k: v for k, v in (("stck_prpr", price), ("acml_vol", volume)) if v is not None}})

    return spark.createDataFrame(
        [("000660", 200, body("180000", "5")), ("005930", 200, body("71000", None)), ("373220", 500, "oops"),
         ("207940", None, "oops"), ("111111", 200, body("1", "1"))],
        "code string, status int, body string",
    )


def test_snapshot_and_message(spark, tmp_path):
    taken = F.lit(dt.datetime(2024, 11, 25, 9, 5))
    text = snapshot.snapshot_and_notify(responses(spark), str(tmp_path / "s"), taken_at=taken).first().message
    assert text == "📈 Stock Price Update:\n삼성전자 (005930): 71000 KRW\nSK하이닉스 (000660): 180000 KRW\n"
    stored = spark.read.schema("code string, price bigint, volume bigint, timestamp string, name string, run_ts string").json(str(tmp_path / "s"))
    row = stored.filter("code = '005930'").first()
    assert tuple(row) == ("005930", 71000, 0, "2024-11-25T09:05:00.000000", "삼성전자", "20241125_090500")
    assert stored.count() == 2


def test_message_without_quotes_is_the_heading(spark):
    none = snapshot.quote_snapshot(responses(spark).limit(0))
    assert quotes.message(none, by=()).first().message == quotes.HEADING
    assert quotes.message(none).count() == 0


def test_each_run_has_its_own_message(spark, tmp_path):
    path = str(tmp_path / "s")
    polls = [
        ("005930", 1, 9, 0), ("005930", 2, 9, 0), ("000660", 3, 9, 0), ("005930", 4, 10, 0), ("000660", 5, 10, 0), ("000660", 6, 10, 0),
    ]
    body = lambda price: json.dumps({"output1": {"stck_prpr": str(price), "acml_vol": str(price)}})
    rows = [(c, 200, body(p), dt.datetime(2024, 11, 25, h, m)) for c, p, h, m in polls]
    df = spark.createDataFrame(rows, "code string, status int, body string, seen timestamp_ntz")
    messages = {r.run_ts: r.message for r in snapshot.snapshot_and_notify(df, path, taken_at="seen").collect()}
    assert messages == {
        "20241125_090000": quotes.HEADING + "삼성전자 (005930): 2 KRW\nSK하이닉스 (000660): 3 KRW\n",
        "20241125_100000": quotes.HEADING + "삼성전자 (005930): 4 KRW\nSK하이닉스 (000660): 6 KRW\n",
    }
    assert spark.read.json(path).count() == 4
    assert {r.message for r in snapshot.snapshot_and_notify(df, path).collect()} and spark.read.json(path).count() == 6


def test_watch_lists_of_any_length(spark):
    watch = [{"code": f"{i:06d}", "name": "x"} for i in range(20_000)]
    assert {r.code for r in quotes.watched(responses(spark), watch).collect()} == {"000660", "005930"}


def test_refused_responses_are_kept(spark):
    ok, refused = quotes.split_responses(responses(spark))
    assert ok.count() == 3 and refused.count() == 2


def test_weather_is_landed_and_loaded_once(spark, tmp_path):
    landing, table, checkpoint = (str(tmp_path / n) for n in ("landing", "table", "state"))

    def responses(*temps):
        lines = [json.dumps({"main": {"temp": t, "humidity": 80}}) for t in temps]
        df = spark.createDataFrame([(line,) for line in lines], "body string")
        return df.select(F.from_json("body", weather.RESPONSE_SCHEMA).alias("r")).select("r.main", F.lit(at(9)).alias("seen"))

    def load():
        weather_load.load_weather(spark, landing, table, checkpoint)
        return sorted((r.temp, r.sea_level, r.resp_ingested_timestamp) for r in weather_load.read_weather(spark, table).collect())

    weather_load.land_weather(responses(20.5), "seen", landing)
    assert load() == [(20.5, None, at(9))]
    weather_load.land_weather(responses(20.5, 21.0), "seen", landing)
    assert load() == load() == [(20.5, None, at(9)), (21.0, None, at(9))]
    assert all(r.uuid for r in weather_load.read_weather(spark, table).collect())
    # Several records of one second are several records.
    weather_load.land_weather(responses(20.5, 21.0, 22.0, 23.0, 24.0), "seen", landing)
    assert len(load()) == len(load()) == 5


def test_models_run_and_pass_their_test(spark, database):
    closes = [100.0, 106.0, 90.0, 99.0]
    raw = spark.createDataFrame([("A", "a", at(i), c, 1) for i, c in enumerate(closes)], "Name string, Fullname string, Date timestamp_ntz, Close double, Volume int")
    raw.write.saveAsTable(f"{database}.foreign_stock_info_complete")
    sources = {("raw", "fs_st_if_cpl"): f"{database}.foreign_stock_info_complete"}
    models.run_models(spark, database, sources)
    assert models.run_models(spark, database, sources).count() == 8
    assert models.test_models(spark, database).first().failures == 0
    tables.publish(spark.createDataFrame([(None,)], "METRIC string"), f"{database}.{models.OUTPUT_MODEL}")
    with pytest.raises(Exception, match="METRIC not_null: 1"):
        models.test_models(spark, database)


def test_stage_uses_the_configured_folder(spark):
    assert stage(spark.range(3)).count() == 3
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert scratch_root(spark) == configured.rstrip("/")
