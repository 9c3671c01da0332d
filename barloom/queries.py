"""Every operator as a query over the shared test tables.

``events`` stands in for ticks and bars (series = user, price = value), ``customer`` for symbol
universes and names, ``orders`` for stored bars, ``lineitem`` and ``documents`` for bulk loads.
Each query reads its whole tables. Rounding happens here, never in an operator.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions import scalars as fx
from barloom.operators import bands, bars, inference, quality, quantiles, quotes, weather, windows
from barloom.plans import bar_panels, models, refresh, snapshot, weather_load
from barloom.plans.change_conditions import change_conditions as conditions
from barloom.session import scratch_path, stage
from barloom.sources import bar_store, files, records, sinks, tables, tolerant
from barloom.streaming import bar_updates
from barloom.streaming.landing import land_increment

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed values of the test set-up: how events map to bars, ranges, watched users.
BAR = dict(series=["user_id"], order="ts", close="value", tiebreak="event_id", zero_div="null")
RETURNS = list(windows.HORIZONS)
MONTH = ("1998-03-01", "1998-04-01")
DAYS = ("2024-01-05", "2024-01-20")
WATCHED = [
    {"code": 5, "name": "Fünf"}, {"code": 3, "name": "Three"}, {"code": 7, "name": "일곱"},
    {"code": 1, "name": "One"}, {"code": 9, "name": "Nine, the \"last\""},
]
RESPONSE_WATCHED = [{"code": str(w["code"]), "name": w["name"]} for w in WATCHED]


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, names: Sequence[str], digits: int) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def scratch_database(spark: SparkSession) -> str:
    path = scratch_path(spark, "db")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


def _scored(spark: SparkSession, sf_dir: str, slice_rows: int | None = windows.SLICE_ROWS) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    return windows.forward_returns(events, **BAR, slice_rows=slice_rows)


def _moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bands.sharp_moves(_scored(spark, sf_dir)).select("condition", *RETURNS)


# --- the model and its parts -------------------------------------------------------------------


@query
def change_conditions(spark, sf_dir):
    return rounded(conditions(table(spark, sf_dir, "events"), **BAR), bands.BANDS, 4)


@query
def change_conditions_at_scale(spark, sf_dir):
    """The same matrix by the route that large inputs take: stored moves, exact ranks spread out."""
    return rounded(conditions(table(spark, sf_dir, "events"), **BAR, in_memory_rows=0), bands.BANDS, 4)


@query
def pct_change(spark, sf_dir):
    return rounded(_scored(spark, sf_dir).select("event_id", "change"), ["change"], 6)


@query
def forward_returns(spark, sf_dir):
    return rounded(_scored(spark, sf_dir).select("event_id", *RETURNS), RETURNS, 6)


@query
def forward_returns_long_series(spark, sf_dir):
    """Five series that hold a fifth of all rows each, cut into slices sorted in parallel."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    per_slice = min(windows.SLICE_ROWS, max(200, events.count() // 64))
    scored = windows.forward_returns(events, **{**BAR, "series": ["event_type"]}, slice_rows=per_slice)
    return rounded(scored.select("event_id", "change", *RETURNS), ["change", *RETURNS], 6)


@query
def forward_returns_text_dates(spark, sf_dir):
    """Long series whose time is text with a long common head, as untyped loads make it."""
    stamp = F.concat(F.lit("stock exchange, close of trading at: "), F.col("ts").cast("string"))
    events = table(spark, sf_dir, "events").select("event_id", stamp.alias("ts"), "event_type", "value")
    per_slice = min(windows.SLICE_ROWS, max(200, events.count() // 64))
    scored = windows.forward_returns(events, **{**BAR, "series": ["event_type"]}, slice_rows=per_slice)
    return rounded(scored.select("event_id", "change", *RETURNS), ["change", *RETURNS], 6)


@query
def band_counts(spark, sf_dir):
    return bands.band_counts(_scored(spark, sf_dir))


@query
def band_mean(spark, sf_dir):
    return rounded(bands.means(_moves(spark, sf_dir), RETURNS, ["condition"]), [f"{r}_mean" for r in RETURNS], 4)


@query
def band_median(spark, sf_dir):
    medians = quantiles.percentiles(stage(_moves(spark, sf_dir), "moves"), ["condition"], RETURNS)
    return rounded(medians, [f"{r}_median" for r in RETURNS], 4)


@query
def band_median_spread(spark, sf_dir):
    """Exact medians by rank over spread-out rows, as used when a band is too large for one task."""
    medians = quantiles.percentiles_spread(stage(_moves(spark, sf_dir), "moves"), ["condition"], RETURNS)
    return rounded(medians, [f"{r}_median" for r in RETURNS], 4)


@query
def pivot_bands(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return bands.to_matrix(orders, "o_orderpriority", "o_orderstatus", ["F", "O", "P"], "o_totalprice")


@query
def unpivot_metrics(spark, sf_dir):
    by_nation = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        F.min("c_acctbal").alias("balance_min"), F.max("c_acctbal").alias("balance_max")
    )
    return bands.to_long(by_nation, ["c_nationkey"], ["balance_min", "balance_max"], "metric", "amount")


# --- panels ------------------------------------------------------------------------------------


def _lists(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    customer = table(spark, sf_dir, "customer").withColumn("Symbol", F.col("c_custkey"))
    return [
        customer.filter("c_acctbal > 5000"),
        customer.filter("c_mktsegment = 'BUILDING'"),
        customer.filter("c_nationkey < 5"),
    ]


def _building(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'")
    return customer.select(F.col("c_custkey").alias("symbol"), F.col("c_name").alias("fullname"))


def _order_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(F.col("o_custkey").alias("symbol"), "o_orderdate", "o_totalprice", "o_orderkey")


def _ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    size = F.get_json_object("props", "$.k").cast("bigint")
    return events.select(
        F.col("user_id").alias("symbol"), "ts", "event_id", F.col("value").alias("price"), size.alias("volume")
    )


@query
def universe_union(spark, sf_dir):
    return bars.distinct_symbols(_lists(spark, sf_dir))


@query
def universe_bars(spark, sf_dir):
    in_month = bars.in_range(_order_bars(spark, sf_dir), "o_orderdate", *MONTH)
    joined = bars.universe_bars(_building(spark, sf_dir), in_month)
    renames = {"symbol": "Ticker", "fullname": "Fullname", "o_orderdate": "Datetime", "o_totalprice": "Close"}
    return bars.as_layout(joined, renames, ["Ticker", "Fullname", "Datetime", "Close", "o_orderkey"])


@query
def missing_symbols(spark, sf_dir):
    in_month = bars.in_range(_order_bars(spark, sf_dir), "o_orderdate", *MONTH)
    return bars.missing_symbols(_building(spark, sf_dir), in_month)


@query
def concat_exchanges(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice", "o_orderstatus")
    first = orders.filter("o_orderpriority = '1-URGENT'")
    second = orders.filter("o_orderpriority = '2-HIGH'").drop("o_orderstatus")
    return bars.concat_bars([first, second])


@query
def name_default(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("symbol"))
    return bars.with_fullname(events, _building(spark, sf_dir))


@query
def hourly_bars(spark, sf_dir):
    built = bars.hourly_bars(table(spark, sf_dir, "events"), "event_type", "ts", "value", tiebreak="event_id")
    return built.withColumnsRenamed({"symbol": "event_type"})


@query
def hourly_bars_incremental(spark, sf_dir):
    """Ticks landed in four runs, the last ones late for most hours; after each the touched days are brought up to date."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    landing, store, checkpoint = (scratch_path(spark, n) for n in ("ticks", "bars", "checkpoint"))
    day = F.dayofmonth("ts")
    late = F.col("event_id") % 5 == 0
    for part in (~late & (day < 10), ~late & (day >= 10), F.lit(False), late):
        events.filter(part).write.mode("append").parquet(landing)
        bar_updates.update_hourly_bars(
            spark, landing, events.schema, store, checkpoint, "event_type", "ts", "value", tiebreak="event_id", source_format="parquet"
        )
    return bar_updates.read_hourly_bars(spark, store).withColumnsRenamed({"symbol": "event_type"})


@query
def forward_returns_stored_bars(spark, sf_dir):
    """Bars kept bucketed by series and sorted by time: the window reads them without a shuffle."""
    name = f"{scratch_database(spark)}.bars"
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    bar_store.store_bars(events.filter(F.dayofmonth("ts") < 15), name, ["user_id"], ["ts", "event_id"], buckets=8)
    stored = bar_store.store_bars(events.filter(F.dayofmonth("ts") >= 15), name, ["user_id"], ["ts", "event_id"], buckets=8)
    return rounded(windows.forward_returns(stored, **BAR).select("event_id", *RETURNS), RETURNS, 6)


@query
def run_report(spark, sf_dir):
    return bars.run_report(table(spark, sf_dir, "orders"), "o_custkey")


@query
def domestic_bars(spark, sf_dir):
    built, _ = bar_panels.domestic_bars(
        _building(spark, sf_dir), _ticks(spark, sf_dir), *DAYS, tiebreak="event_id"
    )
    return built


@query
def domestic_bars_missing(spark, sf_dir):
    _, missing = bar_panels.domestic_bars(
        _building(spark, sf_dir), _ticks(spark, sf_dir), *DAYS, tiebreak="event_id"
    )
    return missing


UNALIGNED = ("2024-01-05 09:20:00", "2024-01-06 12:40:00")


@query
def domestic_bars_unaligned(spark, sf_dir):
    """A range that cuts hours, its end a column: each symbol of the universe has bars or is missing."""
    end = F.lit(UNALIGNED[1]).cast("timestamp_ntz")
    built, missing = bar_panels.domestic_bars(
        _building(spark, sf_dir), _ticks(spark, sf_dir), UNALIGNED[0], end, tiebreak="event_id"
    )
    counted = built.groupBy(F.col("Ticker").alias("symbol")).agg(F.count(F.lit(1)).alias("bars"))
    return counted.union(missing.select("symbol", F.lit(0).cast("bigint")))


@query
def foreign_bars(spark, sf_dir):
    """Ticks whose price is text, a scalar or a one-element list."""
    as_list = F.concat(F.lit("["), F.col("price").cast("string"), F.lit("]"))
    cell = F.when(F.col("volume") < 50, as_list).otherwise(F.col("price").cast("string"))
    ticks = _ticks(spark, sf_dir).withColumn("price", cell)
    built, _ = bar_panels.foreign_bars(
        _lists(spark, sf_dir), ticks, _building(spark, sf_dir), *DAYS, tiebreak="event_id"
    )
    return built


# --- scalar functions --------------------------------------------------------------------------


@query
def first_element(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").withColumn("embedding", F.col("embedding").cast("array<double>"))
    listed = F.to_json("embedding")
    cell = F.when(F.col("label") % 2 == 0, listed).otherwise(fx.first_element("embedding").cast("string"))
    both = vectors.select("vec_id", fx.first_element("embedding").alias("first"), fx.first_number(cell).alias("number"))
    return rounded(both, ["first", "number"], 5)


@query
def json_int_default(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", fx.json_int("props", "$.k").alias("k"), fx.json_int("props", "$.z").alias("z"))


@query
def json_flatten(spark, sf_dir):
    body = F.from_json("props", "k bigint").alias("main")
    return table(spark, sf_dir, "events").select("event_id", body).select("event_id", "main.*")


@query
def json_records(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return files.from_records(files.to_records(orders), orders.schema)


@query
def epoch_to_utc(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return events.select("event_id", fx.epoch_millis_to_utc(millis).alias("ts"))


@query
def exclusive_end(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", fx.exclusive_end(F.col("o_orderdate")).alias("end_date"))


@query
def hour_parts(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select(*fx.hour_parts("ts")).groupBy(*sinks.HOUR_PARTS).agg(F.count(F.lit(1)).alias("n"))


@query
def time_texts(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", fx.record_time("ts").alias("record"), fx.snapshot_time("ts").alias("snapshot"), fx.iso_time("ts").alias("iso")
    )


@query
def row_uuid(spark, sf_dir):
    ids = table(spark, sf_dir, "events").select(fx.record_id().alias("id"))
    shape = r"^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    return ids.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("id").alias("ids"),
        F.count_if(F.col("id").rlike(shape)).alias("well_formed"),
    )


# --- quotes and weather ------------------------------------------------------------------------


@query
def watch_quotes(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("code", F.col("user_id"))
    ok, _ = quotes.split_responses(events, "event_type", "view")
    return quotes.watched(ok, WATCHED).select("event_id", "code", "name")


@query
def refused_responses(spark, sf_dir):
    _, refused = quotes.split_responses(table(spark, sf_dir, "events"), "event_type", "view")
    return refused.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query
def quote_message(spark, sf_dir):
    """One message per hour over the last quote of each watched code; five lines at most."""
    hourly = bars.hourly_bars(table(spark, sf_dir, "events"), "user_id", "ts", "value", tiebreak="event_id")
    last = hourly.select(F.col("symbol").alias("code"), "hour", F.floor(F.col("Close") * 100).alias("price"))
    return quotes.message(quotes.watched(last, WATCHED), ["hour"])


def _batch_time() -> Column:
    """A landing run every six hours."""
    return fx.hour_floor("ts") - F.make_dt_interval(F.lit(0), F.hour("ts") % 6)


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.floor(F.col("value") * 100).cast("string")
    size = F.when(F.col("event_type") != "signup", F.get_json_object("props", "$.k"))
    body = F.to_json(F.struct(F.struct(price.alias("stck_prpr"), size.alias("acml_vol")).alias("output1")))
    status = F.when(F.col("event_type") == "error", 500).otherwise(200)
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("code"), status.alias("status"), body.alias("body"), "ts"
    )


@query
def quote_snapshot(spark, sf_dir):
    taken = snapshot.quote_snapshot(_responses(spark, sf_dir), RESPONSE_WATCHED, "ts")
    return taken.select(*snapshot.SNAPSHOT_COLUMNS)


@query
def snapshot_and_notify(spark, sf_dir):
    """Runs of a second each: the stored quotes of a run, counted, beside its message."""
    path = scratch_path(spark, "notify")
    messages = snapshot.snapshot_and_notify(_responses(spark, sf_dir), path, RESPONSE_WATCHED, "ts")
    schema = "code string, price bigint, volume bigint, timestamp string, name string, run_ts string"
    stored = spark.read.schema(schema).json(path).groupBy("run_ts").agg(
        F.count(F.lit(1)).alias("n"), F.sum("price").alias("prices"), F.max("timestamp").alias("last")
    )
    return stored.join(messages, "run_ts", "full")


@query
def weather_records(spark, sf_dir):
    """Weather responses landed by hour and taken in; landing and loading again adds nothing."""
    fields = [f["name"] for f in weather.WEATHER_FIELDS[2:]]
    value, number = F.col("value"), F.col("event_id")
    values = [value, value - 1, value - 2, value + 2, number % 50, F.lit(None), F.when(number % 3 == 0, number), number]
    values = [v.cast("double") for v in values]
    main = F.struct(*[v.alias(n) for v, n in zip(values, fields)]).alias("main")
    responses = table(spark, sf_dir, "events").select(main, _batch_time().alias("ts"))
    landing, target = scratch_path(spark, "landing"), scratch_path(spark, "weather")
    checkpoint = scratch_path(spark, "checkpoint")
    for _ in range(2):
        weather_load.land_weather(responses, "ts", landing)
        weather_load.load_weather(spark, landing, target, checkpoint)
    return weather_load.read_weather(spark, target).select("resp_ingested_timestamp", *fields)


# --- schema and quality ------------------------------------------------------------------------


def _as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


@query
def infer_types(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumns(
        {
            "Datetime": F.col("o_orderdate"),
            "Date": F.unix_millis(F.col("o_orderdate").cast("timestamp")),
            "gaps": F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")),
            "nothing": F.lit(None).cast("string"),
            "flag": F.col("o_orderstatus") == "F",
        }
    )
    return inference.infer_types(_as_text(orders))


def _with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))


@query
def not_null_report(spark, sf_dir):
    return quality.not_null_report(_with_gaps(spark, sf_dir), "events", ["event_id", "value", "props"])


@query
def required_gate(spark, sf_dir):
    good, bad = quality.split_required(_with_gaps(spark, sf_dir), ["value", "props"])
    tagged = good.select("event_id", F.lit("good").alias("verdict"))
    return tagged.union(bad.select("event_id", F.lit("bad").alias("verdict")))


@query
def declared_schema(spark, sf_dir):
    fields = [
        {"name": "event_id", "mode": "REQUIRED", "type": "INTEGER"},
        {"name": "ts", "mode": "NULLABLE", "type": "DATETIME"},
        {"name": "event_type", "mode": "NULLABLE", "type": "STRING"},
        {"name": "value", "mode": "NULLABLE", "type": "FLOAT"},
    ]
    path = scratch_path(spark, "declared")
    table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value").write.json(path)
    return files.read_files(spark, f"{path}/*.json", fields, "NEWLINE_DELIMITED_JSON", strict_fields=True)


# --- sources, sinks, tables --------------------------------------------------------------------


@query
def parquet_scan(spark, sf_dir):
    symbols = table(spark, sf_dir, "customer").select(
        F.lpad(F.col("c_custkey").cast("string"), 12, "0").alias("symbol"), F.col("c_name").alias("fullname")
    )
    path = scratch_path(spark, "universe")
    symbols.write.parquet(path)
    return files.read_universe(spark, path)


@query
def csv_index_scan(spark, sf_dir):
    ranked = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias(" "), F.lpad(F.col("c_custkey").cast("string"), 12, "0").alias("Symbol"), F.col("c_name").alias("Name")
    )
    path = scratch_path(spark, "ranked")
    ranked.write.options(header=True).csv(path)
    return files.read_indexed_csv(spark, path)


@query
def dual_sink(spark, sf_dir):
    """Rows that both copies hold, counted on both sides: all of them."""
    orders = table(spark, sf_dir, "orders")
    parquet, csv = scratch_path(spark, "dual-parquet"), scratch_path(spark, "dual-csv")
    sinks.write_dual(orders, parquet, csv)
    from_csv = spark.read.schema(orders.schema).options(header=True, escape='"').csv(csv)
    return files.scan_parquet(spark, parquet, orders.schema).intersectAll(from_csv)


def _orders_fields() -> list[dict[str, str]]:
    return [
        {"name": "o_orderkey", "mode": "REQUIRED", "type": "INTEGER"},
        {"name": "o_custkey", "mode": "NULLABLE", "type": "INTEGER"},
        {"name": "o_totalprice", "mode": "NULLABLE", "type": "FLOAT"},
        {"name": "o_orderdate", "mode": "NULLABLE", "type": "DATETIME"},
        {"name": "o_orderpriority", "mode": "NULLABLE", "type": "STRING"},
    ]


def _load_twice(spark: SparkSession, sf_dir: str, disposition: str, source_format: str, write) -> DataFrame:
    names = [f["name"] for f in _orders_fields()]
    path, target = scratch_path(spark, "load"), f"{scratch_database(spark)}.orders"
    write(table(spark, sf_dir, "orders").select(*names).write, path)
    for _ in range(2):
        loaded = files.load_files(spark, path, target, _orders_fields(), source_format, disposition, header=True)
    return loaded


@query
def load_ndjson_append(spark, sf_dir):
    return _load_twice(spark, sf_dir, "WRITE_APPEND", "NEWLINE_DELIMITED_JSON", lambda w, p: w.json(p))


@query
def load_ndjson_truncate(spark, sf_dir):
    return _load_twice(spark, sf_dir, "WRITE_TRUNCATE", "NEWLINE_DELIMITED_JSON", lambda w, p: w.json(p))


@query
def load_parquet_truncate(spark, sf_dir):
    return _load_twice(spark, sf_dir, "WRITE_TRUNCATE", "PARQUET", lambda w, p: w.parquet(p))


@query
def load_truncate_failed(spark, sf_dir):
    """A good load, then a truncating one with a NULL in a REQUIRED field: the old rows remain."""
    orders = table(spark, sf_dir, "orders").select(*[f["name"] for f in _orders_fields()])
    good, bad, target = scratch_path(spark, "good"), scratch_path(spark, "bad"), f"{scratch_database(spark)}.orders"
    orders.write.json(good)
    orders.withColumn("o_orderkey", F.when(F.col("o_orderkey") % 7 > 0, F.col("o_orderkey"))).write.json(bad)
    for _ in range(2):
        files.load_files(spark, good, target, _orders_fields(), "NEWLINE_DELIMITED_JSON", "WRITE_TRUNCATE")
    try:
        files.load_files(spark, bad, target, _orders_fields(), "NEWLINE_DELIMITED_JSON", "WRITE_TRUNCATE")
    except Exception as failed:
        if "REQUIRED field o_orderkey" not in str(failed):
            raise
        # Appending to the published name goes to its current version.
        return files.load_files(spark, good, target, _orders_fields(), "NEWLINE_DELIMITED_JSON", "WRITE_APPEND")
    raise AssertionError("a NULL in a REQUIRED field was loaded")


@query
def load_csv_quoted_newlines(spark, sf_dir):
    fields = [
        {"name": "doc_id", "mode": "REQUIRED", "type": "INTEGER"},
        {"name": "text", "mode": "NULLABLE", "type": "STRING"},
    ]
    path, target = scratch_path(spark, "texts"), f"{scratch_database(spark)}.documents"
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    texts.write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    loaded = files.load_files(spark, path, target, fields, "CSV", "WRITE_APPEND", quoted_newlines=True, header=True)
    return loaded.select("doc_id", F.md5("text").alias("digest"), F.length("text").alias("chars"))


@query
def csv_ranges(spark, sf_dir):
    """Files of texts with quotes and line breaks of both kinds, each cut into records by many tasks. Every task writes a file
    of what it reads; one file of all texts would go through one task."""
    path = scratch_path(spark, "files")
    text = F.concat(F.col("text"), F.when(F.col("doc_id") % 3 == 0, "\r\n\"said\", \"\"").otherwise(""))
    texts = table(spark, sf_dir, "documents").select("doc_id", text.alias("text"), "lang")
    texts.write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    schema = T.StructType.fromDDL("doc_id bigint, text string, lang string")
    read = records.read_records(spark, path, schema, header=True, mode="FAILFAST", range_bytes=64 << 10)
    return read.select("doc_id", F.md5("text").alias("digest"), F.length("text").alias("chars"), "lang")


BULK = ["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate", "l_returnflag"]


def _bulk_csv(spark: SparkSession, sf_dir: str) -> tuple[str, T.StructType]:
    """lineitem as CSV with a header in each file and, for every returned line, one bad line more."""
    lines = table(spark, sf_dir, "lineitem").select(*BULK)
    good = lines.select(F.to_csv(F.struct(*BULK)).alias("line"))
    returned = lines.filter("l_returnflag = 'R'")
    kind = F.col("l_linenumber") % 3
    short = F.concat_ws(",", "l_orderkey", "l_linenumber")
    wrong = F.concat_ws(",", "l_orderkey", "l_linenumber", F.lit("much"), F.lit("1998-01-01T00:00:00.000"), F.lit("R"))
    wide = F.concat_ws(
        ",", "l_orderkey", "l_linenumber", F.lit("1.5"), F.lit("1998-01-01T00:00:00.000"), F.repeat(F.lit("R"), 300)
    )
    bad = returned.select(F.when(kind == 0, short).when(kind == 1, wrong).otherwise(wide).alias("line"))
    path = scratch_path(spark, "bulk")
    # One column whose name is the header line, and a separator that does not occur: plain lines.
    whole = good.union(bad).withColumnRenamed("line", ",".join(BULK))
    whole.write.options(header=True, sep="\u0001", quote="").csv(path)
    return path, lines.schema


@query
def tolerant_csv(spark, sf_dir):
    return tolerant.good_rows(tolerant.parse_tolerant_csv(spark, *_bulk_csv(spark, sf_dir)))


@query
def tolerant_csv_rejects(spark, sf_dir):
    bad = tolerant.rejects(tolerant.parse_tolerant_csv(spark, *_bulk_csv(spark, sf_dir)))
    return bad.groupBy(tolerant.REASON).agg(F.count(tolerant.RECORD).alias("n"))


@query
def refresh_table(spark, sf_dir):
    """A stored CSV published as a table with inferred types, twice: the second replaces the first."""
    path, target = scratch_path(spark, "refresh"), f"{scratch_database(spark)}.lines"
    renamed = table(spark, sf_dir, "lineitem").select(*BULK).withColumnRenamed("l_shipdate", "Date")
    renamed.write.options(header=True).csv(path)
    refresh.refresh_table(spark, path, target)
    loaded, _ = refresh.refresh_table(spark, path, target, gates=[quality.not_null_gate(["l_orderkey"])])
    return loaded


@query
def refresh_inferred(spark, sf_dir):
    """Symbols with zeros in front, padded numbers and N/A cells: what is inferred is what loads."""
    customer = table(spark, sf_dir, "customer")
    path, target = scratch_path(spark, "cells"), f"{scratch_database(spark)}.cells"
    key = F.col("c_custkey")
    customer.select(
        F.lpad(key.cast("string"), 6, "0").alias("Ticker"),
        F.concat(F.when(key % 2 == 0, " ").otherwise(""), (key * 3).cast("string"), F.lit(" ")).alias("units"),
        F.when(key % 5 == 0, "N/A").when(key % 5 == 1, "").otherwise(F.concat(F.lit(" "), F.col("c_acctbal").cast("string"))).alias("balance"),
    ).write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    loaded, rejected = refresh.refresh_table(spark, path, target)
    return loaded.unionByName(rejected.select(F.lit("reject").alias("Ticker")), allowMissingColumns=True)


@query
def observed_refresh(spark, sf_dir):
    """What the one write of a refresh counted on its way, with the rows that both tables then show."""
    path, schema = _bulk_csv(spark, sf_dir)
    target = f"{scratch_database(spark)}.lines"
    gate = quality.not_null_gate(["l_orderkey", "l_returnflag"], "lines")
    loaded, rejected, counts = refresh.refresh_counted(spark, path, target, schema, gates=[gate])
    counts = counts | {"loaded": loaded.count(), "rejected": rejected.count()}
    return spark.createDataFrame(list(counts.items()), "metric string, n bigint")


@query
def publish_gated(spark, sf_dir):
    """A refresh that passes its gate, then one that does not: the table keeps the first."""
    customer = table(spark, sf_dir, "customer")
    target, gate = f"{scratch_database(spark)}.customer", quality.not_null_gate(["c_name"])
    tables.publish(customer, target, [gate])
    gaps = customer.withColumn("c_name", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")))
    try:
        tables.publish(gaps, target, [gate])
    except quality.GateFailed:
        return spark.table(target)
    raise AssertionError("the gate let NULL names through")


@query
def persistent_view(spark, sf_dir):
    """A staging model as a view in the catalog, read by another session."""
    database = scratch_database(spark)
    tables.publish(table(spark, sf_dir, "orders"), f"{database}.orders")
    view = f"{database}.urgent"
    tables.persistent_view(
        spark, view, f"SELECT o_custkey AS name, o_orderdate AS day, o_totalprice AS price FROM {database}.orders WHERE o_orderpriority = '1-URGENT'"
    )
    return spark.newSession().table(view)


@query
def snapshot_sink(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value", "ts")
    path = scratch_path(spark, "snapshots")
    sinks.write_snapshot(events, path, _batch_time())
    schema = "event_id bigint, event_type string, value double, ts timestamp_ntz, run_ts string"
    return spark.read.schema(schema).json(path)


@query
def hour_landing(spark, sf_dir):
    """Landed twice: each hour is replaced, not doubled."""
    events = table(spark, sf_dir, "events").select("event_id", "value", "ts")
    path = scratch_path(spark, "hours")
    for _ in range(2):
        sinks.write_by_hour(events, path, _batch_time())
    schema = sinks.hour_landing_schema("event_id bigint, value double, ts timestamp_ntz")
    return spark.read.schema(schema).json(path)


@query
def incremental_land(spark, sf_dir):
    """Three runs: urgent orders, the same again with nothing new, then all the others."""
    orders = table(spark, sf_dir, "orders")
    landing, sink, checkpoint = (scratch_path(spark, n) for n in ("landing", "sink", "checkpoint"))
    urgent = F.col("o_orderpriority") == "1-URGENT"
    for part in (urgent, F.lit(False), ~urgent):
        orders.filter(part).write.mode("append").json(landing)
        land_increment(spark, landing, orders.schema, sink, checkpoint)
    return spark.read.schema(orders.schema).parquet(sink)


@query
def model_chain(spark, sf_dir):
    """Raw source, inlined staging model, stored output model, passed test."""
    database = scratch_database(spark)
    raw = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("Name"),
        F.concat(F.lit("User "), F.col("user_id")).alias("Fullname"),
        F.col("ts").alias("Date"),
        F.col("value").alias("Close"),
        F.col("event_id").alias("Volume"),
    )
    name = f"raw_bars_{database}"
    tables.materialise(raw, name, "view")
    models.run_models(spark, database, {("raw", "fs_st_if_cpl"): name}, zero_div="null")
    models.test_models(spark, database)
    return rounded(spark.table(f"{database}.{models.OUTPUT_MODEL}"), bands.BANDS, 4)


