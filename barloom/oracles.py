"""The same results in plain SQL, written from the operator descriptions."""

from __future__ import annotations

from barloom.operators.bands import BANDS
from barloom.operators.windows import HORIZONS
from barloom.queries import DAYS, MONTH, RESPONSE_WATCHED, UNALIGNED, WATCHED


def _pct(base: str, new: str) -> str:
    return f"({new} - {base}) / nullif({base}, 0) * 100"


def _scored(series: str = "user_id") -> str:
    ahead = ", ".join(f"{_pct('value', f'lead(value, {n}) OVER w')} AS {name}" for name, n in HORIZONS.items())
    return (
        f"SELECT event_id, {_pct('lag(value) OVER w', 'value')} AS change, {ahead} FROM events "
        f"WINDOW w AS (PARTITION BY {series} ORDER BY ts, event_id)"
    )


_MOVES = (
    f"WITH scored AS ({_scored()}), moves AS (SELECT *, CASE WHEN change > 10 THEN '{BANDS[0]}' "
    f"WHEN change > 5 THEN '{BANDS[1]}' WHEN change <= -10 THEN '{BANDS[2]}' ELSE '{BANDS[3]}' END AS condition "
    "FROM scored WHERE change > 5 OR change <= -5) "
)


def _matrix() -> str:
    lines = []
    for kind, call in (("mean", "avg({})"), ("median", "quantile_cont({}, 0.5)")):
        for name in HORIZONS:
            cells = ", ".join(f"round({call.format(name)} FILTER (condition = '{b}'), 4) AS \"{b}\"" for b in BANDS)
            lines.append(f"SELECT '{name}_{kind}' AS \"METRIC\", {cells} FROM moves HAVING count(*) > 0")
    return _MOVES + " UNION ALL ".join(lines)


def _per_band(call: str, kind: str) -> str:
    cells = ", ".join(f"round({call.format(n)}, 4) AS {n}_{kind}" for n in HORIZONS)
    return f"{_MOVES} SELECT condition, {cells} FROM moves GROUP BY condition"


def _returns(series: str = "user_id", change: bool = True) -> str:
    names = (["change"] if change else []) + list(HORIZONS)
    cells = ", ".join(f"round({n}, 6) AS {n}" for n in names)
    return f"SELECT event_id, {cells} FROM ({_scored(series)})"


def _watch(watch) -> str:
    def text(value):
        return str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"

    rows = ", ".join(f"({text(w['code'])}, {text(w['name'])}, {i})" for i, w in enumerate(watch))
    return f"(VALUES {rows}) AS watch(code, name, pos)"


_IN_MONTH = f"o_orderdate >= TIMESTAMP '{MONTH[0]}' AND o_orderdate < TIMESTAMP '{MONTH[1]}'"
_IN_DAYS = f"ts >= TIMESTAMP '{DAYS[0]}' AND ts < TIMESTAMP '{DAYS[1]}'"
_ORDERS = "o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority"
_LISTED = "c_acctbal > 5000 OR c_mktsegment = 'BUILDING' OR c_nationkey < 5"
_OHLC = (
    "arg_max(value, (ts, event_id)) AS \"Close\", max(value) AS \"High\", min(value) AS \"Low\", "
    "arg_min(value, (ts, event_id)) AS \"Open\""
)
_HOUR = "CAST(date_trunc('hour', ts) AS TIMESTAMP)"
_BATCH = "CAST(date_trunc('hour', ts) - to_hours(hour(ts) % 6) AS TIMESTAMP)"
_K = "TRY_CAST(props->>'$.k' AS BIGINT)"
_TICK_BARS = (
    f"SELECT user_id AS symbol, {_HOUR} AS hour, {_OHLC}, CAST(sum({_K}) AS BIGINT) AS \"Volume\" "
    f"FROM events WHERE {_IN_DAYS} GROUP BY 1, 2"
)
_BUILDING = "SELECT c_custkey AS symbol, c_name AS fullname FROM customer WHERE c_mktsegment = 'BUILDING'"
_BULK = "l_orderkey, l_linenumber, l_quantity, l_shipdate, l_returnflag"
_INT, _FLOAT = r"\s*[+-]?[0-9]+\s*", r"\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*"


def _infer() -> str:
    columns = {
        "o_orderkey": "o_orderkey", "o_custkey": "o_custkey", "o_orderstatus": "o_orderstatus",
        "o_totalprice": "o_totalprice", "o_orderdate": "o_orderdate", "o_orderpriority": "o_orderpriority",
        "Datetime": "o_orderdate", "Date": "epoch_ms(o_orderdate)",
        "gaps": "CASE WHEN o_orderstatus <> 'P' THEN o_custkey END", "nothing": "NULL", "flag": "o_orderstatus = 'F'",
    }
    lines = []
    for i, (name, value) in enumerate(columns.items()):
        cell = f"CAST({value} AS VARCHAR)"
        other = "TIMESTAMP" if name in ("Date", "Datetime") else "VARCHAR(255)"
        lines.append(
            f"SELECT {i} AS position, '{name}' AS \"column\", CASE "
            f"WHEN count(*) FILTER (regexp_full_match({cell}, '{_INT}')) = count(*) THEN 'INTEGER' "
            f"WHEN count(*) FILTER (regexp_full_match({cell}, '{_FLOAT}')) = count({cell}) THEN 'FLOAT' "
            f"ELSE '{other}' END AS type FROM orders"
        )
    return " UNION ALL ".join(lines)


def _null_lines() -> str:
    gaps = "CASE WHEN event_type <> 'error' THEN value END"
    cells = {"event_id": "event_id", "value": gaps, "props": "props"}
    return " UNION ALL ".join(
        f"SELECT 'events' AS model, '{n}' AS \"column\", 'not_null' AS test, count(*) - count({c}) AS failures FROM events"
        for n, c in cells.items()
    )


ORACLES: dict[str, str] = {
    "change_conditions": _matrix(),
    "change_conditions_at_scale": _matrix(),
    "model_chain": _matrix(),
    "pct_change": "SELECT event_id, round(change, 6) AS change FROM (" + _scored() + ")",
    "forward_returns": _returns(change=False),
    "forward_returns_long_series": _returns("event_type"),
    "forward_returns_text_dates": _returns("event_type"),
    "band_counts": _MOVES + "SELECT condition, count(*) AS n FROM moves GROUP BY condition",
    "band_mean": _per_band("avg({})", "mean"),
    "band_median": _per_band("quantile_cont({}, 0.5)", "median"),
    "band_median_spread": _per_band("quantile_cont({}, 0.5)", "median"),
    "pivot_bands": "SELECT o_orderpriority, "
    + ", ".join(f"max(o_totalprice) FILTER (o_orderstatus = '{s}') AS \"{s}\"" for s in "FOP")
    + " FROM orders GROUP BY o_orderpriority",
    "unpivot_metrics": "SELECT c_nationkey, 'balance_min' AS metric, min(c_acctbal) AS amount FROM customer GROUP BY 1 "
    "UNION ALL SELECT c_nationkey, 'balance_max', max(c_acctbal) FROM customer GROUP BY 1",
    "universe_union": f"SELECT DISTINCT c_custkey AS \"Symbol\" FROM customer WHERE {_LISTED}",
    "universe_bars": "SELECT c_custkey AS \"Ticker\", c_name AS \"Fullname\", o_orderdate AS \"Datetime\", "
    "o_totalprice AS \"Close\", o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey "
    f"WHERE c_mktsegment = 'BUILDING' AND {_IN_MONTH}",
    "missing_symbols": f"SELECT symbol, fullname FROM ({_BUILDING}) u WHERE NOT EXISTS "
    f"(SELECT 1 FROM orders WHERE o_custkey = u.symbol AND {_IN_MONTH})",
    "concat_exchanges": "SELECT o_orderkey, o_orderpriority, o_totalprice, CASE WHEN o_orderpriority = '1-URGENT' "
    "THEN o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')",
    "name_default": "SELECT user_id AS symbol, event_id, coalesce(fullname, 'N/A') AS fullname "
    f"FROM events LEFT JOIN ({_BUILDING}) u ON user_id = u.symbol",
    "forward_returns_stored_bars": _returns(change=False),
    "hourly_bars_incremental": f"SELECT event_type, {_HOUR} AS hour, {_OHLC}, count(*) AS \"Volume\" FROM events GROUP BY 1, 2",
    "hourly_bars": f"SELECT event_type, {_HOUR} AS hour, {_OHLC}, count(*) AS \"Volume\" FROM events GROUP BY 1, 2",
    "run_report": "SELECT count(DISTINCT o_custkey) AS symbols, count(*) AS rows FROM orders",
    "domestic_bars": "SELECT symbol AS \"Ticker\", fullname AS \"Fullname\", hour AS \"Datetime\", \"Close\", \"High\", "
    f"\"Low\", \"Open\", \"Volume\" FROM ({_TICK_BARS}) JOIN ({_BUILDING}) u USING (symbol)",
    "domestic_bars_missing": f"SELECT symbol, fullname FROM ({_BUILDING}) WHERE symbol NOT IN "
    f"(SELECT user_id FROM events WHERE {_IN_DAYS})",
    "foreign_bars": "SELECT symbol AS \"Name\", coalesce(fullname, 'N/A') AS \"Fullname\", hour AS \"Date\", \"Close\", "
    f"\"High\", \"Low\", \"Open\", \"Volume\" FROM ({_TICK_BARS}) LEFT JOIN ({_BUILDING}) u USING (symbol) "
    f"WHERE symbol IN (SELECT c_custkey FROM customer WHERE {_LISTED})",
    "first_element": "SELECT vec_id, round(CAST(embedding[1] AS DOUBLE), 5) AS first, "
    "round(CAST(embedding[1] AS DOUBLE), 5) AS number FROM embeddings",
    "json_int_default": f"SELECT event_id, coalesce({_K}, 0) AS k, coalesce(TRY_CAST(props->>'$.z' AS BIGINT), 0) AS z FROM events",
    "json_flatten": f"SELECT event_id, {_K} AS k FROM events",
    "json_records": "SELECT * FROM orders",
    "epoch_to_utc": "SELECT event_id, CAST(date_trunc('milliseconds', ts) AS TIMESTAMP) AS ts FROM events",
    "exclusive_end": "SELECT o_orderkey, strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') AS end_date FROM orders",
    "hour_parts": "SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, "
    "strftime(ts, '%H') AS hour, count(*) AS n FROM events GROUP BY 1, 2, 3, 4",
    "time_texts": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS record, strftime(ts, '%Y%m%d_%H%M%S') AS snapshot, "
    "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso FROM events",
    "row_uuid": "SELECT count(*) AS rows, count(*) AS ids, count(*) AS well_formed FROM events",
    "watch_quotes": f"SELECT event_id, user_id AS code, name FROM events JOIN {_watch(WATCHED)} ON code = user_id WHERE event_type = 'view'",
    "refused_responses": "SELECT event_type, count(*) AS n FROM events WHERE event_type IS DISTINCT FROM 'view' GROUP BY 1",
    "quote_message": f"WITH last AS (SELECT user_id, {_HOUR} AS hour, arg_max(value, (ts, event_id)) AS price FROM events "
    f"GROUP BY 1, 2) SELECT hour, '📈 Stock Price Update:' || chr(10) || string_agg(printf('%s (%s): %d KRW', name, "
    f"CAST(code AS VARCHAR), CAST(floor(price * 100) AS BIGINT)) || chr(10), '' ORDER BY pos) AS message "
    f"FROM last JOIN {_watch(WATCHED)} ON code = user_id GROUP BY hour",
    "quote_snapshot": "SELECT code, CAST(floor(value * 100) AS BIGINT) AS price, CASE WHEN event_type = 'signup' THEN 0 "
    f"ELSE {_K} END AS volume, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, name FROM events "
    f"JOIN {_watch(RESPONSE_WATCHED)} ON code = CAST(user_id AS VARCHAR) WHERE event_type <> 'error'",
    "weather_records": f"SELECT {_BATCH} AS resp_ingested_timestamp, value AS temp, value - 1 AS feels_like, "
    "value - 2 AS temp_min, value + 2 AS temp_max, CAST(event_id % 50 AS DOUBLE) AS pressure, CAST(NULL AS DOUBLE) AS humidity, "
    "CASE WHEN event_id % 3 = 0 THEN CAST(event_id AS DOUBLE) END AS sea_level, CAST(event_id AS DOUBLE) AS grnd_level FROM events",
    "snapshot_and_notify": "WITH q AS (SELECT strftime(ts, '%Y%m%d_%H%M%S') AS run_ts, CAST(user_id AS VARCHAR) AS code, "
    "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, CASE WHEN event_type = 'signup' THEN 0 ELSE "
    f"{_K} END AS volume, CAST(floor(value * 100) AS BIGINT) AS price FROM events WHERE event_type <> 'error'), "
    "last AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY run_ts, code ORDER BY timestamp DESC, volume DESC, price DESC) = 1) "
    f"SELECT run_ts, count(*) AS n, CAST(sum(price) AS BIGINT) AS prices, max(timestamp) AS last, '📈 Stock Price Update:' || chr(10) "
    "|| string_agg(printf('%s (%s): %d KRW', name, code, price) || chr(10), '' ORDER BY pos) AS message "
    f"FROM last JOIN {_watch(RESPONSE_WATCHED)} USING (code) GROUP BY run_ts",
    "domestic_bars_unaligned": f"SELECT symbol, count(hour) AS bars FROM ({_BUILDING}) u LEFT JOIN (SELECT DISTINCT user_id, {_HOUR} AS hour "
    f"FROM events WHERE {_HOUR} >= TIMESTAMP '{UNALIGNED[0]}' AND {_HOUR} < TIMESTAMP '{UNALIGNED[1]}') ON user_id = symbol GROUP BY symbol",
    "load_truncate_failed": f"SELECT {_ORDERS} FROM orders UNION ALL SELECT {_ORDERS} FROM orders",
    "refresh_inferred": "SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS \"Ticker\", c_custkey * 3 AS units, "
    "CASE WHEN c_custkey % 5 > 1 THEN c_acctbal END AS balance FROM customer",
    "infer_types": _infer(),
    "not_null_report": _null_lines(),
    "required_gate": "SELECT event_id, CASE WHEN event_type <> 'error' AND props IS NOT NULL THEN 'good' ELSE 'bad' END "
    "AS verdict FROM events",
    "declared_schema": "SELECT event_id, date_trunc('milliseconds', ts)::TIMESTAMP AS ts, event_type, value FROM events",
    "parquet_scan": "SELECT lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS symbol, c_name AS fullname FROM customer",
    "csv_index_scan": "SELECT lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS \"Symbol\", c_name AS \"Name\" FROM customer",
    "dual_sink": "SELECT * FROM orders",
    "load_ndjson_append": f"SELECT {_ORDERS} FROM orders UNION ALL SELECT {_ORDERS} FROM orders",
    "load_ndjson_truncate": f"SELECT {_ORDERS} FROM orders",
    "load_parquet_truncate": f"SELECT {_ORDERS} FROM orders",
    "load_csv_quoted_newlines": "SELECT doc_id, md5(text) AS digest, CAST(length(text) AS INTEGER) AS chars FROM documents",
    "tolerant_csv": f"SELECT {_BULK} FROM lineitem",
    "csv_ranges": "WITH t AS (SELECT doc_id, lang, text || CASE WHEN doc_id % 3 = 0 THEN chr(13) || chr(10) || '\"said\", \"\"' ELSE '' END AS text "
    "FROM documents) SELECT doc_id, md5(text) AS digest, CAST(length(text) AS INTEGER) AS chars, lang FROM t",
    "tolerant_csv_rejects": "SELECT CASE WHEN l_linenumber % 3 < 2 THEN 'malformed' ELSE 'l_returnflag longer than 255' END "
    "AS _reason, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1",
    "refresh_table": "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, l_shipdate AS \"Date\", l_returnflag FROM lineitem",
    "observed_refresh": "WITH c AS (SELECT count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS bad FROM lineitem) "
    "SELECT 'rows' AS metric, n + bad AS n FROM c UNION ALL SELECT 'rejects', bad FROM c "
    "UNION ALL SELECT 'lines.l_orderkey not_null', 0 UNION ALL SELECT 'lines.l_returnflag not_null', 0 "
    "UNION ALL SELECT 'loaded', n FROM c UNION ALL SELECT 'rejected', bad FROM c",
    "publish_gated": "SELECT * FROM customer",
    "persistent_view": "SELECT o_custkey AS name, o_orderdate AS day, o_totalprice AS price FROM orders WHERE o_orderpriority = '1-URGENT'",
    "snapshot_sink": "SELECT event_id, event_type, value, date_trunc('milliseconds', ts)::TIMESTAMP AS ts, "
    f"strftime({_BATCH}, '%Y%m%d_%H%M%S') AS run_ts FROM events",
    "hour_landing": "SELECT event_id, value, date_trunc('milliseconds', ts)::TIMESTAMP AS ts, strftime(ts, '%Y') AS year, "
    f"strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, strftime({_BATCH}, '%H') AS hour FROM events",
    "incremental_land": "SELECT * FROM orders",
}
