import hashlib
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.sources import records
from barloom.queries import QUERIES
from barloom.operators.inference import infer_types, inferred_struct
from barloom.operators.quality import GateFailed, not_null_gate, not_null_report, require_pass, split_required
from barloom.operators.weather import WEATHER_FIELDS
from barloom.plans.refresh import refresh_table
from barloom.sources import files, sinks, tables, tolerant
from barloom.streaming.landing import land_increment

FIELDS = [{"name": "id", "mode": "REQUIRED", "type": "STRING"}, {"name": "x", "mode": "NULLABLE", "type": "FLOAT"}]


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


# --- inference ---------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "name, cells, want",
    [
        ("x", ["1", "2"], "INTEGER"), ("x", ["1", None], "FLOAT"), ("x", ["True", "False"], "VARCHAR(255)"),
        ("x", [None, None], "FLOAT"), ("Date", ["2024-01-01", "x"], "TIMESTAMP"), ("Date", ["1", "2"], "INTEGER"),
        ("Datetime", ["a"], "TIMESTAMP"), ("date", ["a"], "VARCHAR(255)"), ("x", ["1", "N/A"], "FLOAT"),
        ("x", ["1", " 2 ", "+3", "-4"], "INTEGER"), ("x", ["1.", ".5", "1e3", "inf", "-Infinity"], "FLOAT"),
        ("x", ["1.0f"], "VARCHAR(255)"), ("x", ["1_000"], "VARCHAR(255)"), ("x", ["0x1F"], "VARCHAR(255)"),
        ("x", ["9223372036854775808", "1"], "INTEGER"), ("x", ["9223372036854775808", "-1"], "VARCHAR(255)"),
        ("x", ["9223372036854775808", None], "VARCHAR(255)"), ("x", ["18446744073709551616"], "VARCHAR(255)"),
        ("x", ["1e400", "1.5"], "VARCHAR(255)"), ("x", ["1e-400", "1"], "FLOAT"), ("x", [" ", "1"], "VARCHAR(255)"),
        ("x", [], "VARCHAR(255)"), ("it's `odd`", ["1"], "INTEGER"),
    ],
)
def test_inferred_type(spark, name, cells, want):
    schema = T.StructType([T.StructField(name, T.StringType())])
    rows = infer_types(spark.createDataFrame([(c,) for c in cells], schema)).collect()
    assert [(r.position, r.column, r.type) for r in rows] == [(0, name, want)]


def test_inferred_struct_follows_the_columns(spark):
    df = spark.createDataFrame([("005930", "1.5", "2024-01-01")], "Ticker string, Close string, Date string")
    assert inferred_struct(infer_types(df)).simpleString() == "struct<Ticker:bigint,Close:double,Date:timestamp_ntz>"
    text = inferred_struct(infer_types(df), ["ticker"])
    assert text.simpleString() == "struct<Ticker:string,Close:double,Date:timestamp_ntz>"


# --- readers -----------------------------------------------------------------------------------


def test_indexed_csv_drops_the_index_and_keeps_zeros(spark, tmp_path):
    path = put(tmp_path / "a", "a.csv", ",Symbol,Name\n0,005930,\"Samsung, Co\"\n1,AAPL,\n")
    df = files.read_indexed_csv(spark, path)
    assert df.columns == ["Symbol", "Name"]
    assert sorted(tuple(r) for r in df.collect()) == [("005930", "Samsung, Co"), ("AAPL", None)]


def test_json_array_file(spark, tmp_path):
    path = put(tmp_path / "a", "q.json", json.dumps([{"code": "1", "name": "일"}, {"code": "2", "name": "이"}], indent=2, ensure_ascii=False))
    rows = files.read_json_arrays(spark, path, "code string, name string").collect()
    assert [tuple(r) for r in rows] == [("1", "일"), ("2", "이")]


def test_declared_schema(spark):
    schema = files.struct_of(WEATHER_FIELDS)
    assert schema["uuid"].nullable is False and schema["resp_ingested_timestamp"].dataType == T.TimestampNTZType()
    assert [f.dataType for f in schema.fields[2:]] == [T.DoubleType()] * 8


def test_load_appends_and_truncates(spark, tmp_path, database):
    path = put(tmp_path / "a", "a.json", '{"id": "a", "x": 1}\n{"id": "b"}\n')
    table = f"{database}.t"
    for mode, want in (("WRITE_APPEND", 2), ("WRITE_APPEND", 4), ("WRITE_TRUNCATE", 2)):
        df = files.load_files(spark, f"{path}/*.json", table, FIELDS, "NEWLINE_DELIMITED_JSON", mode)
        assert df.count() == want


@pytest.mark.parametrize("line", ['{"x": 1}', '{"id": null, "x": 1}', '{"id": "a", "x": "much"}', "{broken"])
def test_bad_json_record_fails_and_commits_nothing(spark, tmp_path, database, line):
    path = put(tmp_path / "a", "a.json", f'{{"id": "a", "x": 1}}\n{line}\n')
    good = put(tmp_path / "b", "b.json", '{"id": "z", "x": 9}\n')
    table = f"{database}.t"
    files.load_files(spark, good, table, FIELDS, "NEWLINE_DELIMITED_JSON")
    with pytest.raises(Exception):
        files.load_files(spark, path, table, FIELDS, "NEWLINE_DELIMITED_JSON")
    assert [r.id for r in spark.table(table).collect()] == ["z"]


def test_strict_fields(spark, tmp_path):
    path = put(tmp_path / "a", "a.json", '{"id": "a", "x": 1, "y": 2}\n\n')
    lenient = files.read_files(spark, path, FIELDS, "NEWLINE_DELIMITED_JSON")
    assert lenient.collect() == [("a", 1.0)]
    with pytest.raises(Exception, match="undeclared fields: y"):
        files.read_files(spark, path, FIELDS, "NEWLINE_DELIMITED_JSON", strict_fields=True).collect()


def test_quoted_newlines(spark, tmp_path):
    path = put(tmp_path / "a", "a.csv", '"a\nb ""q""",1.5\nc,\n')
    df = files.read_files(spark, path, FIELDS, "CSV", quoted_newlines=True)
    assert sorted(tuple(r) for r in df.collect()) == [('a\nb "q"', 1.5), ("c", None)]


def test_unknown_formats_are_refused(spark, database):
    with pytest.raises(ValueError):
        files.read_files(spark, "x", FIELDS, "GOOGLE_SHEETS")
    with pytest.raises(ValueError):
        files.load_files(spark, "x", f"{database}.t", FIELDS, "CSV", "WRITE_EMPTY")


def test_avro_is_passed_to_its_reader(spark):
    with pytest.raises(Exception, match="(?i)avro"):
        files.read_files(spark, "/nowhere", FIELDS, "AVRO")


# --- tolerant CSV ------------------------------------------------------------------------------

BARS = T.StructType([T.StructField("name", T.StringType()), T.StructField("close", T.DoubleType()), T.StructField("n", T.LongType())])


@pytest.fixture
def bad_csv(tmp_path):
    lines = ["name,close,n", "a,1.5,1", "b,much,2", "c,3", '"d, e",4,4', '"f ""g""",5,5', ",,", "h" * 300 + ",6,6", "i,7,7,7"]
    return put(tmp_path / "csv", "x.csv", "\n".join(lines) + "\n")


def test_tolerant_rows_and_rejects(spark, bad_csv):
    parsed = tolerant.parse_tolerant_csv(spark, bad_csv, BARS)
    assert sorted(map(repr, (tuple(r) for r in tolerant.good_rows(parsed).collect()))) == sorted(
        map(repr, [("a", 1.5, 1), ("d, e", 4.0, 4), ('f "g"', 5.0, 5), (None, None, None)])
    )
    bad = {r._record.split(",")[0][:3]: r._reason for r in tolerant.rejects(parsed).collect()}
    assert bad == {"b": "malformed", "c": "malformed", "i": "malformed", "hhh": "name longer than 255"}


def test_tolerant_counts_do_not_depend_on_the_columns_read(spark, bad_csv):
    good = tolerant.good_rows(tolerant.parse_tolerant_csv(spark, bad_csv, BARS))
    assert good.count() == good.select("name").count() == len(good.select("n").collect()) == 4


def test_refresh_table(spark, tmp_path, bad_csv, database):
    table = f"{database}.bars"
    loaded, bad = refresh_table(spark, bad_csv, table, BARS)
    assert (loaded.count(), bad.count()) == (4, 4)
    path = put(tmp_path / "next", "y.csv", "Name,Date,Close\nA,2024-11-01 09:00:00,1.5\nB,soon,2\n")
    loaded, bad = refresh_table(spark, path, table)
    assert [tuple(r) for r in loaded.collect()] == [("A", dt.datetime(2024, 11, 1, 9), 1.5)]
    assert [r._reason for r in bad.collect()] == ["malformed"]
    with pytest.raises(GateFailed):
        refresh_table(spark, put(tmp_path / "last", "z.csv", "Name,Close\n,1\nB,2\n"), table, gates=[not_null_gate(["Name"])])
    assert spark.table(table).count() == 1 and spark.table(f"{table}_rejects").count() == 1


def test_what_is_inferred_loads(spark, tmp_path, database):
    lines = ["Ticker,a,b,c", '005930, 1,1.5,"x "', "000660,2 ,N/A,NA", "000001,3,inf,1.0f"]
    loaded, bad = refresh_table(spark, put(tmp_path / "a", "a.csv", "\n".join(lines) + "\n"), f"{database}.t")
    assert loaded.schema.simpleString() == "struct<Ticker:string,a:bigint,b:double,c:string>" and bad.count() == 0
    assert sorted(tuple(r) for r in loaded.collect()) == [
        ("000001", 3, float("inf"), "1.0f"), ("000660", 2, None, "NA"), ("005930", 1, 1.5, "x "),
    ]
    given = T.StructType([T.StructField("c", T.DoubleType())])
    parsed = tolerant.parse_tolerant_csv(spark, put(tmp_path / "b", "b.csv", "c\n1.0f\n 2 \nnan\n"), given)
    assert [r.c for r in tolerant.good_rows(parsed).collect()] == [2.0, None] and tolerant.rejects(parsed).count() == 1


def test_refresh_without_a_good_row_is_refused(spark, tmp_path, database):
    table, schema = f"{database}.t", T.StructType([T.StructField("n", T.LongType())])
    refresh_table(spark, put(tmp_path / "a", "a.csv", "n\n1\n"), table, schema)
    with pytest.raises(GateFailed, match="2 of 2"):
        refresh_table(spark, put(tmp_path / "b", "b.csv", "n\nx\ny\n"), table, schema)
    half = put(tmp_path / "c", "c.csv", "n\n7\ny\n")
    with pytest.raises(GateFailed):
        refresh_table(spark, half, table, schema, max_reject_share=0.2)
    assert [r.n for r in spark.table(table).collect()] == [1]
    assert refresh_table(spark, half, table, schema, max_reject_share=0.5)[1].count() == 1


def test_refresh_leaves_no_intermediates(spark, tmp_path, database):
    from pathlib import Path

    from barloom.session import scratch_root

    folder = Path(scratch_root(spark).removeprefix("file:"))
    before = set(folder.glob("parsed-*"))
    refresh_table(spark, put(tmp_path / "a", "a.csv", "n,m\n1,2\n"), f"{database}.t")
    with pytest.raises(GateFailed):
        refresh_table(spark, put(tmp_path / "b", "b.csv", "n,m\n1\n"), f"{database}.t")
    assert set(folder.glob("parsed-*")) == before


# --- tables and gates --------------------------------------------------------------------------


def test_failed_gate_keeps_the_old_rows(spark, database):
    table = f"{database}.t"
    tables.publish(spark.range(3), table)
    gaps = spark.range(2).select(F.lit(None).cast("bigint").alias("id"))
    with pytest.raises(GateFailed, match="rows.id not_null: 2"):
        tables.publish(gaps, table, [not_null_gate(["id"])])
    assert spark.table(table).count() == 3 and len(tables.versions(spark, table)) == 1


def test_failed_write_keeps_the_old_rows(spark, database):
    table = f"{database}.t"
    tables.publish(spark.range(3), table)
    with pytest.raises(Exception):
        tables.publish(spark.range(3).select(F.raise_error(F.lit("lost")).cast("bigint").alias("id")), table)
    assert spark.table(table).count() == 3


def test_publish_replaces_schema_and_prunes_versions(spark, database):
    table = f"{database}.t"
    for i in range(4):
        tables.publish(spark.range(i + 1).withColumn(f"c{i}", F.lit(i)), table)
    assert spark.table(table).columns == ["id", "c3"] and spark.table(table).count() == 4
    assert len(tables.versions(spark, table)) == 2


def test_failed_truncate_keeps_the_old_rows(spark, tmp_path, database):
    table = f"{database}.t"
    good, bad = put(tmp_path / "a", "a.json", '{"id": "a", "x": 1}\n'), put(tmp_path / "b", "b.json", '{"id": "b"}\n{"x": 1}\n')
    files.load_files(spark, good, table, FIELDS, "NEWLINE_DELIMITED_JSON", "WRITE_TRUNCATE")
    for _ in range(2):
        with pytest.raises(Exception, match="REQUIRED field id"):
            files.load_files(spark, bad, table, FIELDS, "NEWLINE_DELIMITED_JSON", "WRITE_TRUNCATE")
    assert [r.id for r in spark.table(table).collect()] == ["a"]
    assert files.load_files(spark, good, table, FIELDS, "NEWLINE_DELIMITED_JSON", "WRITE_APPEND").count() == 2
    assert len(tables.versions(spark, table)) == 1


def test_names_that_look_like_versions_are_left_alone(spark, database):
    for name in ("x__vx", "x__vx", "x", "x", "x", "x__v1"):
        tables.publish(spark.range(len(name)), f"{database}.{name}")
    tables.publish(spark.range(9), f"{database}.x")
    assert spark.table(f"{database}.x__vx").count() == 5 and spark.table(f"{database}.x__v1").count() == 5
    assert spark.table(f"{database}.x").count() == 9
    assert len(tables.versions(spark, f"{database}.x")) == 2


def test_publish_takes_over_a_plain_table(spark, database):
    table = f"{database}.t"
    spark.range(9).write.saveAsTable(table)
    assert tables.publish(spark.table(table).limit(2), table).count() == 2
    assert tables.publish(spark.table(table).union(spark.table(table)), table).count() == 4


def test_publish_keeps_labels_with_blanks_and_signs(spark, database):
    df = spark.range(1).select(F.lit(1.0).alias("Change <= -10"))
    assert tables.publish(df, f"{database}.t").columns == ["Change <= -10"]


def test_materialise(spark, database):
    df = spark.range(2)
    assert tables.materialise(df, "x", "ephemeral") is df
    assert tables.materialise(df, "view_of_two", "view").count() == spark.table("view_of_two").count() == 2
    assert tables.materialise(df, f"{database}.two", "table").count() == 2
    with pytest.raises(ValueError):
        tables.materialise(df, "x", "incremental")


def test_not_null_report_and_gate(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b int")
    report = not_null_report(df, "m", ["a", "b"])
    assert [tuple(r) for r in report.collect()] == [("m", "a", "not_null", 1), ("m", "b", "not_null", 2)]
    with pytest.raises(GateFailed):
        require_pass(report)
    require_pass(not_null_report(df.limit(0), "m", ["a"]))
    good, bad = split_required(df, ["a"])
    assert (good.count(), bad.count()) == (1, 1)


# --- sinks and increments ----------------------------------------------------------------------


def test_dual_sink_agrees_for_random_ids(spark, tmp_path):
    df = spark.range(20).select(F.uuid().alias("id"), F.lit('a "b", c').alias("t"))
    sinks.write_dual(df, str(tmp_path / "p"), str(tmp_path / "c"))
    a = spark.read.parquet(str(tmp_path / "p")).collect()
    b = files.read_text_csv(spark, str(tmp_path / "c")).collect()
    assert sorted(a) == sorted(b) and len(a) == 20
    sinks.write_dual(df, str(tmp_path / "p"), str(tmp_path / "c"))
    assert files.read_text_csv(spark, str(tmp_path / "c")).count() == 20


def test_snapshots_add_up(spark, tmp_path):
    df = spark.createDataFrame([("005930", "삼성전자")], "code string, name string")
    for second in (1, 2):
        sinks.write_snapshot(df, str(tmp_path / "s"), F.lit(dt.datetime(2024, 1, 1, 0, 0, second)))
    back = spark.read.schema("code string, name string, run_ts string").json(str(tmp_path / "s")).orderBy("run_ts").collect()
    assert [tuple(r) for r in back] == [("005930", "삼성전자", f"20240101_00000{s}") for s in (1, 2)]


def test_hour_landing_replaces_only_its_hours(spark, tmp_path):
    path, schema = str(tmp_path / "h"), "id bigint, ts timestamp_ntz"

    def rows(*pairs):
        return spark.createDataFrame([(i, dt.datetime(2024, 1, 1, h)) for i, h in pairs], schema)

    sinks.write_by_hour(rows((1, 5), (2, 6)), path, "ts")
    sinks.write_by_hour(rows((3, 6), (4, 6)), path, "ts")
    back = spark.read.schema(sinks.hour_landing_schema(schema)).json(path).orderBy("id").collect()
    assert [(r.id, r.hour) for r in back] == [(1, "05"), (3, "06"), (4, "06")]


def test_increment_takes_each_file_once(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))

    def count():
        return spark.read.schema("id bigint").parquet(sink).count()

    spark.range(25).write.json(source)
    assert land_increment(spark, source, "id bigint", sink, checkpoint) == 25 and count() == 25
    assert land_increment(spark, source, "id bigint", sink, checkpoint) == 0 and count() == 25
    spark.range(3).write.mode("append").json(source)
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", None)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        spark.range(9).repartition(9).write.mode("append").json(source)
        assert land_increment(spark, source, "id bigint", sink, checkpoint, files_per_batch=1) == 12 and count() == 37
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates") if kept is None else spark.conf.set(
            "spark.sql.streaming.numRecentProgressUpdates", kept
        )


@pytest.mark.parametrize("parts", [(), ("day",)])
def test_increment_drops_known_keys_however_old(spark, tmp_path, parts):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "key string, day date"

    def land(*rows):
        spark.createDataFrame([(k, d and dt.date.fromisoformat(d)) for k, d in rows], schema).write.mode("append").json(source)
        land_increment(spark, source, schema, sink, checkpoint, unique_by=["key", "day"], partition_by=parts)
        return sorted(map(str, (tuple(r) for r in spark.read.schema(schema).parquet(sink).collect())))

    first = land(("a", "2024-01-02"), ("a", "2024-01-02"), ("b", "2024-01-03"), (None, None))
    assert len(first) == 3
    assert land(("a", "2024-01-02"), ("b", "2024-01-03"), (None, None)) == first
    assert len(land(("c", "2023-06-01"), ("a", "2024-01-03"))) == 5


def test_no_task_reads_all_texts_to_write_or_stitch_them(spark, tmp_path, monkeypatch):
    texts = [f'text {i}\n"quoted", ' * (i % 40 + 1) for i in range(600)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    paths, plans, read, stitch = [], [], records.read_records, records._stitched
    monkeypatch.setattr(records, "read_records", lambda s, path, *a, **k: paths.append(path) or read(s, path, *a, **k))
    monkeypatch.setattr(records, "_stitched", lambda pieces: plans.append(stitch(pieces)) or plans[-1])
    got = {r["doc_id"]: r["digest"] for r in QUERIES["csv_ranges"](spark, str(tmp_path)).collect()}
    ends = ['\r\n"said", ""' if i % 3 == 0 else "" for i in range(600)]
    assert got == {i: hashlib.md5((t + e).encode()).hexdigest() for i, (t, e) in enumerate(zip(texts, ends))}
    assert spark.read.text(paths[0]).select("_metadata.file_path").distinct().count() == 3
    # The window over the borders of a file is over their places.
    lines = plans[0]._jdf.queryExecution().optimizedPlan().toString().split("\n")
    windows = [i for i, line in enumerate(lines) if "Window [" in line]
    assert windows and not [i for i in windows if "record#" in lines[i + 1]]
