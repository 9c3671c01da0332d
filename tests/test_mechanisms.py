"""Records over ranges, split publishing, observed gates, stored and updated bars, narrowed medians, lasting views."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators import bars as bar_ops
from barloom.operators import quantiles
from barloom.operators.quality import GateFailed, counted_write, not_null_gate
from barloom.operators.windows import forward_returns
from barloom.plans import refresh
from barloom.session import scratch_path, stage
from barloom.sources import bar_store, files, records, tables
from barloom.streaming import bar_updates


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ---- records


def odd_csv(seed, n=200):
    """CSV text with line breaks, separators and doubled quotes in quoted cells, CRLF lines, blank lines, quotes inside
    plain cells."""
    rng = random.Random(seed)

    def cell():
        kind = rng.randrange(8)
        if kind == 0:
            return '"' + "".join(rng.choice(["a", ",", '""', "\n", "\r\n", "é", "\n\n"]) for _ in range(rng.randrange(30))) + '"'
        if kind == 1:
            return '"' + "line\n" * rng.randrange(1, 40) + '"'
        return rng.choice(["", "plain", 'in"side', "x y", "12", 'a""b', '""', '"quoted"'])

    end = rng.choice(["\n", "\r\n"])
    lines = [",".join(cell() for _ in range(3)) for _ in range(n)]
    return "a,b,c" + end + end.join(line + (end if rng.random() < 0.05 else "") for line in lines) + rng.choice(["", end])


@pytest.mark.parametrize("seed", range(3))
def test_records_of_ranges_are_those_of_the_whole_file(spark, tmp_path, seed):
    folder = tmp_path / "csv"
    folder.mkdir()
    for i in range(2):
        (folder / f"{i}.csv").write_text(odd_csv(10 * seed + i), newline="")
    schema = T.StructType.fromDDL("a string, b string, c string")
    whole = spark.read.schema(schema).options(header=True, quote='"', escape='"', multiLine=True).csv(str(folder))
    want = rows(whole)
    assert len(want) > 300
    for size in (400, None):
        assert rows(records.read_records(spark, str(folder), schema, header=True, range_bytes=size)) == want
    named = records.read_records(spark, str(folder), header=True, range_bytes=2_000)
    assert named.columns == ["a", "b", "c"] and rows(named) == want


def test_one_file_is_cut_by_many_tasks(spark, tmp_path):
    text = "id,text\n" + "".join(f'{i},"first {i}\n,second\r\n""third"""\n' for i in range(20_000))
    path = tmp_path / "one.csv"
    path.write_text(text, newline="")
    found = records.csv_records(spark, str(path), range_bytes=50_000)
    pieces = found.inputFiles()
    assert found.count() == 20_001 and len([p for p in pieces if "records-" in p]) >= 8
    read = records.read_records(spark, str(path), T.StructType.fromDDL("id int, text string"), header=True, mode="FAILFAST", range_bytes=50_000)
    assert rows(read) == sorted(((i, f'first {i}\n,second\r\n"third"') for i in range(20_000)), key=repr)


def test_a_task_reads_many_ranges(spark, tmp_path):
    path = tmp_path / "many.csv"
    path.write_text("id,text\n" + "".join(f'{i},"first {i}\n,second ""third"""\n' for i in range(4_000)), newline="")
    schema, names = T.StructType.fromDDL("id int, text string"), [*records.RANGE_SETTINGS, "spark.sql.files.maxPartitionNum"]
    want = sorted(((i, f'first {i}\n,second "third"') for i in range(4_000)), key=repr)
    before, size = [spark.conf.get(n, None) for n in names], path.stat().st_size
    assert size > 500 * 200

    def files(found):
        return {p for p in found.inputFiles() if "records-" in p}

    # Ranges of 200 bytes, and at most so many tasks as keep the cores busy, each of which stores one file.
    few = files(records.csv_records(spark, str(path), range_bytes=200))
    assert spark.sparkContext.defaultParallelism <= len(few) <= 4 * spark.sparkContext.defaultParallelism + 1
    assert [spark.conf.get(n, None) for n in names] == before
    assert rows(records.read_records(spark, str(path), schema, header=True, mode="FAILFAST", range_bytes=200)) == want
    # A task reads no more than the session's own partition.
    spark.conf.set(names[0], "1000b")
    try:
        many = files(records.csv_records(spark, str(path), range_bytes=200))
        assert len(many) >= size // 1000 and spark.conf.get(names[0]) == "1000b"
    finally:
        spark.conf.unset(names[0])


def test_a_record_over_many_ranges_and_an_open_one(spark, tmp_path):
    path = tmp_path / "long.csv"
    path.write_text('a,b\n1,"' + "word\n" * 2_000 + '"\n\n2,x\n3,"left open\nto the end', newline="")
    schema = T.StructType.fromDDL("a int, b string")
    want = rows(spark.read.schema(schema).options(header=True, quote='"', escape='"', multiLine=True).csv(str(path)))
    assert rows(records.read_records(spark, str(path), schema, header=True, range_bytes=700)) == want
    empty = tmp_path / "empty.csv"
    empty.write_text("")
    assert records.csv_records(spark, str(empty)).count() == 0


def test_quoted_newlines_fail_fast_on_malformed_records(spark, tmp_path, database):
    path = tmp_path / "bad.csv"
    path.write_text('a,b\n1,"x\ny"\n2\n')
    fields = [{"name": "a", "mode": "REQUIRED", "type": "INTEGER"}, {"name": "b", "mode": "NULLABLE", "type": "STRING"}]
    with pytest.raises(Exception, match="(?i)malformed"):
        files.load_files(spark, str(path), f"{database}.bad", fields, "CSV", quoted_newlines=True, header=True)
    assert not spark.catalog.tableExists(f"{database}.bad")


def test_tolerant_load_keeps_rejects_with_line_breaks(spark, tmp_path, database):
    path = tmp_path / "rejects.csv"
    path.write_text('n,text\n1,"a\nb"\nmany,"c\nd"\n3\n4,"e ""f"""\n')
    schema = T.StructType.fromDDL("n int, text string")
    loaded, bad = refresh.refresh_table(spark, str(path), f"{database}.t", schema, multi_line=True)
    assert rows(loaded) == [(1, "a\nb"), (4, 'e "f"')] and bad.count() == 2


# ---- split publishing and observed gates


def write_lines(tmp_path, name, lines):
    path = tmp_path / name
    path.write_text("n,Symbol\n" + "\n".join(lines) + "\n")
    return str(path)


SCHEMA = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("Symbol", T.StringType())])


def jobs_of(spark, run):
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        out = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))


def test_one_job_writes_counts_and_gates(spark, tmp_path, database):
    path = write_lines(tmp_path, "a.csv", ["1,A", "x,B", "3,", "4,D"])
    gate = not_null_gate(["n"])
    (loaded, bad, counts), jobs = jobs_of(spark, lambda: refresh.refresh_counted(spark, path, f"{database}.t", SCHEMA, [gate]))
    assert counts == {"rows": 4, "rejects": 1, "rows.n not_null": 0} and jobs == 1
    assert rows(loaded) == [(1, "A"), (3, None), (4, "D")] and rows(bad.select("_reason")) == [("malformed",)]
    assert len(tables.versions(spark, f"{database}.t")) == 1 and tables.versions(spark, f"{database}.t_rejects") == []


def test_refused_refresh_leaves_both_tables(spark, tmp_path, database):
    name = f"{database}.t"
    refresh.refresh_table(spark, write_lines(tmp_path, "a.csv", ["1,A", "x,B"]), name, SCHEMA)
    before = rows(spark.table(name)), rows(spark.table(f"{name}_rejects"))
    worse = write_lines(tmp_path, "b.csv", ["1,", "y,B"])
    for options in ({"gates": [not_null_gate(["Symbol"])]}, {"max_reject_share": 0.4}, {"gates": [lambda df: not_null_gate(["Symbol"])(df)]}):
        with pytest.raises(GateFailed):
            refresh.refresh_table(spark, worse, name, SCHEMA, **options)
    with pytest.raises(GateFailed, match="1 of 1 rows"):
        refresh.refresh_table(spark, write_lines(tmp_path, "c.csv", ["y,B"]), name, SCHEMA)
    assert (rows(spark.table(name)), rows(spark.table(f"{name}_rejects"))) == before
    assert len(tables.versions(spark, name)) == 1


def test_a_break_between_the_two_views_is_mended(spark, tmp_path, database, monkeypatch):
    name = f"{database}.t"
    refresh.refresh_table(spark, write_lines(tmp_path, "a.csv", ["1,A", "x,B"]), name, SCHEMA)
    plain = tables._swap

    def breaks(session, views):
        plain(session, dict(list(views.items())[:1]))
        raise RuntimeError("lost")

    monkeypatch.setattr(tables, "_swap", breaks)
    with pytest.raises(RuntimeError, match="lost"):
        refresh.refresh_table(spark, write_lines(tmp_path, "b.csv", ["2,C", "y,D", "z,E"]), name, SCHEMA)
    monkeypatch.setattr(tables, "_swap", plain)
    assert rows(spark.table(name)) == [(2, "C")] and spark.table(f"{name}_rejects").count() == 1
    # Whatever comes of the next call, its first step shows both from one version.
    with pytest.raises(GateFailed):
        refresh.refresh_table(spark, write_lines(tmp_path, "c.csv", ["q,Q"]), name, SCHEMA)
    assert rows(spark.table(name)) == [(2, "C")] and spark.table(f"{name}_rejects").count() == 2
    assert not tables.mend_split(spark, name, f"{name}_rejects", ["_record", "_reason"])


def test_old_rejects_versions_and_appends(spark, tmp_path, database):
    name = f"{database}.t"
    tables.publish(spark.createDataFrame([("old", "old")], "_record string, _reason string"), f"{name}_rejects")
    tables.publish(spark.createDataFrame([(9, "Z")], SCHEMA), name)
    refresh.refresh_table(spark, write_lines(tmp_path, "a.csv", ["1,A", "x,B"]), name, SCHEMA)
    assert rows(spark.table(f"{name}_rejects").select("_reason")) == [("malformed",)]
    assert tables.versions(spark, f"{name}_rejects") == []
    tables.append(spark.createDataFrame([(5, "E")], SCHEMA), name)
    assert rows(spark.table(name)) == [(1, "A"), (5, "E")] and spark.table(f"{name}_rejects").count() == 1


def test_counts_of_a_write_are_those_of_its_rows(spark, tmp_path):
    df = spark.range(1000).withColumn("gap", F.when(F.col("id") % 7 > 0, F.col("id")))
    path = str(tmp_path / "out")
    counts = counted_write(df, {"n": F.count(F.lit(1)), "gaps": F.count_if(F.col("gap").isNull())}, lambda d: d.write.parquet(path))
    assert counts == {"n": 1000, "gaps": 143} and spark.read.parquet(path).count() == 1000


# ---- stored bars


def test_window_over_stored_bars_has_no_exchange(spark, database):
    bars = spark.range(4_000).selectExpr("id % 37 as s", "timestamp_seconds(id * 60) as d", "double(id % 11 + 1) as c", "id")
    for half in (0, 1):
        stored = bar_store.store_bars(bars.filter(F.col("id") % 2 == half), f"{database}.bars", ["s"], ["d"], buckets=4)
    scored = forward_returns(stored, ["s"], "d", "c", "id", slice_rows=None)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Window [") == 1
    assert rows(scored) == rows(forward_returns(bars, ["s"], "d", "c", "id", slice_rows=None))
    # One file a bucket and call; a long series may be spread over more.
    assert len(stored.inputFiles()) <= 8
    spread = bar_store.store_bars(bars.withColumn("s", F.lit(1)), f"{database}.spread", ["s"], ["d"], buckets=4, spread=6)
    assert len(spread.inputFiles()) > 2 and spread.count() == 4_000


# ---- bars kept up to date


def test_bars_after_each_run_are_those_of_all_ticks(spark, tmp_path):
    rng = random.Random(5)
    base = dt.datetime(2024, 3, 9, 20)
    ticks = [
        (i, None if rng.random() < 0.02 else base + dt.timedelta(minutes=rng.randrange(60 * 40)), rng.choice("abc"),
         None if rng.random() < 0.05 else float(rng.randrange(50)), None if rng.random() < 0.1 else rng.randrange(5))
        for i in range(600)
    ]
    schema = "id long, ts timestamp_ntz, s string, price double, size long"
    landing, store, checkpoint = (str(tmp_path / n) for n in ("landing", "store", "checkpoint"))
    seen = []
    for run in range(4):
        part = ticks[run * 150:(run + 1) * 150]
        if run == 2:
            part = []
        if part:
            spark.createDataFrame(part, schema).coalesce(2).write.mode("append").parquet(landing)
        seen += part
        bar_updates.update_hourly_bars(
            spark, landing, schema, store, checkpoint, "s", "ts", "price", "size", "id", source_format="parquet", files_per_batch=1
        )
        want = bar_ops.hourly_bars(spark.createDataFrame(seen, schema), "s", "ts", "price", "size", "id")
        assert rows(bar_updates.read_hourly_bars(spark, store).select(want.columns)) == rows(want)


def test_a_run_taken_twice_counts_once(spark, tmp_path):
    schema = "id long, ts timestamp_ntz, s string, price double"
    days = [dt.datetime(2024, 1, d, 10, 5) for d in (1, 2)]
    ticks = [spark.createDataFrame([(n, day, "a", float(n)) for n, day in enumerate(days)], schema), spark.createDataFrame([(7, days[1], "a", 9.0)], schema)]
    store = str(tmp_path / "store")
    states = [bar_ops.bar_states(t, "s", "ts", "price", tiebreak="id") for t in ticks]
    bar_updates.merge_states(states[0], store, 0)
    first = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "store" / "bars" / "day=2024-01-01").iterdir()}
    for _ in range(2):
        bar_updates.merge_states(states[1], store, 1)
    want = bar_ops.hourly_bars(ticks[0].union(ticks[1]), "s", "ts", "price", tiebreak="id")
    assert rows(bar_updates.read_hourly_bars(spark, store).select(want.columns)) == rows(want)
    # The day the second run did not touch was not written again.
    assert {f.name: f.stat().st_mtime_ns for f in (tmp_path / "store" / "bars" / "day=2024-01-01").iterdir()} == first


# ---- medians


@pytest.mark.parametrize("p", [0.0, 0.3, 0.5, 1.0])
def test_narrowing_rounds_lead_to_the_same_percentiles(spark, monkeypatch, p):
    rounds = []
    plain = quantiles.stage
    monkeypatch.setattr(quantiles, "stage", lambda df, label: rounds.append(label) or plain(df, label))
    monkeypatch.setattr(quantiles, "NEAR_ROWS", 3)
    monkeypatch.setattr(quantiles, "GRID", [0.0, 0.5, 1.0])
    monkeypatch.setattr(quantiles, "SKETCH_ACCURACY", 10)
    rng = random.Random(8)
    inf, nan = float("inf"), float("nan")
    values = {
        "many": [rng.gauss(0, 5) for _ in range(700)], "heavy": [4.25] * 600 + [rng.random() for _ in range(100)],
        "odd": [nan, nan, inf, -inf, inf] * 30 + [1.0, 2.0, -0.0, 0.0], "few": [1.0, 2.0], None: [float(rng.randrange(4)) for _ in range(200)],
        "null": [None],
    }
    df = stage(spark.createDataFrame([(g, v) for g, own in values.items() for v in own], "g string, v double"), "values")
    got = {r.g: repr(r.v_median) for r in quantiles.percentiles_spread(df, ["g"], ["v"], p).collect()}
    assert got == {r.g: repr(r.v_median) for r in quantiles.percentiles_builtin(df, ["g"], ["v"], p).collect()}
    assert p in (0.0, 1.0) or rounds.count("wide") >= 4


# ---- views


def test_a_persistent_view_is_seen_by_another_session(spark, database):
    tables.publish(spark.range(5).toDF("n"), f"{database}.base")
    view = f"{database}.odd"
    tables.persistent_view(spark, view, f"SELECT n FROM {database}.base WHERE n % 2 = 1")
    assert rows(spark.newSession().table(view)) == [(1,), (3,)]
    tables.publish(spark.range(9).toDF("n"), f"{database}.base")
    assert spark.newSession().table(view).count() == 4
    spark.range(2).createOrReplaceTempView("passing")
    with pytest.raises(Exception, match="(?i)temp"):
        tables.persistent_view(spark, f"{database}.bad", "SELECT * FROM passing")
    spark.range(2).write.saveAsTable(f"{database}.plain")
    with pytest.raises(ValueError, match="is a table"):
        tables.persistent_view(spark, f"{database}.plain", "SELECT 1")
