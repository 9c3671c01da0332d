"""Flagship: hand-made series, edge cases and invariants."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from barloom.operators import bands, quantiles
from barloom.operators.windows import HORIZONS, forward_returns
from barloom.plans.change_conditions import change_conditions, condition_matrix

SCHEMA = "Name string, Fullname string, Date timestamp_ntz, Close double"
START = dt.datetime(2024, 1, 1)


def hour(i):
    return START + dt.timedelta(hours=i)


def series(spark, closes, name="A", fullname="a"):
    return spark.createDataFrame([(name, fullname, hour(i), c) for i, c in enumerate(closes)], SCHEMA)


def matrix(df):
    return {r["METRIC"]: [r[b] for b in bands.BANDS] for r in df.collect()}


@pytest.mark.parametrize(
    "change, band",
    [(5.0, None), (5.5, "Change > 5"), (10.0, "Change > 5"), (10.5, "Change > 10"), (-5.0, "Change <= -5"),
     (-4.5, None), (-10.0, "Change <= -10"), (-9.5, "Change <= -5"), (None, None)],
)
def test_band_edges(spark, change, band):
    rows = bands.sharp_moves(spark.createDataFrame([(change,)], "change double")).collect()
    assert [r.condition for r in rows] == ([band] if band else [])


def test_other_band_between(spark):
    assert spark.range(1).select(bands.band_of(F.lit(0.0))).first()[0] == "Other"


def test_first_bar_has_no_change(spark):
    row = forward_returns(series(spark, [100.0])).first()
    assert row.change is None and all(row[h] is None for h in HORIZONS)


def test_horizons_are_row_offsets(spark):
    closes = [100.0 + i for i in range(60)]
    rows = forward_returns(series(spark, closes)).orderBy("Date").collect()
    for name, ahead in HORIZONS.items():
        for i, row in enumerate(rows):
            want = (closes[i + ahead] - closes[i]) / closes[i] * 100 if i + ahead < 60 else None
            assert row[name] == want


def test_one_band_and_no_bar_after(spark):
    result = matrix(change_conditions(series(spark, [100.0, 106.0])))
    assert len(result) == 8 and all(v == [None] * 4 for v in result.values())


def test_empty_input_gives_no_rows(spark):
    assert change_conditions(series(spark, [])).count() == 0
    assert change_conditions(series(spark, []), in_memory_rows=0, slice_rows=1).count() == 0


def test_null_date_sorts_last(spark):
    df = spark.createDataFrame([("A", "a", None, 3.0), ("A", "a", hour(0), 1.0), ("A", "a", hour(1), 2.0)], SCHEMA)
    got = {r.Close: r.change for r in forward_returns(df).collect()}
    assert got == {1.0: None, 2.0: 100.0, 3.0: 50.0}


def test_null_close_breaks_two_changes(spark):
    rows = forward_returns(series(spark, [100.0, None, 110.0, 121.0])).orderBy("Date").collect()
    assert [r.change for r in rows[:3]] == [None, None, None] and rows[3].change == pytest.approx(10.0)


def test_zero_close_fails_or_gives_null(spark):
    df = series(spark, [0.0, 5.0])
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        forward_returns(df).collect()
    assert [r.change for r in forward_returns(df, zero_div="null").collect()] == [None, None]


def test_same_name_other_fullname_is_another_series(spark):
    df = series(spark, [100.0, 200.0], fullname="a").union(series(spark, [1.0, 3.0], fullname="b"))
    assert sorted(r.change for r in forward_returns(df).filter("change is not null").collect()) == [100.0, 200.0]


def test_extra_columns_pass_through(spark):
    df = series(spark, [1.0, 2.0]).withColumn("Volume", F.lit(7))
    assert forward_returns(df).columns == [*df.columns, "change", *HORIZONS]


def messy(spark):
    """Bursts, repeated instants, NULL dates, NULL closes, one series far longer than the others."""
    rng = random.Random(7)
    rows, key = [], 0
    for name, count in (("long", 1500), ("mid", 300), ("tiny", 3), (None, 150)):
        for _ in range(count):
            key += 1
            at = None if rng.random() < 0.1 else hour(rng.choice([rng.random() * 1000, 500 + rng.random() / 100, 77]))
            close = None if rng.random() < 0.05 else round(rng.uniform(1, 50), 2)
            rows.append((name, "x", at, close, key))
    return spark.createDataFrame(rows, SCHEMA + ", id bigint").repartition(5)


@pytest.mark.parametrize("slice_rows", [1, 50, 400])
def test_sliced_series_equal_whole_series(spark, slice_rows):
    df = messy(spark)
    whole = forward_returns(df, tiebreak="id", slice_rows=None)
    sliced = forward_returns(df, tiebreak="id", slice_rows=slice_rows)
    assert sliced.count() == df.count()
    assert whole.exceptAll(sliced).isEmpty()


@pytest.mark.parametrize("order_type", ["timestamp", "date", "bigint", "double", "string"])
def test_sliced_series_for_other_order_types(spark, order_type):
    at = {"timestamp": "timestamp_micros(id * 3600000000)", "date": "date_add(date'2020-01-01', int(id))",
          "bigint": "id * 7", "double": "id / 3", "string": "lpad(string(id), 9, '0')"}[order_type]
    df = spark.range(500).selectExpr("'n' as Name", "'f' as Fullname", f"{at} as Date", "double(id % 17 + 1) as Close", "id")
    whole = forward_returns(df, tiebreak="id", slice_rows=None)
    assert whole.exceptAll(forward_returns(df, tiebreak="id", slice_rows=60)).isEmpty()


def test_slices_are_balanced_over_bursts(spark):
    from barloom.operators import windows

    series = ["Name", "Fullname"]
    df = messy(spark).filter("Name = 'long'")
    sizes = slice_sizes(df, series, "Date", "id", 60)
    assert sum(sizes) == 1500 and max(sizes) <= 60 * windows.RECUT_FACTOR


def slice_sizes(df, series, order, tiebreak, slice_rows):
    from barloom.operators import windows

    axes = windows._Axis(df, order, 0), windows._Axis(df, tiebreak, 1)
    dated = df.withColumn(windows.DATED, F.col(order).isNull().cast("int")).withColumns({a.skip: F.lit(0) for a in axes})
    full = windows._too_long(dated, [*series, windows.DATED], axes, slice_rows)
    sliced, keys = windows._cut(dated, series, axes, slice_rows, full)
    return [r["count"] for r in sliced.groupBy(*series, *keys).count().collect()]


STAMP = "date_format(timestamp_micros(1704067200000000 + id * 58000000), 'yyyy-MM-dd HH:mm:ss')"


@pytest.mark.parametrize(
    "order, tiebreak",
    [
        (STAMP, None),
        (f"concat(repeat('same head ', 4), {STAMP})", None),
        (f"concat(repeat('a head beyond one round, ', 5), {STAMP})", None),
        ("'one instant'", f"concat(repeat('x', 70), {STAMP})"),
        ("concat('a', repeat(char(0), int(id % 40)))", "lpad(string(id), 9, '0')"),
        (f"if(id % 3 = 0, NULL, if(id < 20000, 'é early', {STAMP}))", "id"),
    ],
    ids=["iso", "head of 40", "head of 125", "tiebreak", "NUL behind", "bursts and NULL"],
)
def test_text_orders_are_cut_to_the_wanted_length(spark, order, tiebreak):
    from barloom.operators import windows

    df = spark.range(30_000).selectExpr("'n' as s", f"{order} as d", f"{tiebreak or 'NULL'} as t", "double(id % 13 + 1) as c")
    if not tiebreak:
        df = df.drop("t")
    sizes = slice_sizes(df, ["s"], "d", tiebreak and "t", 1_000)
    assert sum(sizes) == 30_000 and max(sizes) <= 1_000 * windows.RECUT_FACTOR
    whole = forward_returns(df, ["s"], "d", "c", tiebreak and "t", slice_rows=None)
    cut = forward_returns(df, ["s"], "d", "c", tiebreak and "t", slice_rows=1_000)
    assert cut.count() == 30_000 and whole.exceptAll(cut).isEmpty()


def test_sliced_series_in_a_zone_with_clock_changes(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.range(400).selectExpr(
            "'n' as Name", "'f' as Fullname",
            "timestamp_ntz'2024-03-09 22:00:00' + make_dt_interval(0, 0, int(id)) as Date", "double(id % 17 + 1) as Close", "id",
        )
        whole = forward_returns(df, tiebreak="id", slice_rows=None)
        assert whole.exceptAll(forward_returns(df, tiebreak="id", slice_rows=30)).isEmpty()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def brute_matrix(rows):
    groups = {}
    for r in rows:
        if r.change is None or not (r.change > 5 or r.change <= -5):
            continue
        band = 0 if r.change > 10 else 1 if r.change > 5 else 2 if r.change <= -10 else 3
        groups.setdefault(band, []).append(r)
    result = {}
    for kind, fold in (("mean", statistics.fmean), ("median", statistics.median)):
        for h in HORIZONS:
            cells = []
            for band in range(4):
                values = [r[h] for r in groups.get(band, []) if r[h] is not None]
                cells.append(fold(values) if values else None)
            result[f"{h}_{kind}"] = cells
    return result


@pytest.mark.parametrize("options", [{}, {"in_memory_rows": 0}, {"in_memory_rows": 0, "slice_rows": 90}])
def test_matrix_equals_brute_force(spark, options):
    df = messy(spark)
    want = brute_matrix(forward_returns(df, tiebreak="id", slice_rows=None).collect())
    got = matrix(change_conditions(df, tiebreak="id", **options))
    assert got.keys() == want.keys()
    for metric, cells in want.items():
        assert got[metric] == pytest.approx(cells)


def test_band_counts_sum_to_the_filtered_rows(spark):
    scored = forward_returns(messy(spark), tiebreak="id")
    assert bands.band_counts(scored).agg(F.sum("n")).first()[0] == scored.filter(bands.is_sharp()).count()


def test_approximate_matrix_is_close_in_rank(spark):
    df = spark.range(20001).selectExpr("'Change > 5' as condition", "double(id) as hour_change")
    row = matrix(condition_matrix(df, ["hour_change"], exact=False))["hour_change_median"]
    assert abs(row[1] - 10000) <= 4


@pytest.mark.parametrize("how", [quantiles.percentiles_builtin, quantiles.percentiles_spread])
def test_median_of_even_count_skips_nulls(spark, how):
    df = spark.createDataFrame([("g", v) for v in (1.0, 2.0, None, 10.0, 20.0)] + [("h", None)], "g string, v double")
    assert {r.g: r.v_median for r in how(df, ["g"], ["v"]).collect()} == {"g": 6.0, "h": None}


@pytest.mark.parametrize("p", [0.0, 0.1, 0.5, 0.77, 1.0])
def test_spread_percentiles_equal_builtin(spark, p):
    rng = random.Random(3)
    rows = [(g, rng.choice([0.0, rng.gauss(0, 9), rng.expovariate(1) ** 5])) for g in ("a", "b", None) for _ in range(997)]
    rows += [("same", 4.25)] * 5000 + [("one", -1.0), ("nan", float("nan")), ("nan", 1.0), ("nan", 2.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    a = {r.g: r.v_median for r in quantiles.percentiles_builtin(df, ["g"], ["v"], p).collect()}
    b = {r.g: r.v_median for r in quantiles.percentiles_spread(df, ["g"], ["v"], p).collect()}
    assert a.keys() == b.keys()
    for g in a:
        assert b[g] == pytest.approx(a[g], nan_ok=True)


def test_spread_percentiles_do_not_rely_on_the_sketch(spark, monkeypatch):
    """With useless fences the counts still lead to the right part."""
    monkeypatch.setattr(quantiles.F, "percentile_approx", lambda *a: F.array(F.lit(1e9), F.lit(2e9)))
    df = spark.range(101).selectExpr("1 as g", "double(id) as v")
    assert quantiles.percentiles_spread(df, ["g"], ["v"]).first().v_median == 50.0


def test_flagship_plan_has_one_exchange_below_the_bands(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    scored = forward_returns(df, ["user_id"], "ts", "value", "event_id", zero_div="null")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(user_id") == 1 and plan.count("Window [") == 1


def test_both_median_routes_agree_on_odd_values(spark):
    from barloom.operators.quantiles import percentiles_builtin, percentiles_spread
    from barloom.session import stage

    inf, nan = float("inf"), float("nan")
    groups = {
        "inf even": [1.0, inf, inf, inf], "inf odd": [1.0, 2.0, inf], "both": [-inf, -inf, inf, inf], "nan": [1.0, nan, nan], "ties": [0.1] * 6,
        "near": [0.1, 0.2, 0.7, 0.7], "null": [None, None], "some": [None, 3.0, 4.0, None], "one": [inf], "mixed": [nan, -inf, 5.0, None, inf],
    }
    df = stage(spark.createDataFrame([(g, v) for g, values in groups.items() for v in values], "g string, v double"))
    for p in (0.5, 0.25, 0.9):
        a, b = ({r[0]: repr(r[1]) for r in way(df, ["g"], ["v"], p).collect()} for way in (percentiles_builtin, percentiles_spread))
        assert a == b


def test_text_order_columns_are_cut(spark):
    from barloom.operators.windows import forward_returns

    rows = [("A", f"{i:07d}"[-4:] + f"{i}", float(i % 13 + 1)) for i in range(400)]
    df = spark.createDataFrame(rows, "s string, d string, c double")
    whole = forward_returns(df, ["s"], "d", "c", slice_rows=None)
    cut = forward_returns(df, ["s"], "d", "c", slice_rows=20)
    assert sorted(map(repr, cut.collect())) == sorted(map(repr, whole.collect()))
