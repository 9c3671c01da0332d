"""Row-offset window features over bar series, safe for series of any length.

``forward_returns`` is one shuffle on the series key and one sort. A series too long for one task
is cut into time slices that are sorted in parallel; only the rows next to a cut, whose offsets
reach into a neighbouring slice, are resolved in a second, tiny window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.scalars import pct_change
from barloom.session import stage

# Horizon column names and how many bars ahead each one looks.
HORIZONS = {
    "hour_change": 1,
    "i_day_change": 9,
    "three_day_change": 27,
    "weekly_change": 45,
}

SERIES = ("Name", "Fullname")

#: A series with more bars than this is split over several tasks.
SLICE_ROWS = 4_000_000

#: A slice that a burst fills to this many times the wanted length is cut again, into at least so
#: many pieces, for so many rounds.
RECUT_FACTOR = 4
RECUT_PIECES = 200
MAX_CUTS = 16

#: Numbers of six bytes that a round looks at in a text, and what a cut consists of.
TEXT_DIGITS = 4
CUT = "struct<axis: int, digit: int, lo: double, hi: double>"

DATED = "__slice"


def forward_returns(
    bars: DataFrame,
    series: Sequence[str] = SERIES,
    order: str = "Date",
    close: str = "Close",
    tiebreak: str | None = None,
    horizons: Mapping[str, int] = HORIZONS,
    zero_div: str = "error",
    slice_rows: int | None = SLICE_ROWS,
) -> DataFrame:
    """All columns of ``bars`` plus ``change`` (percent against the bar before) and one percent
    return per horizon (bars ahead).

    ``tiebreak`` must be unique within equal (series, order) values wherever these repeat.
    Finding series above ``slice_rows`` is one map-side-combined count over the key columns, run
    when this function is called; ``slice_rows=None`` skips it. Long series are read several times,
    so give stored bars.
    """
    series = list(series)
    features = _features(close, horizons, zero_div)
    ordering = [order] if tiebreak is None else [order, tiebreak]
    if slice_rows is None:
        return _over(bars, series, ordering, features)

    axes = (_Axis(bars, order, 0), _Axis(bars, tiebreak, 1))
    dated = bars.withColumn(DATED, F.col(order).isNull().cast("int")).withColumns({a.skip: F.lit(0) for a in axes})
    whole, asked = [*series, DATED], dated
    if any(a.text for a in axes):
        # Reading bytes of a text is dear: only rows of series that are too long are read so.
        long_series = stage(_longer(dated, whole, slice_rows), "long-series")
        if long_series.isEmpty():
            return _over(bars, series, ordering, features)
        asked = dated.join(long_series, _same(whole), "left_semi")
    # At most (rows / slice_rows) keys; the join strategy follows the staged size.
    long_slices = stage(_too_long(asked, whole, axes, slice_rows), "long-slices")
    if long_slices.isEmpty():
        return _over(bars, series, ordering, features)

    hot = long_slices.select(*[F.col(f"__k{i}") for i in range(len(series))]).distinct()
    same = _same(series)
    sliced, slices = _cut(dated.join(hot, same, "left_semi"), series, axes, slice_rows, long_slices)
    short = bars.join(hot, same, "left_anti")
    ahead = max([*horizons.values(), 1])
    return _over(short, series, ordering, features).unionByName(
        _over_slices(sliced, series, slices, ordering, features, ["change", *horizons], ahead)
    )


def _features(close: str, horizons: Mapping[str, int], zero_div: str):
    def add(df: DataFrame, window) -> DataFrame:
        here = F.col(close)
        # One window call per offset; the arithmetic reads the fetched prices.
        fetched = {"__prev": F.lag(here).over(window)}
        fetched |= {f"__{name}": F.lead(here, ahead).over(window) for name, ahead in horizons.items()}
        returns = {"change": pct_change("__prev", here, zero_div)}
        returns |= {name: pct_change(here, f"__{name}", zero_div) for name in horizons}
        return df.withColumns(fetched).withColumns(returns).drop(*fetched)

    return add


def _window(keys: Sequence[str], ordering: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in ordering])


def _over(df: DataFrame, keys: Sequence[str], ordering: Sequence[str], features) -> DataFrame:
    return features(df, _window(keys, ordering))


def _same(keys: Sequence[str]) -> Column:
    """NULL-safe match of key columns with ``__k0, __k1, ...``."""
    condition = F.lit(True)
    for i, key in enumerate(keys):
        condition = condition & F.col(key).eqNullSafe(F.col(f"__k{i}"))
    return condition


def _over_slices(
    sliced: DataFrame,
    series: Sequence[str],
    slices: Sequence[str],
    ordering: Sequence[str],
    features,
    returns: Sequence[str],
    ahead: int,
) -> DataFrame:
    inner = _window([*series, *slices], ordering)
    one = F.lit(1)
    marked = _over(sliced, [*series, *slices], ordering, features).withColumns(
        {
            "__at_cut": F.lag(one, 1).over(inner).isNull() | F.lead(one, ahead).over(inner).isNull(),
            "__border": F.lag(one, ahead + 1).over(inner).isNull() | F.lead(one, ahead + 1).over(inner).isNull(),
        }
    )
    # Stored, so that both parts below see the same order even where the ordering leaves ties open.
    marked = stage(marked, "slices")
    marks = ["__at_cut", "__border"]
    at_cut = F.col("__at_cut")
    inside = marked.filter(~at_cut)
    # The rows whose offsets leave their slice are its first and its last `ahead`. One row more on
    # either side of a cut puts the bar before and the next `ahead` bars of each of them in here.
    borders = marked.filter("__border").drop(*returns)
    mended = _over(borders, series, [*slices, *ordering], features).filter(at_cut)
    return inside.unionByName(mended).drop(*marks, *slices)


class _Axis:
    """A column as numbers, most significant first, that order rows as the column does.

    Most types are one number. A text is six bytes a number, ``TEXT_DIGITS`` numbers behind the bytes that its slice
    has in common as far as is known (a column of the rows), and its length, which decides between a text and
    the same text with NUL behind it.
    """

    def __init__(self, df: DataFrame, name: str | None, at: int):
        self.name, self.at, self.skip = name, at, f"__skip{at}"
        self.text = name is not None and isinstance(df.schema[name].dataType, T.StringType)
        if name is None:
            self.digits = []
        elif self.text:
            data = F.col(name).cast("binary")
            self.digits = [_six_bytes(data, F.col(self.skip) + 6 * i) for i in range(TEXT_DIGITS)]
            self.digits.append(F.octet_length(name).cast("double"))
        else:
            self.digits = [_position(df, name)]

    def stats(self) -> list[Column]:
        out = []
        for i, digit in enumerate(self.digits):
            out += [F.min(digit).alias(f"__lo{self.at}{i}"), F.max(digit).alias(f"__hi{self.at}{i}")]
        if self.text:
            out.append(F.max(self.skip).alias(f"__skipped{self.at}"))
        elif self.name is not None:
            # Exact, where the number is not.
            out.append(F.min(self.name).eqNullSafe(F.max(self.name)).alias(f"__alike{self.at}"))
        return out

    def where_to_cut(self) -> Column:
        """The first number that is not the same in the whole slice, with its span; digit -1 where texts agree
        in all numbers but go on. NULL: the values are alike, or cannot be cut."""
        ends = [(F.col(f"__lo{self.at}{i}"), F.col(f"__hi{self.at}{i}")) for i in range(len(self.digits))]
        found = [F.when(hi > lo, self._cut_at(i, lo, hi)) for i, (lo, hi) in enumerate(ends)]
        if self.text:
            _, longest = ends[-1]
            deeper = F.when(longest > F.col(f"__skipped{self.at}") + 6 * TEXT_DIGITS, self._cut_at(-1, F.lit(0.0), F.lit(1.0)))
            found.insert(-1, deeper)
        return F.coalesce(*found, F.lit(None).cast(CUT))

    def _cut_at(self, digit: int, lo: Column, hi: Column) -> Column:
        return F.struct(F.lit(self.at).alias("axis"), F.lit(digit).alias("digit"), lo.alias("lo"), hi.alias("hi")).cast(CUT)

    def alike(self) -> Column:
        return self.where_to_cut().isNull() if self.text else F.col(f"__alike{self.at}")

    def skipped(self) -> Column:
        """The bytes that the rows of a slice are then known to have in common."""
        digit = F.when(F.col("__axis") == self.at, F.col("__digit")).otherwise(0)
        more = F.when(digit < 0, TEXT_DIGITS).when(digit < TEXT_DIGITS, digit).otherwise(0) * 6
        return F.col(self.skip) + (F.coalesce(more, F.lit(0)) if self.text else 0)


def _longer(df: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """Keys of more than ``limit`` rows as ``__k0, __k1, ...``."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > limit)
    return counts.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])


def _too_long(df: DataFrame, keys: Sequence[str], axes: tuple[_Axis, _Axis], limit: int) -> DataFrame:
    """Slices above ``limit`` rows that can be cut, with the number to cut and its span: one of the order, or of
    the tiebreak where the slice is one single instant. One map-side-combined pass, numbers only."""
    order, tiebreak = axes
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *order.stats(), *tiebreak.stats())
    cut = F.coalesce(order.where_to_cut(), F.when(order.alike(), tiebreak.where_to_cut()))
    return (
        sizes.filter(F.col("__n") > limit)
        .select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__n", cut.alias("__cut"))
        .filter("__cut IS NOT NULL")
        .select("*", *[F.col(f"__cut.{c}").alias(f"__{c}") for c in ("axis", "digit", "lo", "hi")])
        .drop("__cut")
    )


def _cut(
    df: DataFrame, series: Sequence[str], axes: tuple[_Axis, _Axis], slice_rows: int, full: DataFrame
) -> tuple[DataFrame, list[str]]:
    """Add slice columns that follow the row order and hold about ``slice_rows`` rows each.

    Undated rows are apart from the start, as they come last. Every slice that is too long is cut
    into equal widths of its span, or by tiebreak if it is one single instant, and what a burst
    overfills is cut again more finely. A text is cut at the first bytes that differ in its slice, so each round
    looks behind what the slice has in common. The cuts depend on the data only, so a task that runs again
    agrees with the first run.
    """
    slices = [DATED]
    for cut_round in range(MAX_CUTS):
        pieces = F.ceil(F.col("__n") / F.lit(slice_rows))
        if cut_round:
            pieces = F.greatest(pieces, F.lit(RECUT_PIECES))
        place = F.lit(None).cast("double")
        for axis in axes:
            for i, digit in enumerate(axis.digits):
                place = F.when((F.col("__axis") == axis.at) & (F.col("__digit") == i), digit).otherwise(place)
        at = F.floor((place - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * pieces)
        # A row without a place can only be one of NULL tiebreak, which comes last as well.
        at = F.coalesce(at, pieces + 1)
        name = f"__slice{cut_round}"
        df = (
            df.join(full, _same([*series, *slices]), "left")
            .withColumn(name, F.when(F.col("__n").isNull() | (F.col("__digit") < 0), 0).otherwise(at).cast("bigint"))
            .withColumns({axis.skip: axis.skipped() for axis in axes})
            .drop(*full.columns)
        )
        slices.append(name)
        full = stage(_too_long(df, [*series, *slices], axes, slice_rows * RECUT_FACTOR), "long-slices")
        if full.isEmpty():
            break
    return df.drop(*[axis.skip for axis in axes]), slices


def _position(df: DataFrame, name: str) -> Column:
    """A number that grows with the column, for cutting its range; NULL for other types."""
    kind, value = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        if df.sparkSession.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "GMT", "Z"):
            return F.unix_micros(value.cast("timestamp")).cast("double")
        # From the parts, as a detour over a zone with clock changes is not monotone.
        seconds = F.unix_date(value.cast("date")).cast("double") * 86_400 + F.hour(value) * 3_600 + F.minute(value) * 60
        return seconds * 1e6 + F.round(F.extract(F.lit("SECOND"), value).cast("double") * 1e6)
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, T.NumericType):
        return value.cast("double")
    return F.lit(None).cast("double")


def _six_bytes(data: Column, skip: Column) -> Column:
    """Six bytes behind the first ``skip``, zeros where there are no more: a number that a double holds exactly."""
    return F.conv(F.rpad(F.hex(F.substring(data, skip + 1, F.lit(6))), 12, "0"), 16, 10).cast("double")
