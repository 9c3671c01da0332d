"""Interpolated percentiles (``PERCENTILE_CONT``) of any number of rows.

Three ways, same definition: the built-in aggregate keeps every distinct value of a group in one
task, so it is used up to a counted number of rows; above that the exact rank is found with two
spread-out passes; and a sketch is there for those who accept an approximation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.session import stage

#: Up to this many input rows one task may hold the distinct values of a group.
IN_MEMORY_ROWS = 1_000_000

#: Sketch accuracy, which bounds the size of every task's sketch however many rows there are.
SKETCH_ACCURACY = 10_000

#: At most so many rows around the wanted rank are put in order per group and column, and the fences of a
#: round that makes them fewer.
NEAR_ROWS = 4_000_000
GRID = [i / 32 for i in range(33)]


def percentiles_builtin(
    df: DataFrame, by: Sequence[str], values: Sequence[str], p: float = 0.5, suffix: str = "_median"
) -> DataFrame:
    return df.groupBy(*by).agg(*[F.percentile(v, p).alias(v + suffix) for v in values])


def percentiles_approx(
    df: DataFrame,
    by: Sequence[str],
    values: Sequence[str],
    p: float = 0.5,
    suffix: str = "_median",
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    return df.groupBy(*by).agg(*[F.percentile_approx(v, p, accuracy).alias(v + suffix) for v in values])


def percentiles_spread(
    staged: DataFrame, by: Sequence[str], values: Sequence[str], p: float = 0.5, suffix: str = "_median"
) -> DataFrame:
    """Exact percentiles without gathering a group.

    A mergeable sketch of constant size proposes fences, the rows between and on the fences are counted exactly,
    and the counts tell which part holds the wanted rank. Rounds go on inside that part, all groups and columns at
    once, until it has at most ``NEAR_ROWS`` rows or is a single value; then its distinct values are put in order.
    The first fences stand close to the rank and leave a few rows in ten thousand, each further round leaves
    one part in ``len(GRID)``. The counts decide, so the answer does not depend on how good the sketch was.
    Reads its input twice, and twice more a further round: give it a stored table.
    """
    by = list(by)
    long = staged.unpivot(by, list(values), "__of", "__v").filter(F.col("__v").isNotNull())
    keys = [*by, "__of"]
    margin = 2.0 / SKETCH_ACCURACY
    close = [max(p - margin, 0.0), min(p + margin, 1.0)]
    sketch = F.percentile_approx("__v", close, SKETCH_ACCURACY)
    # One row per group and column; stored, so that the joins see how small it is and broadcast it.
    fences = stage(long.groupBy(*keys).agg(F.array_sort(F.array_distinct(sketch)).alias("__f")), "fences")
    # A few rows for each group and column, as all that follows.
    counts = stage(_parts(_match(long, fences, keys), keys), "parts")
    rank = (F.sum("__c") - 1) * F.lit(p)
    wanted = counts.groupBy(*keys).agg(rank.alias("__rank"))
    ranks = F.explode(F.array_distinct(F.array(F.floor("__rank"), F.ceil("__rank")))).alias("__r")
    wanted = wanted.select(*keys, (F.col("__rank") - F.floor("__rank")).alias("__w"), ranks)
    targets = _part_of_rank(_match(wanted, counts, keys), [*keys, "__r", "__w"], F.lit(None), F.lit(None), F.lit(0))
    targets = stage(targets, "targets")
    while True:
        single = F.coalesce(F.col("__lo") == F.col("__hi"), F.lit(False))
        wide = stage(targets.filter((F.col("__n") > NEAR_ROWS) & ~single), "wide")
        if wide.isEmpty():
            break
        span = [*keys, "__r", "__w", "__lo", "__hi", "__below"]
        inside = _match(long, wide, keys).filter(_inside())
        sketch = F.percentile_approx("__v", GRID, SKETCH_ACCURACY)
        fences = stage(inside.groupBy(*keys, "__r").agg(F.array_sort(F.array_distinct(sketch)).alias("__f")), "fences")
        fenced = _match(wide.select(*span), fences, [*keys, "__r"])
        counts = _parts(_match(long, fenced, keys).filter(_inside()), span)
        narrowed = _part_of_rank(counts, [*keys, "__r", "__w"], F.col("__lo"), F.col("__hi"), F.col("__below"))
        rest = targets.join(wide.select(*[F.col(k).alias(f"__j{i}") for i, k in enumerate([*keys, "__r"])]), _same([*keys, "__r"]), "left_anti")
        targets = stage(rest.unionByName(narrowed), "targets")
    near = (
        _match(long, targets, keys)
        .filter(_inside())
        .groupBy(*keys, "__r", "__w", "__below", "__v")
        .agg(F.count(F.lit(1)).alias("__c"))
    )
    ordered = Window.partitionBy(*keys, "__r").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    picked = (
        near.withColumn("__upto", F.col("__below") + F.sum("__c").over(ordered))
        .filter(F.col("__upto") > F.col("__r"))
        .groupBy(*keys, "__r", "__w")
        .agg(F.min("__v").alias("__v"))
        .groupBy(*keys)
        .agg(F.min_by("__v", "__r").alias("__v1"), F.max_by("__v", "__r").alias("__v2"), F.first("__w").alias("__w"))
        # As the built-in aggregate: equal neighbours, or a rank that is one, are not weighted (inf * 0).
        .withColumn(
            "__q",
            F.when((F.col("__w") == 0) | (F.col("__v1") == F.col("__v2")), F.col("__v1"))
            .otherwise((1 - F.col("__w")) * F.col("__v1") + F.col("__w") * F.col("__v2")),
        )
    )
    result = picked.groupBy(*by).pivot("__of", list(values)).agg(F.max("__q"))
    result = result.select(*by, *[F.col(v).alias(v + suffix) for v in values])
    # A group whose values are all NULL still has a row, as with the aggregate.
    groups = staged.select(*by).distinct()
    return _match(groups, result, by, "left").select(*by, *[v + suffix for v in values])


def _inside() -> Column:
    """Whether ``__v`` lies in its part: a single value, or what lies strictly between two; NULL is no end."""
    v, lo, hi = F.col("__v"), F.col("__lo"), F.col("__hi")
    between = (lo.isNull() | (v > lo)) & (hi.isNull() | (v < hi))
    return F.when(lo == hi, v == lo).otherwise(between)


def _parts(fenced: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of each part that the sorted fences ``__f`` make: odd parts are the fences themselves, even ones
    lie between two. Combined before the shuffle."""
    below = F.size(F.filter("__f", lambda f: f < F.col("__v")))
    on = F.exists("__f", lambda f: f == F.col("__v")).cast("int")
    return fenced.groupBy(*keys, "__f", (2 * below + on).alias("__part")).agg(F.count(F.lit(1)).alias("__c"))


def _part_of_rank(counts: DataFrame, keys: Sequence[str], lo: Column, hi: Column, base: Column) -> DataFrame:
    """The part that holds rank ``__r``: its ends, its rows and those below it."""
    upto = F.sum("__c").over(Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, 0))
    summed = counts.withColumn("__upto", (base + upto).cast("bigint"))
    at = F.floor(F.col("__part") / 2).cast("int")
    on = F.col("__part") % 2 == 1
    held = (F.col("__upto") > F.col("__r")) & (F.col("__upto") - F.col("__c") <= F.col("__r"))
    # A part at either end of the fences goes on to the end that was known before.
    fence = F.get("__f", at)
    return summed.filter(held).select(
        *keys, F.when(at > 0, F.get("__f", at - 1)).otherwise(lo).alias("__low"), F.coalesce(fence, hi).alias("__high"), on.alias("__on"),
        fence.alias("__fence"), (F.col("__upto") - F.col("__c")).alias("__below"), F.col("__c").alias("__n"),
    ).select(
        *keys, F.when(F.col("__on"), F.col("__fence")).otherwise(F.col("__low")).alias("__lo"),
        F.when(F.col("__on"), F.col("__fence")).otherwise(F.col("__high")).alias("__hi"), "__below", "__n",
    )


def percentiles(
    staged: DataFrame,
    by: Sequence[str],
    values: Sequence[str],
    p: float = 0.5,
    suffix: str = "_median",
    in_memory_rows: int = IN_MEMORY_ROWS,
) -> DataFrame:
    """Exact percentiles of a stored table, by the way its row count allows."""
    if staged.count() <= in_memory_rows:
        return percentiles_builtin(staged, by, values, p, suffix)
    return percentiles_spread(staged, by, values, p, suffix)


def _same(keys: Sequence[str]) -> Column:
    """NULL-safe match of key columns with ``__j0, __j1, ...``."""
    condition = F.lit(True)
    for i, key in enumerate(keys):
        condition = condition & F.col(key).eqNullSafe(F.col(f"__j{i}"))
    return condition


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on NULL-safe equality of the shared key columns, keeping the left ones."""
    renamed = right
    for i, key in enumerate(keys):
        renamed = renamed.withColumnRenamed(key, f"__j{i}")
    return left.join(renamed, _same(keys), how).drop(*[f"__j{i}" for i in range(len(keys))])
