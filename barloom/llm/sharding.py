"""Sharding by longest-processing-time scheduling: groups that must stay together, largest first, each to the
shard that holds least.

Groups of one size are interchangeable, so the schedule works on sizes and how many groups have each. There are at
most ``sqrt(2 * total bytes)`` different sizes, as their sum cannot be less than 1 + 2 + 3 ...: that is all the driver
sees. Many groups of one size are dealt in one step, with the outcome that the heap has one by one.

What a group gets is decided by its place among those of its size. Places, and the slots inside a shard,
are numbered in parallel: by the place inside a hash bucket and a running sum over the buckets' counts.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.llm.common import text_of
from barloom.session import stage

SHARDS = 24
#: Bytes a document takes besides its text.
OVERHEAD = 8
#: Rows numbered in one sort.
PER_TASK = 50_000
#: Groups of more rows than one in so many are looked up apart: there are at most as many such groups.
HOT_SHARE = 1_000
#: From so many groups of one size on they are dealt in one step.
ONE_BY_ONE = 256


def schedule(sizes: Sequence[int], counts: Sequence[int], shards: int) -> list[list[int]]:
    """How many of the ``counts[i]`` groups of ``sizes[i]`` each shard gets; sizes descend. Of equally loaded
    shards the one with the smallest number is next."""
    heap = [(0, s) for s in range(shards)]
    out = []
    for size, n in zip(sizes, counts):
        given = [0] * shards
        if n > ONE_BY_ONE:
            heap, n = _deal(heap, size, n, given)
        for _ in range(n):
            load, s = heap[0]
            heapq.heapreplace(heap, (load + size, s))
            given[s] += 1
        out.append(given)
    return out


def _deal(heap: list[tuple[int, int]], size: int, n: int, given: list[int]) -> tuple[list[tuple[int, int]], int]:
    """Deals groups of one size as long as no shard passes a common level, and tells how many are left.

    One by one, a shard gets its next group when its load is the least; so below any level each gets as many as
    start below it, and the order only matters for the few at the level itself.
    """
    loads = [load for load, _ in heap]

    def below(level: int) -> int:
        return sum(-((load - level) // size) for load in loads if load < level)

    low, high = min(loads), max(loads) + size * n
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if below(middle) <= n else (low, middle)
    dealt = []
    for load, s in heap:
        k = -((load - low) // size) if load < low else 0
        given[s] += k
        n -= k
        dealt.append((load + k * size, s))
    heapq.heapify(dealt)
    return dealt, n


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, rows: int, beside: DataFrame | None = None) -> DataFrame:
    """``df``, a stored table of ``rows`` rows, with ``name``: 0, 1, 2 ... inside each key, in no order of meaning.

    ``order`` tells the rows of a key apart (rows it does not tell apart are alike). A key may hold any share of the
    rows: it is numbered in hash buckets of about ``PER_TASK`` rows. ``beside`` has columns by the keys that are
    joined to the buckets' counts, not to the rows.
    """
    bucketed = df.withColumn("_bucket", F.pmod(F.xxhash64(*order, F.lit(5)), F.lit(rows // PER_TASK + 1)).cast("int"))
    counts = bucketed.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(ahead), F.lit(0))).drop("_n")
    if beside is not None:
        offsets = offsets.join(beside, list(keys))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    local = bucketed.withColumn("_local", F.row_number().over(inside) - 1)
    return local.join(offsets, [*keys, "_bucket"]).withColumn(name, (F.col("_before") + F.col("_local")).cast("long")).drop("_bucket", "_before", "_local")


def _schedule_table(spark: SparkSession, groups: DataFrame, shards: int) -> DataFrame:
    """``_total``, ``_starts``, ``_shards``: of the groups of a size, from the place ``_starts[i]`` on to ``_shards[i]``."""
    sizes = groups.groupBy("_total").agg(F.count("*").alias("n")).toArrow()
    totals, counts = (sizes.column(c).to_numpy().astype(np.int64) for c in ("_total", "n"))
    order = np.argsort(-totals, kind="stable")
    given = schedule(totals[order].tolist(), counts[order].tolist(), shards)
    starts, to = [], []
    for row in given:
        at = np.cumsum([0, *row])
        mine = [s for s in range(shards) if row[s]]
        starts.append([int(at[s]) for s in mine])
        to.append(mine)
    table = pa.table({"_total": pa.array(totals[order]), "_starts": pa.array(starts, pa.list_(pa.int64())), "_shards": pa.array(to, pa.list_(pa.int32()))})
    return stage(spark.createDataFrame(table), "schedule")


def placed(df: DataFrame, shards: int, text: str, id_col: str, overhead: int) -> tuple[DataFrame, DataFrame]:
    """Stored: the rows (``_id``, ``_size``, ``_crc``, ``_digest``), and the groups (``_digest``, ``_members``, ``_shard``)."""
    body = text_of(text)
    size = (F.octet_length(body) + overhead).cast("long")
    rows = stage(df.select(
        F.col(f"`{id_col}`").alias("_id"), size.alias("_size"), F.crc32(body.cast("binary")).alias("_crc"), F.unhex(F.sha2(body, 256)).alias("_digest")
    ), "sized")
    groups = stage(rows.groupBy("_digest").agg(F.sum("_size").alias("_total"), F.count("*").alias("_members")), "groups")
    deal = _schedule_table(df.sparkSession, groups, shards)
    ranked = numbered(groups, ["_total"], ["_digest"], "_place", groups.count(), deal)
    at = F.size(F.filter("_starts", lambda s: s <= F.col("_place"))) - 1
    return rows, stage(ranked.select("_digest", "_members", F.get("_shards", at).alias("_shard")), "dealt")


def by_digest(rows: DataFrame, groups: DataFrame, n_rows: int) -> DataFrame:
    """``rows`` with ``_shard``. The few groups that hold many rows are joined by themselves, the size of that
    table being bounded; all others cannot make a task large."""
    many = F.col("_members") > n_rows // HOT_SHARE + HOT_SHARE
    hot, rest = groups.filter(many).select("_digest", "_shard"), groups.filter(~many).select("_digest", "_shard")
    hot = F.broadcast(stage(hot, "hot"))
    return rows.join(hot, "_digest").unionByName(rows.join(hot, "_digest", "left_anti").join(rest.hint("merge"), "_digest"))


def assign(df: DataFrame, shards: int = SHARDS, text: str = "text", id_col: str = "doc_id", overhead: int = OVERHEAD) -> DataFrame:
    """One row per input row: id, ``size`` (UTF-8 bytes and ``overhead``), ``text_crc32``, ``shard`` and ``slot``
    (gapless from 0 in each shard).

    Equal texts are one group and share a shard; null text counts as empty. The shards' sums of sizes are those of
    longest-processing-time scheduling of the groups. Null and repeated ids stay as they are, equal rows get
    different slots. Empty input: no rows.
    """
    rows, groups = placed(df, shards, text, id_col, overhead)
    n = rows.count()
    dealt = stage(by_digest(rows, groups, n), "placed")
    out = numbered(dealt, ["_shard"], ["_id", "_digest"], "slot", n)
    return out.select(F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), F.col("_shard").alias("shard"), "slot")


def write_shards(df: DataFrame, path: str, shards: int = SHARDS, text: str = "text", id_col: str = "doc_id", overhead: int = OVERHEAD) -> str:
    """The rows of ``df`` as Parquet, a folder for each shard, columns unchanged. A shard is written by as many tasks
    as its size needs. Returns the name of the folders' column: ``_shard``, longer if ``df`` has one of that name."""
    rows, groups = placed(df, shards, text, id_col, overhead)
    packed = df.select(F.struct("*").alias("_row"), F.unhex(F.sha2(text_of(text), 256)).alias("_digest"))
    found = by_digest(packed, groups, rows.count())
    name = "_shard"
    while name in df.columns:
        name = f"_{name}"
    found.select("_row.*", F.col("_shard").alias(name)).hint("rebalance", name).write.mode("overwrite").partitionBy(name).parquet(path)
    return name
