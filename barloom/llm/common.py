"""What several operators share: row keys, row filters, graph components, bounded samples.

Conventions of the whole subpackage
-----------------------------------
* An operator takes a DataFrame and the *names* of its columns. It looks at these columns only, under
  internal names, so extra columns may be called anything.
* Reports have one row per input row, in no particular order, with the id as it came in. An id may be
  null or repeated; "the smallest id" passes over nulls and is null only if there is nothing else.
* Filters return the input's columns unchanged.
* NULL text counts as empty text.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.session import stage

#: White space of the word rules, fixed by the contracts: blank and \\t \\n \\v \\f \\r.
BLANKS = "\x20\x09-\x0d"

#: Bits of a bitmap for each fingerprint, and the most there are (32 MiB).
BITS_EACH = 16
MOST_BITS = 1 << 28
#: Bits of a row of the bitmap, as Spark's bitmap functions have it.
ROW_BITS = 1 << 15


def text_of(column: str) -> Column:
    """The text column as text, NULL as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_id``, ``_text`` and ``_key``, a hash of the text: a row is known by (``_id``, ``_key``)."""
    text = text_of(text_col)
    return df.select(F.col(f"`{id_col}`").alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_key"))


def without(df: DataFrame, gone: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``df`` without the rows whose (``_id``, ``_key``) is in ``gone``; columns unchanged."""
    return _matched(df, gone, id_col, text_col, "left_anti")


def only(df: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``df`` whose (``_id``, ``_key``) is in ``wanted``; columns unchanged."""
    return _matched(df, wanted, id_col, text_col, "left_semi")


def _matched(df: DataFrame, rows: DataFrame, id_col: str, text_col: str, how: str) -> DataFrame:
    packed = df.select(
        F.struct("*").alias("_row"), F.col(f"`{id_col}`").alias("_own_id"), F.xxhash64(text_of(text_col)).alias("_own_key")
    )
    condition = F.col("_own_id").eqNullSafe(F.col("_id")) & (F.col("_own_key") == F.col("_key"))
    return packed.join(rows.select("_id", "_key").hint("merge"), condition, how).select("_row.*")


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root``: every node of ``edges`` (``a``, ``b``, both long) with the smallest node it reaches.

    Stars are hung over again and again: each node passes its larger neighbours to its smallest one, then
    its smaller neighbours likewise, until nothing moves. The edge set never grows, a round costs a few
    shuffles, and the number of rounds is about the logarithm of the longest path. Each round is a stored
    table, so a lost executor costs one round at most. Self-links count as nodes. No links: no rows.
    """
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    loops = links.filter("a = b").select(F.col("a").alias("node"))
    links = stage(links.filter("a <> b").distinct(), "links")
    seen = _mark(links)
    while True:
        links = stage(_small_star(_large_star(links)), "links")
        now = _mark(links)
        if now == seen:
            break
        seen = now
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    nodes = roots.select("node").union(roots.select("root")).union(loops).distinct()
    return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))


class Bitmap:
    """Two bits a fingerprint."""

    def __init__(self, content: bytes, bits: int):
        self.content, self.bits = np.frombuffer(content, dtype=np.uint8), bits

    def has(self, prints: np.ndarray) -> np.ndarray:
        return self._bit(prints) & self._bit(prints >> np.uint64(32))

    def _bit(self, prints: np.ndarray) -> np.ndarray:
        at = prints & np.uint64(self.bits - 1)
        return (self.content[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bitmap_of(prints: DataFrame) -> Bitmap:
    """Built by Spark in rows of 4 KiB; the driver and each task get ``MOST_BITS`` / 8 bytes at most."""
    bits = ROW_BITS
    while bits < min(MOST_BITS, BITS_EACH * prints.count()):
        bits *= 2
    both = prints.select(F.explode(F.array(F.col("fp"), F.shiftrightunsigned("fp", 32))).alias("at"))
    places = both.select(F.pmod("at", F.lit(bits)).alias("at"))
    rows = places.groupBy(F.floor(F.col("at") / ROW_BITS).cast("int").alias("row")).agg(
        F.bitmap_construct_agg(F.col("at") % ROW_BITS).alias("content")
    )
    content = bytearray(bits // 8)
    size = ROW_BITS // 8
    for row in rows.collect():
        content[row["row"] * size:(row["row"] + 1) * size] = row["content"]
    return Bitmap(bytes(content), bits)


def marked(print_: Column, known: Bitmap) -> Column:
    """Whether a fingerprint (long) is in ``known``, or looks so by chance. NULL is not."""

    @F.arrow_udf("boolean")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for prints in batches:
            found = known.has(prints.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64))
            yield pa.array(found & prints.is_valid().to_numpy(zero_copy_only=False))

    return run(print_)


def release_memory() -> None:
    """Gives freed memory back to the system. Python workers live on from task to task, and what one
    task's blocks took would otherwise stay with the worker while others need it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _mark(links: DataFrame) -> tuple:
    """Tells one edge set from another: number of rows and a sum of hashes."""
    hashed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(links.agg(F.count("*"), F.sum(hashed)).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Each node u links its larger neighbours to the smallest of u and all its neighbours."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    larger = links.select(F.col("b").alias("u"), F.col("a").alias("v"))
    return larger.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node u links itself and its smaller neighbours to the smallest of these."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()
