"""SimHash near-dedup: positional-byte inverted index with count filtering.

Two 64-bit fingerprints that differ in at most ``r`` bits differ in at most ``r`` of their 8 bytes, so they
share at least ``8 - r`` bytes position by position. The inverted index turns that minimum into lists,
each pair's shared positional bytes are tallied, pairs below the minimum are dropped, the rest verified.

A list of a single (position, byte) would hold 1/256 of all fingerprints and pairs would grow with the
square. Of five shared positions, at least three lie in the same half, so the lists are kept for the eight
triples within a half (2^24 keys each). A list longer than ``list_rows`` is dealt again by two more shared
positions (a linked pair has them), which leaves 24 free bits. Pairs are made by an equi-join of the lists
whose condition holds tally and distance, so only linked pairs come out of it, and of these no two that a
list's pivot already connects.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import components, keyed, release_memory, without
from barloom.session import stage

#: Lower-casing of A-Z alone, and the word pattern; fixed by the contract.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
SEED = 42
BYTES = 8
LIST_ROWS = 2_000


def fingerprint_of(text: str, shingle: int = 3) -> int:
    """The 64-bit fingerprint; no word gives 0, fewer words than ``shingle`` count as one shingle."""
    words = text.encode("utf-8", "replace").translate(LOWER).split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        hashes = [xxhash.xxh64_intdigest(s, SEED) for s in shingles]
    return _majority(np.array(hashes, dtype="<u8"))


def _majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes; counted in blocks, so a long text needs no large array."""
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 15):
        block = hashes[start:start + (1 << 15)].view(np.uint8).reshape(-1, BYTES)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(text: Column, shingle: int = 3) -> Column:
    """Fingerprint of each text as a (signed) long."""

    @F.arrow_udf("long")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = np.fromiter((fingerprint_of(t.as_py() or "", shingle) for t in texts), dtype=np.uint64, count=len(texts))
            yield pa.array(out.view(np.int64))
        release_memory()

    return run(text)


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _byte(fp: Column, position: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * position).bitwiseAND(F.lit(255))


def _mask(positions) -> int:
    value = sum(255 << (8 * p) for p in positions)
    return value - (1 << 64) if value >> 63 else value


def shared_bytes(a: Column, b: Column) -> Column:
    """The tally: at how many positions both fingerprints have the same byte."""
    differ = a.bitwiseXOR(b)
    return sum(((_byte(differ, p) == 0).cast("int") for p in range(BYTES)), F.lit(0))


def links(distinct: DataFrame, distance: int = 3, list_rows: int = LIST_ROWS) -> DataFrame:
    """``a``, ``b``: links between distinct ``fp`` of at most ``distance`` bits, possibly repeated, that connect
    every pair within that distance, by a link of their own or through one fingerprint linked to both.

    ``distance`` may be 0 to 3: then at least five positional bytes are shared.
    """
    if not 0 <= distance <= 3:
        raise ValueError("the index guarantees distances of 0 to 3")
    halves = [t for half in (range(0, 4), range(4, 8)) for t in combinations(half, 3)]
    listed = _listed(_postings(distinct, halves))
    long_lists = listed.filter(F.col("n") > list_rows)
    if long_lists.isEmpty():
        return _pairs(listed, distance)
    finer = _listed(_postings(long_lists.select("fp").distinct(), list(combinations(range(BYTES), 5))))
    return _pairs(listed.filter(F.col("n") <= list_rows), distance).union(_pairs(finer, distance))


def _postings(distinct: DataFrame, lists: list[tuple[int, ...]]) -> DataFrame:
    """One row per fingerprint and list: the list's number and the fingerprint's bytes at its positions."""
    keys = F.array(*(F.col("fp").bitwiseAND(F.lit(_mask(p))) for p in lists))
    return distinct.select("fp", F.posexplode(keys).alias("list", "bytes"))


def _listed(postings: DataFrame) -> DataFrame:
    """The postings of lists with more than one fingerprint, with the list's length and its ``pivot``; stored."""
    lists = postings.groupBy("list", "bytes").agg(F.count("*").alias("n"), F.min("fp").alias("pivot")).filter("n > 1")
    return stage(postings.join(stage(lists, "lists"), ["list", "bytes"]), "postings")


def _linked(a: Column, b: Column, distance: int) -> Column:
    return (shared_bytes(a, b) >= BYTES - distance) & (F.bit_count(a.bitwiseXOR(b)) <= distance)


def _pairs(listed: DataFrame, distance: int) -> DataFrame:
    """Links of each list. Two fingerprints that are both linked to the pivot need no link of their own, so a
    dense group gives about as many links as it has members."""
    marked = listed.withColumn("near", _linked(F.col("fp"), F.col("pivot"), distance))
    hung = marked.filter(F.col("near") & (F.col("fp") != F.col("pivot"))).select(F.col("pivot").alias("a"), F.col("fp").alias("b"))
    left = marked.select("list", "bytes", F.col("fp").alias("a"), F.col("near").alias("near_a"))
    right = marked.select(F.col("list").alias("list2"), F.col("bytes").alias("bytes2"), F.col("fp").alias("b"), F.col("near").alias("near_b"))
    a, b = F.col("a"), F.col("b")
    same = (F.col("list") == F.col("list2")) & (F.col("bytes") == F.col("bytes2"))
    apart = left.join(right, same & (a < b) & ~(F.col("near_a") & F.col("near_b")) & _linked(a, b, distance))
    return hung.union(apart.select("a", "b"))


def near_groups(
    df: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = 3, distance: int = 3, list_rows: int = LIST_ROWS
) -> DataFrame:
    """One row per input row: id, ``fp``, ``component_id``.

    ``component_id`` is the smallest id reachable over links of at most ``distance`` bits, the row's own
    included. Equal fingerprints, that of empty texts (0) included, are one node with their smallest id.
    Empty input: no rows.
    """
    rows, label = _grouped(keyed(df, id_col, text), shingle, distance, list_rows)
    return rows.join(label, "fp").select(F.col("_id").alias(id_col), "fp", "component_id")


def _grouped(rows: DataFrame, shingle: int, distance: int, list_rows: int) -> tuple[DataFrame, DataFrame]:
    rows = stage(rows.select("_id", "_key", fingerprints(F.col("_text"), shingle).alias("fp")), "fingerprints")
    nodes = stage(rows.groupBy("fp").agg(F.min("_id").alias("first_id")), "nodes")
    edges = stage(links(nodes.select("fp"), distance, list_rows).distinct(), "edges")
    roots = stage(components(edges), "components").withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = stage(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "smallest")
    return rows, stage(rooted.join(smallest, "root").select("fp", "root", "component_id"), "labels")


def drop_near_copies(
    df: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = 3, distance: int = 3, list_rows: int = LIST_ROWS
) -> DataFrame:
    """The rows of ``df`` that stay, one document of each group: that with the smallest id.

    Several texts under that id: the one with the smallest text hash stays. Rows that repeat id and text
    are one document and stay or go together. A group of null ids alone keeps one of its texts.
    """
    rows, label = _grouped(keyed(df, id_col, text), shingle, distance, list_rows)
    placed = rows.join(label, "fp").select("_id", "_key", "root", "component_id")
    named = F.col("_id").eqNullSafe(F.col("component_id"))
    chosen = stage(placed.filter(named).groupBy("root").agg(F.min("_key").alias("chosen")), "chosen")
    verdict = placed.join(chosen, "root")
    stays = named & (F.col("_key") == F.col("chosen"))
    return without(df, stage(verdict.filter(~stays).select("_id", "_key").distinct(), "dropped"), id_col, text)
