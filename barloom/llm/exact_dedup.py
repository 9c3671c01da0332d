"""Exact dedup by composable polynomial fingerprints, checked by a chunkwise streaming comparison.

The fingerprint of a byte string is its polynomial hash under two primes. Hashes compose: the hash of
``x + y`` is ``hash(x) * base**len(y) + hash(y)``. So a huge text is cut into chunks that are hashed in
parallel tasks, each chunk's hash is shifted by the number of bytes behind it, and the shifted hashes add
up in any order: a sum that combines on the map side.

Equal fingerprints (and lengths) only nominate. The rows of a group stream past the group's first row,
chunk by chunk; a row that differs is grouped again with the others that differ, until none is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import keyed, only, release_memory, text_of, without
from barloom.session import stage

#: Two primes below 2^31 and a base for each: products stay below 2^63.
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1664525)
#: Bytes hashed at a time, and bytes from which a text is hashed by several tasks.
CHUNK = 1 << 16
HUGE = 1 << 22
#: Bytes of texts compared with one copy of their group's first text; at least this many texts.
SHARE_BYTES = 1 << 19
SHARE_TEXTS = 16

WHITE = bytes.maketrans(b"\t\n\v\f\r", b"     ")


def normalised(text: str) -> bytes:
    """UTF-8 with each run of white space as one space."""
    data = text.encode("utf-8", "replace").translate(WHITE)
    while b"  " in data:
        data = data.replace(b"  ", b" ")
    return data


def _powers(base: int, prime: int) -> np.ndarray:
    out = np.empty(CHUNK, dtype=np.int64)
    value = 1
    for i in range(CHUNK - 1, -1, -1):
        out[i] = value
        value = value * base % prime
    return out


class Polynomial:
    """Hashes of byte strings under ``primes``, by chunks that compose."""

    def __init__(self, primes: tuple[int, ...] = PRIMES):
        self.primes = primes
        self.powers = [_powers(b % p, p) for b, p in zip(BASES, primes)]
        self.over_chunk = [pow(b, CHUNK, p) for b, p in zip(BASES, primes)]

    def hash(self, data: bytes) -> list[int]:
        out = [0] * len(self.primes)
        for start in range(0, len(data), CHUNK):
            # Bytes count from 1, so leading zero bytes matter.
            chunk = np.frombuffer(data, dtype=np.uint8, offset=start, count=min(CHUNK, len(data) - start)).astype(np.int64) + 1
            for i, (prime, powers) in enumerate(zip(self.primes, self.powers)):
                shift = self.over_chunk[i] if len(chunk) == CHUNK else pow(BASES[i], len(chunk), prime)
                out[i] = (out[i] * shift + int(chunk @ powers[CHUNK - len(chunk):])) % prime
        return out

    def shifted(self, hashes: list[int], behind: int) -> list[int]:
        """The share of a chunk in a text that goes on for ``behind`` bytes."""
        return [h * pow(b, behind, p) % p for h, b, p in zip(hashes, BASES, self.primes)]


FINGERPRINT = pa.struct([("h1", pa.int64()), ("h2", pa.int64()), ("n_bytes", pa.int64()), ("digest", pa.string())])
PART = pa.schema([("_id", pa.string()), ("_key", pa.int64()), ("behind", pa.int64()), ("part", pa.binary()), ("digest", pa.string())])
GROUP = ["h1", "h2", "n_bytes"]


def _fingerprints(rows: DataFrame, primes: tuple[int, ...], digest: bool, huge: int) -> DataFrame:
    """``rows`` with ``h1``, ``h2``, ``n_bytes`` and ``digest`` (SHA-256 of the normalised text, if asked for)."""

    @F.arrow_udf("struct<h1: bigint, h2: bigint, n_bytes: bigint, digest: string>")
    def whole(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        poly = Polynomial(primes)
        for texts in batches:
            out = []
            for text in texts:
                data = normalised(text.as_py())
                h1, h2 = poly.hash(data)
                out.append({"h1": h1, "h2": h2, "n_bytes": len(data), "digest": hashlib.sha256(data).hexdigest() if digest else None})
            yield pa.array(out, type=FINGERPRINT)
        release_memory()

    size = F.octet_length("_text")
    small = rows.filter(size < huge).withColumn("_fp", whole(F.col("_text"))).select("*", "_fp.*").drop("_fp")
    large = rows.filter(size >= huge)
    hashed = _huge_fingerprints(large, primes, digest).withColumnsRenamed({"_id": "_id2", "_key": "_key2"})
    same = F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_key") == F.col("_key2"))
    return small.unionByName(large.join(hashed, same).drop("_id2", "_key2"))


def _huge_fingerprints(rows: DataFrame, primes: tuple[int, ...], digest: bool) -> DataFrame:
    """Chunks of huge texts go to tasks of their own; their shifted hashes add up."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, key, text in zip(*(column for column in batch.columns)):
                data = normalised(text.as_py())
                sha = hashlib.sha256(data).hexdigest() if digest else None
                for start in range(0, max(1, len(data)), 16 * CHUNK):
                    part = data[start:start + 16 * CHUNK]
                    behind = len(data) - start - len(part)
                    row = {"_id": i.as_py(), "_key": key.as_py(), "behind": behind, "part": part, "digest": sha}
                    yield pa.RecordBatch.from_pylist([row], schema=PART)

    @F.arrow_udf("array<bigint>")
    def share(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        poly = Polynomial(primes)
        for parts, behind in batches:
            shares = [poly.shifted(poly.hash(p.as_py()), b.as_py()) for p, b in zip(parts, behind)]
            yield pa.array(shares, type=pa.list_(pa.int64()))

    kind = rows.schema["_id"].dataType
    texts = rows.select(F.col("_id").cast("string").alias("_id"), "_key", "_text").dropDuplicates(["_id", "_key"])
    parts = texts.mapInArrow(cut, "_id string, _key long, behind long, part binary, digest string")
    parts = parts.repartition("_key", "behind")
    shares = parts.select("_id", "_key", "digest", F.length("part").alias("n"), share("part", "behind").alias("s"))
    return shares.groupBy(F.col("_id").cast(kind).alias("_id"), "_key").agg(
        *((F.sum(F.col("s")[i]) % F.lit(p)).alias(f"h{i + 1}") for i, p in enumerate(primes)),
        F.sum("n").cast("long").alias("n_bytes"), F.max("digest").alias("digest"),
    )


def _dealt(members: DataFrame) -> DataFrame:
    """Each row of the stored ``members`` in one ``share`` of its group. A group of several shares has a copy of its
    leading row, marked ``guide``, in each: one row with the group's ``keep_id``, however many have that id."""
    per_share = F.least(F.greatest(F.lit(SHARE_BYTES) / (F.col("n_bytes") + 64), F.lit(SHARE_TEXTS)), F.lit(1_000))
    shares = F.ceil(F.col("size") / per_share).cast("int")
    sized = members.withColumn("leads", F.col("_id").eqNullSafe(F.col("keep_id"))).withColumn("shares", shares)
    own = sized.withColumn("share", F.pmod(F.xxhash64("_id", "_key", "_n"), F.col("shares")).cast("int")).withColumn("guide", F.lit(False))
    # Large groups only, so these are few.
    candidates = sized.filter("leads and shares > 1")
    chosen = candidates.groupBy(*GROUP).agg(F.min("_n").alias("_n"))
    copies = candidates.join(chosen.select("_n"), "_n", "left_semi").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    return own.unionByName(copies.withColumn("guide", F.lit(True)))


def _compared(members: DataFrame, id_type: str) -> DataFrame:
    """Each row of the stored ``members`` with ``equal`` (to its group's leading row) and ``first`` (it is that row).

    Rows of a group, or of one of a large group's shares, arrive together behind the leading row; one text is held
    at a time.
    """
    key = [*GROUP, "share"]
    ordered = _dealt(members).repartition(*key).sortWithinPartitions(*key, F.desc("guide"), F.desc("leads"), "_key", "_n")
    rows = ordered.select(*key, "guide", "_id", "_key", "_n", "digest", "_text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, lead, lead_n = None, b"", None
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            equal, first = [], []
            for i in range(batch.num_rows):
                own_group = tuple(columns[k][i].as_py() for k in key)
                text, n = normalised(columns["_text"][i].as_py()), columns["_n"][i].as_py()
                if own_group != group:
                    group, lead, lead_n = own_group, text, n
                first.append(n == lead_n)
                equal.append(_same(lead, text))
            out = batch.drop_columns(["_text"]).append_column("equal", pa.array(equal)).append_column("first", pa.array(first))
            yield out.filter(pa.array([not g for g in columns["guide"].to_pylist()]))

    schema = f"h1 long, h2 long, n_bytes long, share int, guide boolean, _id {id_type}, _key long, _n long, digest string, equal boolean, first boolean"
    return rows.mapInArrow(compare, schema)


def _same(a: bytes, b: bytes) -> bool:
    """Chunk by chunk; the first that differs ends it."""
    x, y = memoryview(a), memoryview(b)
    return len(x) == len(y) and all(x[i:i + CHUNK] == y[i:i + CHUNK] for i in range(0, len(x), CHUNK))


def _decided(df: DataFrame, id_col: str, text: str, primes: tuple[int, ...], digest: bool, huge: int) -> tuple[DataFrame, DataFrame]:
    """The rows whose fingerprint is unique, and the others with ``keep_id``, ``size`` and ``kept``; both stored."""
    rows = keyed(df, id_col, text)
    id_type = rows.schema["_id"].dataType.simpleString()
    hashed = _fingerprints(rows, primes, digest, huge)
    light = stage(hashed.drop("_text"), "fingerprints")
    groups = light.groupBy(*GROUP).agg(F.min("_id").alias("keep_id"), F.count("*").alias("size"))
    open_groups = stage(groups.filter("size > 1"), "groups")
    single = light.join(open_groups.select(*GROUP), GROUP, "left_anti")
    # The texts always move: a broadcast while the groups are few would only hide the cost.
    grouped = light.join(open_groups, GROUP).dropDuplicates(["_id", "_key"]).withColumnsRenamed({"_id": "_id2", "_key": "_key2"})
    same = F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_key") == F.col("_key2"))
    texts = rows.join(grouped.hint("merge"), same).drop("_id2", "_key2")
    # A stored number tells rows apart that are alike in all else.
    members = stage(texts.withColumn("_n", F.monotonically_increasing_id()), "members")
    done = None
    while True:
        checked = stage(_compared(members, id_type), "compared")
        equal, rest = checked.filter("equal"), checked.filter("not equal")
        collided = not rest.isEmpty()
        size = open_groups
        if collided:
            others = rest.groupBy(*GROUP).agg(F.count("*").alias("others"))
            size = open_groups.join(others, GROUP, "left").withColumn("size", F.col("size") - F.coalesce("others", F.lit(0)))
        settled = equal.join(size.select(*GROUP, "keep_id", "size"), GROUP)
        settled = settled.select("_id", "_key", "digest", "keep_id", "size", F.col("first").alias("kept"))
        done = settled if done is None else done.union(settled)
        if not collided:
            return single, done
        again = rest.groupBy(*GROUP).agg(F.min("_id").alias("keep_id"), F.count("*").alias("size"))
        open_groups = stage(again, "groups")
        left = members.drop("keep_id", "size").join(rest.select("_n"), "_n", "left_semi")
        members = stage(left.join(open_groups, GROUP), "members")


def copy_report(
    df: DataFrame, text: str = "text", id_col: str = "doc_id", primes: tuple[int, int] = PRIMES, digest: bool = True, huge: int = HUGE
) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` (NULL without ``digest``).

    Texts are equal when their white-space runs, each taken as one space, and all else agree. The row with
    the smallest id stays; of several such rows exactly one. A group of null ids keeps one of them.
    Empty and null texts are equal to each other. Empty input: no rows.
    """
    single, copies = _decided(df, id_col, text, tuple(primes), digest, huge)
    one = single.select("_id", "digest", F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("size"), F.lit(True).alias("kept"))
    rows = one.unionByName(copies.drop("_key"))
    return rows.select(F.col("_id").alias(id_col), "keep_id", F.col("size").alias("group_size"), "kept", F.col("digest").alias("text_sha256"))


def drop_copies(
    df: DataFrame, text: str = "text", id_col: str = "doc_id", primes: tuple[int, int] = PRIMES, huge: int = HUGE
) -> DataFrame:
    """The rows of ``df`` that ``copy_report`` keeps, columns unchanged."""
    _, copies = _decided(df, id_col, text, tuple(primes), False, huge)
    rows = copies.groupBy("_id", "_key").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    rows = stage(rows, "copies")
    stays = without(df, rows.filter("not kept or n > 1"), id_col, text)
    # Rows that repeat id and text: one of them stays. Usually there is none.
    twice = rows.filter("kept and n > 1")
    if twice.isEmpty():
        return stays
    repeated = only(df, twice, id_col, text)
    marked = repeated.select(F.struct("*").alias("_row"), F.col(f"`{id_col}`").alias("_id"), F.xxhash64(text_of(text)).alias("_key"))
    return stays.union(marked.dropDuplicates(["_id", "_key"]).select("_row.*"))
