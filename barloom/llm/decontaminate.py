"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact check.

For every benchmark item a document is looked at through windows of the item's number of words. A window
whose weighted word-shingle similarity to the item is ``similarity`` shares shingles with it, so only
windows around a shared shingle get a fingerprint. The fingerprints go through a multi-index: a fingerprint
within ``radius`` bits of an item's differs in at most ``radius // blocks`` bits of some block, and the
index lists the items under all values of a block within that many bits, so it misses none within the
radius. What it yields is measured bit by bit, then verified by the exact weighted similarity of the
shingles, repeats counted. Items in which a shingle repeats are found without the radius: by an index from shingle
to item, in windows that hold as many of an item's shingles as the similarity asks for.

The benchmark is a stated query set: it is read in blocks bounded by items and bytes, one pass over the documents a
block, so what a task or the driver holds does not grow with the benchmark.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import release_memory
from barloom.session import scratch_path

SHINGLE = 5
SIMILARITY = 0.8
#: Bits of 64. Texts at the similarity of 0.8 differ in 9.7 bits on average, with a deviation of 2.9.
RADIUS = 22
BLOCKS = 8
#: Items, and bytes of their texts, in the tasks at a time.
BLOCK_ITEMS = 5_000
BLOCK_BYTES = 8 << 20

WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    """Runs of letters, digits and underscores, lower-cased."""
    return WORD.findall(text.lower())


def shingles_of(words: list[str], size: int = SHINGLE) -> list[str]:
    """All shingles, repeats included; fewer words than ``size`` are one shingle, no words none."""
    if len(words) <= size:
        return [" ".join(words)] if words else []
    return list(map(" ".join, zip(*(words[i:] for i in range(size)))))


def weighted_similarity(a: list[str], b: list[str]) -> float:
    """Shared over all shingles, each as often as it occurs."""
    x, y = Counter(a), Counter(b)
    shared = sum((x & y).values())
    return shared / (len(a) + len(b) - shared) if a or b else 0.0


def sign_bits(shingles: list[str]) -> np.ndarray:
    """A row of 64 signs (1, -1) for each shingle."""
    hashes = np.array([xxhash.xxh64_intdigest(s) for s in shingles], dtype="<u8")
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32) * 2 - 1


def pack(sums: np.ndarray) -> np.ndarray:
    """Fingerprints of rows of 64 sums."""
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8").ravel()


class HammingIndex:
    """Items of one length by their fingerprint's blocks."""

    def __init__(self, fingerprints: np.ndarray, radius: int, blocks: int = BLOCKS):
        self.fingerprints, self.radius = fingerprints, radius
        width = 64 // blocks
        self.shifts = [np.uint64(width * b) for b in range(blocks)]
        self.low = np.uint64((1 << width) - 1)
        flips = [sum(1 << bit for bit in bits) for n in range(min(radius // blocks, width) + 1) for bits in combinations(range(width), n)]
        self.lists: list[dict[int, list[int]]] = []
        for shift in self.shifts:
            lists: dict[int, list[int]] = defaultdict(list)
            for item, value in enumerate(((fingerprints >> shift) & self.low).tolist()):
                for flip in flips:
                    lists[value ^ flip].append(item)
            self.lists.append(dict(lists))

    def near(self, fingerprint: np.uint64) -> list[tuple[int, int]]:
        """(item, distance) of all items within the radius."""
        found: set[int] = set()
        for shift, lists in zip(self.shifts, self.lists):
            found.update(lists.get(int((fingerprint >> shift) & self.low), ()))
        candidates = np.fromiter(found, dtype=np.int64, count=len(found))
        distance = np.bitwise_count(self.fingerprints[candidates] ^ fingerprint)
        return [(int(i), int(d)) for i, d in zip(candidates, distance) if d <= self.radius]


class Benchmark:
    """A block of items, ready to search in documents."""

    def __init__(self, items: list[tuple[str, str]], similarity: float, radius: int, shingle: int = SHINGLE):
        self.similarity, self.shingle = similarity, shingle
        self.by_length: dict[int, list[tuple[str, list[str]]]] = defaultdict(list)
        self.vocabulary: dict[str, int] = {}
        # Where a shingle repeats, half the bits of a fingerprint may hang on the few that differ.
        self.repeating: list[tuple[str, int, list[str]]] = []
        self.holders: dict[tuple[int, ...], set[int]] = defaultdict(set)
        self.repeaters: dict[tuple[int, ...], set[int]] = defaultdict(set)
        for item, text in items:
            words = words_of(text)
            if not words:
                continue
            own = shingles_of(words, shingle)
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            span = min(shingle, len(words))
            keys = {tuple(ids[i:i + span]) for i in range(len(ids) - span + 1)}
            if len(keys) < len(own):
                for key in keys:
                    self.repeaters[key].add(len(self.repeating))
                self.repeating.append((item, len(words), own))
            else:
                for key in keys:
                    self.holders[key].add(len(words))
                self.by_length[len(words)].append((item, own))
        self.index = {
            n: HammingIndex(np.concatenate([pack(sign_bits(s).sum(axis=0)[None]) for _, s in own]), radius)
            for n, own in self.by_length.items()
        }
        self.spans = sorted({len(s) for s in (*self.holders, *self.repeaters)})

    def matches(self, text: str) -> list[dict]:
        """The best window for each item found in ``text``."""
        words = words_of(text)
        hits, repeated = self._hits(words)
        best: dict[tuple[int, int], dict] = {}
        for length, positions in hits.items():
            for start, item, distance in self._near(words, length, self._runs(positions, length, len(words))):
                if best.get((length, item), {"similarity": 0.0})["similarity"] == 1.0:
                    continue
                name, own = self.by_length[length][item]
                value = weighted_similarity(shingles_of(words[start:start + length], self.shingle), own)
                # By place and not by id: ids may be null or repeated, and different texts of one id are different items.
                if value >= self.similarity and value > best.get((length, item), {"similarity": -1.0})["similarity"]:
                    best[length, item] = {"item": name, "similarity": value, "distance": distance, "start": start, "n_words": length}
        for item, positions in repeated.items():
            name, length, own = self.repeating[item]
            found = self._best_repeating(words, length, own, np.array(positions))
            if found:
                best[-1, item] = {"item": name, "n_words": length, **found}
        return list(best.values())

    def _hits(self, words: list[str]) -> tuple[dict[int, array], dict[int, array]]:
        """Where the shingles of items start: by item length, and for each item in which one repeats."""
        ids = np.array([self.vocabulary.get(w, -1) for w in words], dtype=np.int64)
        hits: dict[int, array] = defaultdict(lambda: array("q"))
        repeated: dict[int, array] = defaultdict(lambda: array("q"))
        known = np.concatenate([[0], np.cumsum(ids >= 0)])
        for span in self.spans:
            if len(ids) < span:
                break
            for at in np.nonzero(known[span:] - known[:-span] == span)[0].tolist():
                key = tuple(ids[at:at + span].tolist())
                for length in self.holders.get(key, ()):
                    if min(self.shingle, length) == span:
                        hits[length].append(at)
                for item in self.repeaters.get(key, ()):
                    if min(self.shingle, self.repeating[item][1]) == span:
                        repeated[item].append(at)
        return hits, repeated

    def _runs(self, positions: array, length: int, n_words: int) -> list[tuple[int, int]]:
        """First and last start of the runs of windows that hold a shingle at one of the ascending positions."""
        if length > n_words:
            # The text is shorter than the item: its one window is the whole text.
            return [(0, 0)]
        last = np.array(positions)
        first = np.maximum(last + min(self.shingle, length) - length, 0)
        last = np.minimum(last, n_words - length)
        return _merged(first, last)

    def _near(self, words: list[str], length: int, runs: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
        index, size = self.index[length], min(self.shingle, length)
        for first, last in runs:
            for begin in range(first, last + 1, 4096):
                block = np.arange(begin, min(begin + 4096, last + 1))
                local = words[block[0]:block[-1] + length]
                signs = sign_bits(shingles_of(local, size))
                total = np.concatenate([np.zeros((1, 64), dtype=np.int32), np.cumsum(signs, axis=0, dtype=np.int32)])
                width = max(1, min(length, len(local)) - size + 1)
                at = block - block[0]
                for start, fingerprint in zip(block.tolist(), pack(total[np.minimum(at + width, len(signs))] - total[at])):
                    for item, distance in index.near(fingerprint):
                        yield start, item, distance

    def _best_repeating(self, words: list[str], length: int, own: list[str], positions: np.ndarray) -> dict | None:
        """The best window for an item whose shingles start at ``positions``. Only windows that hold as many of
        them as the similarity needs are looked at."""
        n = min(len(words), length) - min(self.shingle, length) + 1
        n = max(n, 1)
        needed = int(-(-(self.similarity * (n + len(own)) / (1 + self.similarity) - 1e-9) // 1))
        if len(positions) < max(needed, 1):
            return None
        # Runs of ``needed`` hits that fit into one window, and the windows around each.
        begin, end = positions[: len(positions) - needed + 1], positions[needed - 1:]
        fits = end - begin < n
        first = np.maximum(end[fits] - n + 1, 0)
        last = np.minimum(begin[fits], max(len(words) - length, 0))
        best = None
        for low, high in _merged(first, last):
            for start in range(low, high + 1):
                window = shingles_of(words[start:start + length], self.shingle)
                value = weighted_similarity(window, own)
                if value >= self.similarity and (best is None or value > best["similarity"]):
                    far = pack(sign_bits(window).sum(axis=0)[None]) ^ pack(sign_bits(own).sum(axis=0)[None])
                    best = {"similarity": value, "distance": int(np.bitwise_count(far)[0]), "start": start}
        return best


def _merged(first: np.ndarray, last: np.ndarray) -> list[tuple[int, int]]:
    """Intervals, ascending in both ends, as few as hold the same numbers."""
    fine = first <= last
    first, last = first[fine], last[fine]
    if not len(first):
        return []
    new = np.concatenate([[True], first[1:] > last[:-1] + 1])
    ends = np.append(np.flatnonzero(new)[1:], len(first)) - 1
    return list(zip(first[new].tolist(), last[ends].tolist()))


FOUND = pa.list_(pa.struct([
    ("item", pa.string()), ("similarity", pa.float64()), ("distance", pa.int32()), ("start", pa.int64()), ("n_words", pa.int32())
]))


def _items(benchmark: DataFrame, text: str, item: str) -> DataFrame:
    items = benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), F.col(f"`{text}`").cast("string").alias("text"))
    return items.filter("text is not null").distinct()


def _n_blocks(items: DataFrame, block_items: int, block_bytes: int) -> int:
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    return max(-(-n // block_items), -(-size // block_bytes) if n else 0)


def _block(items: DataFrame, block: int, blocks: int, similarity: float, radius: int) -> Benchmark:
    """About one of ``blocks`` parts of the items; the driver has one at a time."""
    rows = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
    return Benchmark([tuple(r) for r in sorted(rows, key=str)], similarity, radius)


def _search(text: Column, bench: Benchmark) -> Column:
    @F.arrow_udf("array<struct<item: string, similarity: double, distance: int, start: bigint, n_words: int>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([bench.matches(t.as_py() or "") for t in texts], type=FOUND)
        release_memory()

    return run(text)


def matches(
    df: DataFrame, benchmark: DataFrame, text: str = "text", id_col: str = "doc_id", item_text: str = "text", item_id: str = "item_id",
    similarity: float = SIMILARITY, radius: int = RADIUS, block_items: int = BLOCK_ITEMS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document row and benchmark item found in it: id, item id, ``similarity`` of the best
    window, its ``distance`` in bits, first word ``start_word`` and ``n_words``.

    Equally good windows: the first. Null and empty texts match nothing, null or wordless items are
    never found, of two items of one text both are. An item id that is null or repeated comes out as it is, with a row
    for each of its texts that is found.
    A text shorter than the item is one window. Empty input or benchmark: no rows.
    """
    kind = benchmark.schema[item_id].dataType
    schema = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, `{item_id}` {kind.simpleString()}, similarity double, distance int, start_word long, n_words int"
    spark, items = df.sparkSession, _items(benchmark, item_text, item_id)

    def found(bench: Benchmark) -> DataFrame:
        rows = df.select(F.col(f"`{id_col}`").alias("_id"), _search(F.col(f"`{text}`").cast("string"), bench).alias("_m"))
        return rows.select("_id", F.explode("_m").alias("_m")).select(
            F.col("_id").alias(id_col), F.col("_m.item").cast(kind).alias(item_id), "_m.similarity", "_m.distance",
            F.col("_m.start").alias("start_word"), "_m.n_words",
        )

    blocks = _n_blocks(items, block_items, block_bytes)
    if blocks == 0:
        return spark.createDataFrame([], schema)
    if blocks == 1:
        return found(_block(items, 0, 1, similarity, radius))
    path = scratch_path(spark, "matches")
    for block in range(blocks):
        found(_block(items, block, blocks, similarity, radius)).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def drop_contaminated(
    df: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id",
    similarity: float = SIMILARITY, radius: int = RADIUS, block_items: int = BLOCK_ITEMS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``df`` without any benchmark item, columns unchanged."""
    spark, items = df.sparkSession, _items(benchmark, item_text, item_id)
    body = F.col(f"_row.`{text}`").cast("string")
    rows = df.select(F.struct("*").alias("_row"))
    blocks = _n_blocks(items, block_items, block_bytes)
    if blocks == 0:
        return df
    if blocks == 1:
        return rows.filter(F.size(_search(body, _block(items, 0, 1, similarity, radius))) == 0).select("_row.*")
    # A text is found or not whatever row it is in; the few that are found are kept by their digest.
    path = scratch_path(spark, "leaks")
    for block in range(blocks):
        leaks = rows.filter(F.size(_search(body, _block(items, block, blocks, similarity, radius))) > 0)
        leaks.select(F.sha2(body, 256).alias("_leak")).write.mode("append").parquet(path)
    leaks = spark.read.schema("_leak string").parquet(path).distinct()
    return rows.withColumn("_digest", F.sha2(body, 256)).join(leaks, F.col("_digest").eqNullSafe(F.col("_leak")), "left_anti").select("_row.*")
