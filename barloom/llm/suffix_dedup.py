"""Repeated passages by a sparse suffix array.

A passage of ``min_words`` words that stands at two places has the same minimiser at both: its k words with
the smallest hash. Only the suffixes at minimisers are retained, about one in 22 words. Each stands for the
``min_words`` windows that chose it, and its context is what they cover: it reaches left to the first of
them and right to the end of the last.

Sorted by their first k words, a suffix without an equal neighbour ends there. If all that are equal agree
over the whole context, all of it is repeated. Otherwise the match ends somewhere on the left or on the
right: it is extended from the minimiser window by window, by comparing what the different contexts hold.
Where a document's repeated windows touch, they make one span.

Texts that are copies of each other go through as one. Windows are compared by 128-bit hashes,
contexts, which are compared only under equal first words, by 64 bits, texts by 120.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import release_memory, text_of
from barloom.session import stage

MIN_WORDS = 50
#: Words compared first; a minimiser's order comes from their hash.
K = 8
#: Words of a text hashed at a time, and distinct words remembered in a partition.
STRETCH = 1 << 18
PLACE_BITS = 20
MEMO_WORDS = 500_000

#: Odd multipliers of the rolling hashes and their inverses modulo 2^64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
INVERSES = tuple(pow(b, -1, 1 << 64) for b in BASES)


class Hasher:
    """Two 64-bit hashes of each word, remembered by number."""

    def __init__(self):
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = defaultdict(count().__next__)
        self.hashes = np.zeros((2, 1 << 16), dtype=np.uint64)
        self.known = 0

    def words(self, words: list[str]) -> np.ndarray:
        """Two rows of word hashes."""
        if len(self.number) > MEMO_WORDS:
            self._forget()
        numbers = np.fromiter(map(self.number.__getitem__, words), dtype=np.int64, count=len(words))
        if len(self.number) > self.known:
            new = [w.encode("utf-8", "replace") for w in islice(reversed(self.number), len(self.number) - self.known)][::-1]
            while len(self.number) > self.hashes.shape[1]:
                self.hashes = np.concatenate([self.hashes, np.zeros_like(self.hashes)], axis=1)
            self.hashes[:, self.known:len(self.number)] = [[xxhash.xxh64_intdigest(w, seed) for w in new] for seed in (1, 2)]
            self.known = len(self.number)
        return self.hashes[:, numbers]


class Rolling:
    """Hashes of any run of a stretch, from prefix sums of hash times power."""

    def __init__(self, hashes: np.ndarray):
        n = hashes.shape[1]
        self.prefix, self.undo = [], []
        for row, base, inverse in zip(hashes, BASES, INVERSES):
            self.prefix.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(row * _powers(base, n))]))
            self.undo.append(_powers(inverse, n + 1))

    def runs(self, start: np.ndarray, stop: np.ndarray, which: int) -> np.ndarray:
        return _mixed((self.prefix[which][stop] - self.prefix[which][start]) * self.undo[which][start])


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def minimisers(kmers: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` k-mers the place of the smallest, the leftmost of equal ones."""
    n = len(kmers)
    # Low bits make room for the place: a fixed number, so equal windows choose alike in any text.
    bits = np.uint64(max(PLACE_BITS, n.bit_length()))
    packed = (kmers >> bits << bits) | np.arange(n, dtype=np.uint64)
    blocks = -(-n // width) * width
    padded = np.full(blocks, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = packed
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[: n - width + 1], ahead[width - 1:n])
    return (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def suffixes(words: list[str], hasher: Hasher, min_words: int, k: int) -> list[np.ndarray]:
    """Key, context hash, first and last window start of each retained suffix."""
    parts = []
    for at in range(0, len(words) - min_words + 1, STRETCH):
        local = words[at:at + STRETCH + min_words - 1]
        rolling = Rolling(hasher.words(local))
        starts = np.arange(len(local) - k + 1)
        kmers = rolling.runs(starts, starts + k, 0)
        chosen = minimisers(kmers, min_words - k + 1)
        first = np.nonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))[0]
        last = np.concatenate([first[1:], [len(chosen)]]) - 1
        # Equal contexts have their minimiser at the same place, so equal windows too.
        parts.append([kmers[chosen[first]], rolling.runs(first, last + min_words, 1), first + at, last + at])
    return [np.concatenate(column) for column in zip(*parts)] if parts else [np.zeros(0, np.uint64)] * 4


def _retained(texts: DataFrame, min_words: int, k: int) -> DataFrame:
    """One row per text: ``n_words`` and its suffixes."""

    @F.arrow_udf("struct<n_words: int, suffixes: array<struct<key: bigint, context: bigint, first: int, last: int>>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hasher = Hasher()
        for batch in batches:
            counts, sizes, rows = [], [0], []
            for text in batch:
                words = text.as_py().split()
                found = suffixes(words, hasher, min_words, k)
                counts.append(len(words))
                sizes.append(sizes[-1] + len(found[0]))
                rows.append(found)
            columns = [np.concatenate(c) for c in zip(*rows)] if rows else [np.zeros(0, np.uint64)] * 4
            arrays = [pa.array(c.view(np.int64)) for c in columns[:2]] + [pa.array(c.astype(np.int32)) for c in columns[2:]]
            structs = pa.StructArray.from_arrays(arrays, names=["key", "context", "first", "last"])
            lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), structs)
            yield pa.StructArray.from_arrays([pa.array(counts, pa.int32()), lists], names=["n_words", "suffixes"])
        del hasher
        release_memory()

    return texts.withColumn("found", run(F.col("text"))).select("id", *TEXT, "found.n_words", "found.suffixes")


def _with_equal_neighbours(listed: DataFrame) -> DataFrame:
    """Suffixes in order, without copies, that have a neighbour of the same key.

    The order is cut anywhere, also within a key; a suffix at a cut stays, as its neighbour is not seen.
    """
    order = ["key", "context", *TEXT, "first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        opening = True
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            values = [table[name].to_numpy() for name in order]
            fresh = np.ones(table.num_rows, dtype=bool)
            fresh[1:] = np.logical_or.reduce([v[1:] != v[:-1] for v in values])
            rows = np.nonzero(fresh)[0]
            key = values[0][rows]
            like_next = np.concatenate([key[1:] == key[:-1], [False]])
            stays = like_next | np.concatenate([[opening], like_next[:-1]])
            if held is not None:
                stays[0] |= carried
            # The last one waits for the next batch.
            yield from table.take(pa.array(rows[:-1][stays[:-1]])).to_batches()
            held, carried = table.slice(rows[-1], 1), bool(stays[-1])
            opening = opening and len(rows) == 1
        if held is not None:
            yield from held.to_batches()

    # Ranges of the whole order, so that suffixes of one frequent key go to several tasks.
    ordered = listed.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.mapInArrow(run, listed.schema)


TEXT = ["t1", "t2"]
CONTEXT = ["key", "context"]


def _text_ids(body) -> list:
    """120 bits of the MD5 as two numbers, which aggregate by hash."""
    digest = F.md5(body.cast("binary"))
    return [F.conv(F.substring(digest, at, 15), 16, 10).cast("long").alias(name) for name, at in zip(TEXT, (1, 17))]


def repeated_spans(
    df: DataFrame, text: str = "text", id_col: str = "doc_id", min_words: int = MIN_WORDS, k: int = K
) -> DataFrame:
    """One row per repeated span of an input row: id, ``start_word``, ``stop_word`` (behind the last),
    ``n_words`` and ``first_id``.

    A span is a maximal run of words that are all in windows of ``min_words`` words (cut at white space)
    which stand at two places or more, in one document or in several. ``first_id`` is the smallest id that
    holds one of its windows: the span may go where this is another document. Texts of fewer words, null
    texts and unique texts give no row. Rows that repeat a text, under one id or several, are copies: all
    of it is one span. Null ids are no first id unless there is no other. Empty input: no rows.
    """
    if not 1 <= k <= min_words:
        raise ValueError("k may not exceed min_words")
    id_type = df.schema[id_col].dataType.simpleString()
    body = text_of(text)
    texts = df.select(F.col(f"`{id_col}`").alias("id"), *_text_ids(body), body.alias("text"))
    stored = stage(_retained(texts, min_words, k), "suffixes")
    docs = stored.select("id", *TEXT, "n_words").filter(F.col("n_words") >= min_words)
    by_id = docs.groupBy(*TEXT, "id").agg(F.count("*").alias("rows"), F.max("n_words").alias("n_words"))
    classes = by_id.groupBy(*TEXT).agg(
        F.min("id").alias("first_id"), F.sum("rows").alias("copies"), F.max("rows").alias("rows"), F.max("n_words").alias("n_words")
    )
    classes = stage(classes, "texts")
    copied = classes.filter("copies > 1").select(*TEXT, F.lit(0).alias("start"), F.col("n_words").alias("stop"), "first_id")

    listed = stored.select(*TEXT, F.explode("suffixes").alias("s")).select(*TEXT, "s.*")
    listed = stage(_with_equal_neighbours(listed), "neighbours")
    # Small tables that meet hot keys are stored, so that Spark can split the other side of the join.
    keys = listed.groupBy("key").agg(F.count("*").alias("n"), (F.min("context") == F.max("context")).alias("uniform"))
    keys = stage(keys.filter("n > 1").select("key", "uniform"), "keys")
    members = listed.join(keys, "key").join(classes.select(*TEXT, "first_id"), TEXT)
    members = stage(members, "members")
    contexts = members.groupBy(*CONTEXT, "uniform").agg(
        F.min("first_id").alias("first_id"), F.count("*").alias("n"), F.min("t1").alias("t1")
    )
    contexts = stage(contexts, "contexts")
    whole = members.filter("uniform").select(*CONTEXT, *TEXT, "first", "last").join(
        contexts.filter("uniform").select(*CONTEXT, "first_id"), CONTEXT
    )
    whole = whole.select(*TEXT, F.col("first").alias("start"), (F.col("last") + min_words).alias("stop"), "first_id")

    # Contexts that differ: their windows are compared, one text of each context standing for all.
    open_members, open_contexts = members.filter("not uniform"), contexts.filter("not uniform")
    windows = stage(_window_rows(texts, open_members, open_contexts, classes, min_words), "windows")
    counted = windows.join(open_contexts.select(*CONTEXT, "n", "first_id"), CONTEXT)
    shared = counted.groupBy("w1", "w2").agg(F.sum("n").alias("n"), F.min("first_id").alias("origin")).filter("n > 1")
    shared = stage(shared.select("w1", "w2", "origin"), "shared")
    # A context has as many windows as it has words, at most.
    runs = windows.join(shared, ["w1", "w2"]).groupBy(*CONTEXT).agg(F.collect_list(F.struct("offset", "origin")).alias("shared"))
    runs = stage(runs, "runs")
    partly = open_members.select(*CONTEXT, *TEXT, "first").join(runs, CONTEXT)
    partly = partly.select(*TEXT, "first", F.explode("shared").alias("w")).select(
        *TEXT, (F.col("first") + F.col("w.offset")).alias("start"), (F.col("first") + F.col("w.offset") + min_words).alias("stop"),
        F.col("w.origin").alias("first_id"),
    )
    spans = _merged(copied.unionByName(whole).unionByName(partly), id_type)
    return docs.select("id", *TEXT).join(spans, TEXT).select(
        F.col("id").alias(id_col), F.col("start").alias("start_word"), F.col("stop").alias("stop_word"),
        (F.col("stop") - F.col("start")).alias("n_words"), "first_id",
    )


def _window_rows(texts: DataFrame, members: DataFrame, contexts: DataFrame, classes: DataFrame, min_words: int) -> DataFrame:
    """``key``, ``context``, ``offset``, ``w1``, ``w2``: the windows of each context, from one of its texts."""
    chosen = members.join(contexts.select(*CONTEXT, "t1"), [*CONTEXT, "t1"])
    chosen = chosen.groupBy(*CONTEXT, "t1").agg(F.min("t2").alias("t2"), F.min("first").alias("first"), F.min(F.col("last") - F.col("first")).alias("more"))
    wanted = chosen.groupBy(*TEXT).agg(F.collect_list(F.struct(*CONTEXT, "first", "more")).alias("wanted"))
    wanted = wanted.join(classes.select(*TEXT, "first_id", "copies", "rows"), TEXT)
    # Of copies the first one speaks; rows that repeat id and text are the rare case that needs counting.
    held = texts.join(wanted.hint("merge"), TEXT).filter((F.col("copies") == 1) | F.col("id").eqNullSafe(F.col("first_id")))
    parts = held.filter("rows = 1").select("text", "wanted")
    if not classes.filter("rows > 1").isEmpty():
        parts = parts.union(held.filter("rows > 1").dropDuplicates(TEXT).select("text", "wanted"))
    names = [*CONTEXT, "offset", "w1", "w2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for text, wanted in zip(*batch.columns):
                columns = _windows(text.as_py().split(), wanted.as_py(), hasher, min_words)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)
        del hasher
        release_memory()

    return parts.mapInArrow(run, "key long, context long, offset int, w1 long, w2 long")


def _windows(words: list[str], wanted: list[dict], hasher: Hasher, min_words: int) -> list[np.ndarray]:
    """The columns of the windows that ``wanted`` contexts of a text hold, a stretch of the text at a time."""
    wanted = sorted(wanted, key=lambda s: s["first"])
    parts, at = [], 0
    while at < len(wanted):
        base = wanted[at]["first"]
        end = at
        while end < len(wanted) and wanted[end]["first"] + wanted[end]["more"] < base + STRETCH or end == at:
            end += 1
        group, at = wanted[at:end], end
        stop = max(s["first"] + s["more"] for s in group) + min_words
        rolling = Rolling(hasher.words(words[base:stop]))
        sizes = [s["more"] + 1 for s in group]
        offsets = np.concatenate([np.arange(n) for n in sizes])
        starts = offsets + np.repeat([s["first"] - base for s in group], sizes)
        parts.append([
            *(np.repeat(np.array([s[name] for s in group], dtype=np.int64), sizes) for name in CONTEXT), offsets.astype(np.int32),
            *(rolling.runs(starts, starts + min_words, i).view(np.int64) for i in (0, 1)),
        ])
    return [np.concatenate(column) for column in zip(*parts)]


def _merged(pieces: DataFrame, id_type: str) -> DataFrame:
    """Spans of each text: pieces that overlap or touch are one. A text's pieces are bounded by its words."""
    gathered = pieces.groupBy(*TEXT, "start").agg(F.max("stop").alias("stop"), F.min("first_id").alias("first_id"))
    gathered = gathered.groupBy(*TEXT).agg(F.array_sort(F.collect_list(F.struct("start", "stop", "first_id"))).alias("pieces"))
    step = F.aggregate(
        "pieces",
        F.expr(f"cast(array() as array<struct<start: int, stop: int, first_id: {id_type}>>)"),
        lambda done, p: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["stop"] >= p["start"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["stop"], p["stop"]).alias("stop"),
                F.least(F.element_at(done, -1)["first_id"], p["first_id"]).alias("first_id"),
            ))),
        ).otherwise(F.concat(done, F.array(p))),
    )
    return gathered.select(*TEXT, F.explode(step).alias("s")).select(*TEXT, "s.*")
