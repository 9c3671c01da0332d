"""Phrase collocation mining over Rabin-Karp fingerprints.

A task lays its texts end to end and works on them as arrays: words are runs of bytes between marks, a prefix
polynomial over the bytes hashes every word, a prefix polynomial over the word hashes every n-gram of it (a
difference of two prefixes, shifted back to the front). Equal fingerprints are counted in the task with a pointer to
one of their occurrences; what leaves the task is a fingerprint and its count.

A phrase can only be frequent if all its parts are. So the shuffle sees the fingerprints level by level, first
words, then pairs of frequent words, then phrases of frequent pairs; what the level before found frequent is a
bitmap of bounded size. A bit set by chance lets a phrase through that the count then drops: the bitmap decides
about cost, never about a result.

The last pass verifies against the text. In each block of words the occurrences of a frequent fingerprint are compared
with the one pointed to, word by word; each phrase that differs counts as its own. Only these phrases, frequent
in their fingerprint, are written out as text, and the final counts go by the text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import Bitmap, bitmap_of, release_memory, text_of
from barloom.session import stage

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2_000
#: A candidate goes if a longer one that contains it has this share, in percent, of its count.
ABSORBED = 100
NO_LANGUAGE = "und"

#: Bytes of a long text hashed at a time, bytes of short ones, and words whose n-grams are counted together.
STRETCH = 1 << 20
SHORT_BYTES = 1 << 18
BLOCK_WORDS = 500_000
#: Phrases of the last pass whose counts a task adds up over its blocks.
TASK_PHRASES = 500_000

BLANKS, MARKS = b" \t", b".,;:!?\n\v\f\r"
KINDS = np.zeros(256, dtype=np.uint8)
KINDS[list(BLANKS)], KINDS[list(MARKS)] = 1, 2

#: Odd bases modulo 2^64, so that a shift can be taken back, and their inverses.
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
MASK = (1 << 64) - 1


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & MASK, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def spread(h: np.ndarray) -> np.ndarray:
    """Mixes high and low bits; one to one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Prefixes:
    """Prefix polynomials of one base. The hash of ``[start, stop)`` does not depend on where it stands."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = powers(1, 0)

    def hashes(self, values: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(values):
            n = max(len(values) + 1, 2 * len(self.up))
            self.up, self.down = powers(self.base, n), powers(self.inverse, n)
        sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * self.up[: len(values)], out=sums[1:])
        return (sums[stops] - sums[starts]) * self.down[starts]


class Words:
    """Words of a run of texts: place in ``data``, hash, piece (consecutive words of one piece share its
    number) and language."""

    def __init__(self, bytes_base: int = BYTE_BASE):
        self.prefixes = Prefixes(bytes_base)
        self.pieces = 0
        self.clear()

    def clear(self) -> None:
        self.data: list[bytes] = []
        self.at, self.n = 0, 0
        self.columns: list[tuple[np.ndarray, ...]] = []
        self.short: list[tuple[bytes, int]] = []
        self.short_bytes = 0

    def add(self, text: bytes, lang: int) -> Iterator[None]:
        """Adds a text; the caller may take what is there whenever this yields. Short texts are hashed many at
        a time, a long one in stretches that end behind a word."""
        self.short.append((text, lang))
        self.short_bytes += len(text)
        if self.short_bytes < SHORT_BYTES:
            return
        texts, self.short, self.short_bytes = self.short, [], 0
        last, _ = texts[-1]
        if len(last) >= SHORT_BYTES:
            self._stretch(texts[:-1])
            self.pieces += 1
            start = 0
            while start < len(last):
                stop = start + STRETCH
                if stop < len(last):
                    ends = [i for i in (last.find(c, stop) for c in (b" ", b"\n", b"\t", b".")) if i >= 0]
                    stop = min(ends, default=len(last))
                self._stretch([(last[start:stop], lang)])
                start = stop
                yield
            self.pieces += 1
        else:
            self._stretch(texts)
            self.pieces += 1
            yield

    def _stretch(self, texts: list[tuple[bytes, int]]) -> None:
        # A line feed between texts ends a piece. Of bytes, lower() changes A to Z only.
        part = b"\n".join([t for t, _ in texts]).lower()
        raw = np.frombuffer(part, dtype=np.uint8)
        kinds = KINDS[raw]
        inside = np.zeros(len(raw) + 2, dtype=np.int8)
        inside[1:-1] = kinds == 0
        edges = np.diff(inside)
        starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        marks = np.cumsum(kinds == 2, dtype=np.int32)
        if len(starts):
            hashed = spread(self.prefixes.hashes(raw.astype(np.uint64) + np.uint64(1), starts, stops))
            pieces = self.pieces + marks[starts].astype(np.int64)
            ends = np.cumsum([len(t) + 1 for t, _ in texts])
            langs = np.array([lang for _, lang in texts], dtype=np.int32)[np.searchsorted(ends, starts, side="right")]
            self.columns.append((starts + self.at, stops + self.at, hashed, pieces, langs))
            self.n += len(starts)
        self.pieces += int(marks[-1]) if len(marks) else 0
        self.data.append(part)
        self.at += len(part)

    def take(self, last: bool) -> tuple[bytes, list[np.ndarray], int]:
        """The text, the columns, and how many words open an n-gram now; the last few open theirs in the next
        block, unless this one is the last."""
        if self.short:
            texts, self.short, self.short_bytes = self.short, [], 0
            self._stretch(texts)
            self.pieces += 1
        data = b"".join(self.data)
        columns = [np.concatenate(c) for c in zip(*self.columns)] if self.columns else [np.zeros(0, dtype=np.int64)] * 5
        n = len(columns[0])
        opening = n if last else max(0, n - (MAX_WORDS - 1))
        self.clear()
        if not last and opening < n:
            first = int(columns[0][opening])
            rest = [c[opening:] for c in columns]
            self.data, self.at, self.n = [data[first:]], len(data) - first, n - opening
            self.columns = [(rest[0] - first, rest[1] - first, *rest[2:])]
        return data, columns, opening


def ngrams(columns: Sequence[np.ndarray], opening: int, n: int, seeds: np.ndarray, prefixes: Prefixes) -> tuple[np.ndarray, np.ndarray]:
    """First words and fingerprints of all n-grams inside a piece. The language is part of a fingerprint."""
    _, _, hashed, pieces, langs = columns
    first = np.arange(max(0, min(opening, len(hashed) - n + 1)))
    first = first[pieces[first] == pieces[first + n - 1]]
    prints = prefixes.hashes(hashed, first, first + n)
    return first, spread(prints + seeds[langs[first]] + np.uint64(n))


def _blocks(batches: Iterator[pa.RecordBatch], word_prefixes: Prefixes):
    """Blocks of words with the languages met so far and their seeds."""
    words, names, index, seeds = Words(), [], {}, []

    def block(last: bool):
        data, columns, opening = words.take(last)
        return data, columns, opening, names, np.array(seeds, dtype=np.uint64)

    for batch in batches:
        for lang, text in zip(batch.column("_lang"), batch.column("_text")):
            name = lang.as_py()
            if name not in index:
                index[name] = len(names)
                names.append(name)
                seeds.append(xxhash.xxh64_intdigest(name.encode(), seed=1))
            for _ in words.add(text.as_py().encode(), index[name]):
                if words.n >= BLOCK_WORDS:
                    yield block(False)
    yield block(True)


def _counts(rows: DataFrame, sizes: Sequence[int], known: Bitmap | None, step: int, min_count: int) -> DataFrame:
    """``fp`` of the n-grams of ``sizes`` that occur ``min_count`` times or more, counted by fingerprint. Only
    those whose parts of ``step`` words are all in ``known`` are counted at all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes = Prefixes(WORD_BASE)
        for _, columns, opening, _, seeds in _blocks(batches, prefixes):
            fine = None
            if known is not None and len(columns[0]):
                # Parts may open behind the last word that opens an n-gram here.
                first, prints = ngrams(columns, len(columns[0]), step, seeds, prefixes)
                fine = np.zeros(len(columns[0]) + MAX_WORDS, dtype=bool)
                fine[first] = known.has(prints)
            for n in sizes:
                first, prints = ngrams(columns, opening, n, seeds, prefixes)
                if fine is not None:
                    ok = np.ones(len(first), dtype=bool)
                    for k in range(n - step + 1):
                        ok &= fine[first + k]
                    prints = prints[ok]
                prints, counts = np.unique(prints, return_counts=True)
                for i in range(0, len(prints), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(prints[i:i + (1 << 16)].view(np.int64)), pa.array(counts[i:i + (1 << 16)])], ["fp", "n"])
        release_memory()

    counted = rows.mapInArrow(run, "fp long, n long").groupBy("fp").agg(F.sum("n").alias("n"))
    return stage(counted.filter(F.col("n") >= min_count).select("fp"), "frequent")


def word_numbers(data: bytes, starts: np.ndarray, stops: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """A number for each word; equal numbers are equal words, byte by byte."""
    order = np.argsort(hashed, kind="stable")
    new = np.ones(len(order), dtype=bool)
    here, before = order[1:], order[:-1]
    sizes = stops - starts
    same = (hashed[here] == hashed[before]) & (sizes[here] == sizes[before])
    eight = np.lib.stride_tricks.sliding_window_view(np.frombuffer(data + bytes(8), dtype=np.uint8), 8)
    left = np.flatnonzero(same)
    offset = 0
    while len(left):
        a, b = starts[here[left]] + offset, starts[before[left]] + offset
        over = sizes[here[left]] - offset
        x, y = (np.ascontiguousarray(eight[i]).view(np.uint64)[:, 0] for i in (a, b))
        # The first byte is the lowest: what lies behind the word is shifted out at the top.
        shift = (np.maximum(0, 8 - over) * 8).astype(np.uint64)
        same[left] = (x << shift) == (y << shift)
        left = left[(over > 8) & same[left]]
        offset += 8
    new[1:] = ~same
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(new)
    return out


def _phrases(rows: DataFrame, known: Bitmap) -> DataFrame:
    """``lang``, ``phrase``, ``f``: text and count of all n-grams whose fingerprint is in ``known``. The count
    of all words of a language stands under the empty phrase."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes = Prefixes(WORD_BASE)
        for data, columns, opening, names, seeds in _blocks(batches, prefixes):
            starts, stops, hashed, _, langs = columns
            totals = np.bincount(langs[:opening], minlength=len(names)) if opening else np.zeros(len(names), dtype=np.int64)
            yield _batch([(name, "", int(n)) for name, n in zip(names, totals)])
            if not opening:
                continue
            numbers = word_numbers(data, starts, stops, hashed)
            for n in range(1, MAX_WORDS + 1):
                first, prints = ngrams(columns, opening, n, seeds, prefixes)
                ok = known.has(prints)
                first, prints = first[ok], prints[ok]
                order = np.argsort(prints, kind="stable")
                first, prints = first[order], prints[order]
                # Each occurrence against the one before it; a run's first is the pointer that is read.
                new = np.ones(len(first), dtype=bool)
                new[1:] = (prints[1:] != prints[:-1]) | (langs[first[1:]] != langs[first[:-1]])
                for k in range(n):
                    new[1:] |= numbers[first[1:] + k] != numbers[first[:-1] + k]
                heads = np.flatnonzero(new)
                counts = np.diff(np.append(heads, len(first)))
                for i in range(0, len(heads), 1 << 16):
                    part = first[heads[i:i + (1 << 16)]]
                    places = [zip(starts[part + k].tolist(), stops[part + k].tolist()) for k in range(n)]
                    texts = [b" ".join([data[a:b] for a, b in words]).decode() for words in zip(*places)]
                    spoken = [names[j] for j in langs[part].tolist()]
                    yield _batch(list(zip(spoken, texts, counts[i:i + (1 << 16)].tolist())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _added_up(counted(batches))
        release_memory()

    found = rows.mapInArrow(run, "lang string, phrase string, f long")
    return found.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _added_up(batches: Iterator[pa.RecordBatch], most_rows: int = TASK_PHRASES) -> Iterator[pa.RecordBatch]:
    """Adds up the counts of a phrase over the blocks of a task, so that it leaves the task once; more than ``most_rows``
    different phrases leave it more than once."""
    held: list[pa.RecordBatch] = []
    size, limit = 0, most_rows
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= limit:
            held = _summed(held)
            size = sum(b.num_rows for b in held)
            if size >= most_rows:
                yield from held
                held, size = [], 0
            # Not added up again for a few rows.
            limit = max(most_rows, 2 * size)
    yield from _summed(held)


def _summed(batches: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    if not batches:
        return []
    sums = pa.Table.from_batches(batches).group_by(["lang", "phrase"], use_threads=False).aggregate([("f", "sum")])
    return sums.select(["lang", "phrase", "f_sum"]).rename_columns(["lang", "phrase", "f"]).to_batches(max_chunksize=1 << 16)


def _batch(rows: list[tuple[str, str, int]]) -> pa.RecordBatch:
    lang, phrase, f = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(phrase, pa.string()), pa.array(f, pa.int64())], ["lang", "phrase", "f"])


def frequent_phrases(df: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT) -> DataFrame:
    """``lang``, ``phrase`` (its words, one space between), ``f``: every phrase of 1 to 5 words that occurs ``min_count``
    times or more in a language, and under the empty phrase the number of all words of each language.

    Words are runs between blanks and tabs inside pieces; pieces end at ``.,;:!?`` and line breaks. A to Z are
    lower-cased. Null text is empty, null language is ``und``. No words: no phrases.
    """
    rows = df.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(NO_LANGUAGE)).alias("_lang"), text_of(text).alias("_text"))
    words = _counts(rows, [1], None, 0, min_count)
    pairs = _counts(rows, [2], bitmap_of(words), 1, min_count)
    longer = _counts(rows, range(3, MAX_WORDS + 1), bitmap_of(pairs), 2, min_count)
    counted = _phrases(rows, bitmap_of(words.union(pairs).union(longer)))
    return stage(counted.filter((F.col("f") >= min_count) | (F.col("phrase") == "")), "phrases")


def collocations(
    df: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, top: int = TOP, absorbed: int = ABSORBED
) -> DataFrame:
    """The best phrases of 2 to 5 words of each language: ``lang``, ``rank`` (from 1), ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    ``a`` counts the phrase, ``n`` all words of the language. Of all cuts of a phrase in two, with counts ``l`` and
    ``r``, the one of the lowest score ``floor(1000 a n / (l r))`` counts, the first of equals. A phrase inside
    a longer candidate that has ``absorbed`` percent of its count goes, whether or not the longer one stays. Ties in
    score go by ``a``, then by the bytes of the phrase. A language without candidates has no rows.
    """
    counted = frequent_phrases(df, text, lang, min_count)
    totals = counted.filter("phrase = ''").select("lang", F.col("f").alias("n"))
    parts = counted.filter("phrase <> ''")
    words = F.split("phrase", " ")
    candidates = parts.withColumn("w", words).filter(F.size("w") >= 2)

    inner = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.size("w") - 1), lambda size: F.transform(
        F.sequence(F.lit(1), F.size("w") - size + 1), lambda at: F.array_join(F.slice("w", at, size), " ")
    ))))
    longer = candidates.filter(F.size("w") > 2).select("lang", inner.alias("phrase"), F.col("f").alias("longer"))
    covered = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = candidates.join(covered, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(absorbed) * F.col("f"))
    )

    cut = F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda k: F.struct(
        k.alias("k"), F.array_join(F.slice("w", 1, k), " ").alias("head"), F.array_join(F.slice("w", k + 1, F.size("w")), " ").alias("rest")
    )))
    cuts = kept.select("lang", "phrase", F.col("f").alias("a"), cut.alias("c")).select("lang", "phrase", "a", "c.*")
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    # Whole numbers of up to 38 digits; one more is an error, not a rounding.
    big = {c: F.col(c).cast("decimal(17,0)") for c in "alrn"}
    scored = cuts.join(totals, "lang").withColumns({f"_{c}": v for c, v in big.items()})
    scored = scored.withColumn("score", F.expr("(1000 * _a * _n) div (_l * _r)"))
    least = F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("s")
    best = stage(scored.groupBy("lang", "phrase").agg(least).select("lang", "phrase", "s.*").drop("k"), "scored")

    # In ranges of the whole order: a language's rows go to as many tasks as they need, a range tells where it begins.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    ranges = stage(best.repartitionByRange("lang", *order).withColumn("_range", F.spark_partition_id()), "ranges")
    counts = ranges.groupBy("lang", "_range").agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy("lang").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.withColumn("_before", F.coalesce(F.sum("_n").over(ahead), F.lit(0))).filter(F.col("_before") < top).drop("_n")
    local = F.row_number().over(Window.partitionBy("lang", "_range").orderBy(*order))
    ranked = ranges.join(begins, ["lang", "_range"]).withColumn("rank", (F.col("_before") + local).cast("long"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
