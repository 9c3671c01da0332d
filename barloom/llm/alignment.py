"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Both tokenizers encode a blank and the text. The ends of a text's tokens, as byte offsets, go into a dictionary from
end to index for each tokenizer; the offsets that are keys of both, in order, slice both id lists into groups. Inside
a group tokens are linked where their bytes overlap.

No token of either tokenizer goes on over the blank between two words, so a text is encoded and aligned in
segments that meet there: a segment met again is not encoded again.

How often two ids are linked in the corpus is counted from the segments of a block of texts: a pair leaves the block once
with its count. The counts go back the same way, one row for each pair of a block, to the block's stored
segments, so no task needs the counts of the whole corpus.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import release_memory, text_of
from barloom.session import stage

#: Bytes of texts of a block, and segments known in a task; what comes first ends the block.
BLOCK_BYTES = 32 << 20
BLOCK_SEGMENTS = 400_000
#: Segments encoded in one call, and bytes of texts whose segments are looked up together.
BATCH = 4_096
WAITING_BYTES = 1 << 18

#: Between a visible character and the blanks, or the line feed, in front of the next one.
SEAM = re.compile(r"(?<=\S)(?= +\S|\n\S)")
BLANK_PIECE = "▁"
#: What stands behind an id in a line of groups.
MARKS = (",", "|", ";", "")
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def byte_level_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies, by the public rule: visible Latin-1
    characters for themselves, the others in order from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """A byte-level tokenizer of the library ``tokenizers``; special strings in texts are text."""

    def __init__(self, content: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content.decode())
        self.tokenizer.encode_special_tokens = True
        alphabet = byte_level_alphabet()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.tokens = [b""] * size
        for entry, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.tokens[i] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()

    def encode(self, segments: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(segments, add_special_tokens=False)]


class Pieces:
    """A piece tokenizer of the library ``sentencepiece`` that adds the blank in front itself."""

    def __init__(self, content: bytes):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.tokens = []
        for i in range(self.processor.get_piece_size()):
            piece = self.processor.id_to_piece(i)
            one = BYTE_PIECE.fullmatch(piece) if self.processor.is_byte(i) else None
            self.tokens.append(bytes([int(one[1], 16)]) if one else piece.replace(BLANK_PIECE, " ").encode())

    def encode(self, segments: list[str]) -> list[list[int]]:
        """A segment that opens with a blank is given without it. One that opens with a line feed, which is
        no part of any longer piece, gets a blank more, which is taken off again."""
        added = [not s.startswith(" ") for s in segments]
        found = self.processor.encode([s if a else s[1:] for s, a in zip(segments, added)], num_threads=1)
        return [ids[1:] if a else ids for ids, a in zip(found, added)]


def segments_of(text: str) -> list[str]:
    """The segments of a blank and ``text``."""
    return SEAM.split(" " + text)


def links_of(a_sizes: Sequence[int], b_sizes: Sequence[int]) -> list[tuple[int, int]]:
    """Pairs of tokens of one group whose bytes overlap."""
    return list(zip(*(places.tolist() for places in overlaps(np.cumsum(a_sizes), np.cumsum(b_sizes))[1:])))


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens that overlap, of two lists that cover the same bytes: where the bytes they share end, and their places.
    Two tokens share one stretch of bytes, which ends as one of them does; so each end of either list is one link."""
    ends = np.flatnonzero(_marked(a_ends) | _marked(b_ends))
    return ends, np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)


def _marked(ends: np.ndarray) -> np.ndarray:
    out = np.zeros(ends[-1] + 1, dtype=bool)
    out[ends] = True
    return out


class Aligner:
    """Segments of a task, each encoded and aligned once."""

    def __init__(self, a: ByteLevel, b: Pieces):
        self.a, self.b = a, b
        self.a_size, self.b_size = (np.array([len(t) for t in tokens], dtype=np.int64) for tokens in (a.tokens, b.tokens))
        # Each id with what may stand behind it.
        self.ids = max(len(a.tokens), len(b.tokens))
        self.names = np.array([f"{i}{mark}" for mark in MARKS for i in range(self.ids)], dtype=object)
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.lines: list[str | None] = []  # None: the tokens' bytes are not the segment's
        self.counts = array("q")  # of A tokens, B tokens, groups, links
        self.starts = array("q")  # of a segment's links in ``pairs``
        self.pairs = array("q")  # linked ids: A above, B in the low 32 bits

    def add(self, segments: Iterable[str]) -> None:
        new = [s for s in dict.fromkeys(segments) if s not in self.known]
        for start in range(0, len(new), BATCH):
            part = new[start:start + BATCH]
            contents = [s.encode() for s in part]
            a, b = self.a.encode(part), self.b.encode(part)
            # The batch is one line of bytes; a segment's border is an end on it like any other.
            all_a, all_b = list(chain.from_iterable(a)), list(chain.from_iterable(b))
            if self._spell(all_a, all_b, b"".join(contents)) and self._align(part, all_a, all_b, list(map(len, contents))):
                continue
            for segment, content, a_ids, b_ids in zip(part, contents, a, b):
                if not (self._spell(a_ids, b_ids, content) and self._align([segment], a_ids, b_ids, [len(content)])):
                    self._know([segment], [None], np.zeros((1, 4), dtype=np.int64), np.zeros(1, dtype=np.int64))

    def _spell(self, a: list[int], b: list[int], content: bytes) -> bool:
        return all(b"".join([t.tokens[i] for i in ids]) == content for t, ids in ((self.a, a), (self.b, b)))

    def _know(self, segments: list[str], lines: list[str | None], counts: np.ndarray, starts: np.ndarray) -> None:
        self.known.update(zip(segments, range(len(self.lines), len(self.lines) + len(segments))))
        self.lines += lines
        self.counts.frombytes(np.ascontiguousarray(counts, dtype=np.int64).tobytes())
        self.starts.frombytes(np.ascontiguousarray(starts, dtype=np.int64).tobytes())

    def _align(self, segments: list[str], a_ids: list[int], b_ids: list[int], sizes: list[int]) -> bool:
        """Segments that lie end to end, as the tokens do. False: a border is not an end of both; nothing is kept."""
        a, b = np.array(a_ids, dtype=np.int64), np.array(b_ids, dtype=np.int64)
        a_ends, b_ends, borders = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]), np.cumsum(sizes)
        common = np.flatnonzero(_marked(a_ends) & _marked(b_ends))
        groups = np.searchsorted(common, borders)
        if not np.array_equal(common[groups], borders):
            return False
        # Tokens up to the end of each group, and groups, tokens and links up to the end of each segment.
        a_to, b_to, groups = np.searchsorted(a_ends, common, side="right"), np.searchsorted(b_ends, common, side="right"), groups + 1
        ends, a_at, b_at = overlaps(a_ends, b_ends)
        upto = np.stack([a_to[groups - 1], b_to[groups - 1], groups, np.searchsorted(ends, borders, side="right")], axis=1)
        counts = np.diff(upto, axis=0, prepend=0)
        starts = len(self.pairs) + upto[:, 3] - counts[:, 3]
        self.pairs.frombytes((a[a_at] << 32 | b[b_at]).tobytes())
        # The ids of a group in a row, A's before B's, each with the mark behind it: comma, bar, semicolon, or none at a segment's end.
        a_sizes, b_sizes = np.diff(a_to, prepend=0), np.diff(b_to, prepend=0)
        marks_a, marks_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
        marks_a[a_to - 1], marks_b[b_to - 1] = 1, 2
        marks_b[b_to[groups - 1] - 1] = 3
        row = np.empty(len(a) + len(b), dtype=np.int64)
        row[np.arange(len(a)) + np.repeat(b_to - b_sizes, a_sizes)] = marks_a * self.ids + a
        row[np.arange(len(b)) + np.repeat(a_to, b_sizes)] = marks_b * self.ids + b
        texts, stops = self.names[row].tolist(), (upto[:, 0] + upto[:, 1]).tolist()
        self._know(segments, ["".join(texts[i:j]) for i, j in zip([0, *stops], stops)], counts, starts)
        return True


#: Rows of the stored blocks: the block's segments, its pairs of ids, its documents.
SEGMENTS, PAIR, DOCUMENT = 0, 1, 2
STORED = pa.schema([
    ("block", pa.int64()), ("kind", pa.int32()), ("at", pa.int64()), ("pair", pa.int64()), ("n", pa.int64()), ("body", pa.binary()),
    ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
])
STORED_SQL = "block long, kind int, at long, pair long, n long, body binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def _table(size: int, /, **columns) -> Iterator[pa.RecordBatch]:
    """``size`` rows with the given columns, the others NULL, in batches."""
    for i in range(0, size, 1 << 14):
        m = min(1 << 14, size - i)
        arrays = [pa.array(columns[f.name][i:i + m], f.type) if f.name in columns else pa.nulls(m, f.type) for f in STORED]
        yield pa.RecordBatch.from_arrays(arrays, schema=STORED)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values``; a run may be empty."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


class Block:
    """Documents between two flushes, as numbers of their segments."""

    def __init__(self, aligner: Aligner):
        self.aligner, self.bytes = aligner, 0
        self.ids: list = []
        self.digests: list[str] = []
        self.segments: list[np.ndarray] = []
        self.waiting: list[list[str]] = []
        self.waiting_bytes = 0

    def add(self, row, text: str) -> None:
        self.bytes += len(text)
        self.ids.append(row)
        self.waiting.append(segments_of(text) if text else [])
        self.waiting_bytes += len(text)
        if self.waiting_bytes >= WAITING_BYTES:
            self.settle()

    def settle(self) -> None:
        """Encodes the segments of the texts that wait, those of all of them together."""
        self.aligner.add(chain.from_iterable(self.waiting))
        lines, known = self.aligner.lines, self.aligner.known
        for parts in self.waiting:
            at = [known[p] for p in parts]
            found = [lines[i] for i in at]
            fine = bool(at) and None not in found
            self.segments.append(np.array(at if fine else [], dtype=np.int32))
            self.digests.append(hashlib.sha256(";".join(found).encode()).hexdigest() if fine else "")
        self.waiting, self.waiting_bytes = [], 0

    def flush(self, block: int, packer: zstandard.ZstdCompressor) -> Iterator[pa.RecordBatch]:
        """The rows of the block. Segments and pairs are numbered anew inside it."""
        self.settle()
        used, flat, times = np.unique(np.concatenate([*self.segments, np.zeros(0, dtype=np.int32)]), return_inverse=True, return_counts=True)
        flat = flat.astype(np.int32)
        lengths = np.array([len(s) for s in self.segments], dtype=np.int64)
        counts = np.array(self.aligner.counts, dtype=np.int64).reshape(-1, 4)[used]
        sizes = counts[:, 3]
        starts = np.array(self.aligner.starts, dtype=np.int64)[used]
        at = np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        pairs, place = np.unique(np.array(self.aligner.pairs)[at], return_inverse=True)
        linked = np.bincount(place, np.repeat(times, sizes), len(pairs)).astype(np.int64) if len(pairs) else pairs
        body = packer.compress(np.concatenate([[len(sizes)], sizes, place]).astype(np.int32).tobytes())
        yield from _table(1, block=[block], kind=[SEGMENTS], body=[body])
        yield from _table(len(pairs), block=np.full(len(pairs), block), kind=np.full(len(pairs), PAIR), at=np.arange(len(pairs)), pair=pairs, n=linked)
        of_docs = [_sums(counts[flat, c], lengths) for c in range(4)]
        ends = np.cumsum(lengths)
        bodies = [packer.compress(flat[e - n:e].tobytes()) if n else None for e, n in zip(ends, lengths)]
        m = len(self.ids)
        yield from _table(
            m, block=np.full(m, block), kind=np.full(m, DOCUMENT), at=self.ids, body=bodies, n_a=of_docs[0], n_b=of_docs[1],
            n_groups=of_docs[2], n_links=of_docs[3], groups_sha256=self.digests,
        )


def encoded_blocks(rows: DataFrame, a_content: bytes, b_content: bytes, block_bytes: int) -> DataFrame:
    """The stored blocks of ``rows`` (``_id`` long, ``_text``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(ByteLevel(a_content), Pieces(b_content))
        packer = zstandard.ZstdCompressor(level=1)
        first = TaskContext.get().partitionId() << 32
        block, n = Block(aligner), 0
        for batch in batches:
            for row, text in zip(batch.column("_id"), batch.column("_text")):
                block.add(row.as_py(), text.as_py())
                if block.bytes >= block_bytes or len(aligner.lines) >= BLOCK_SEGMENTS:
                    yield from block.flush(first + n, packer)
                    if len(aligner.lines) >= BLOCK_SEGMENTS:
                        aligner.clear()
                    block, n = Block(aligner), n + 1
        if block.ids:
            yield from block.flush(first + n, packer)
        del aligner, block
        release_memory()

    return stage(rows.mapInArrow(run, STORED_SQL), "blocks")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair``, ``count``, ``best`` (the highest of its B id): stored."""
    counts = stage(blocks.filter(F.col("kind") == PAIR).groupBy("pair").agg(F.sum("n").alias("count")), "pairs")
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    # A B id has as many pairs as there are A ids, at most.
    highest = counts.groupBy(b.alias("b")).agg(F.max("count").alias("most"))
    return stage(counts.withColumn("b", b).join(highest, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best")), "counts")


DOCUMENT_SQL = "_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
DOCUMENT_OUT = pa.schema([("_id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), ("groups_sha256", pa.string())])


def _rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with what their links count in the corpus. A block's rows come in the order of their kind."""
    packer = zstandard.ZstdDecompressor()
    block, held, values = None, None, None
    for batch in batches:
        kinds, blocks = batch.column("kind").to_numpy(), batch.column("block").to_numpy()
        cuts = np.flatnonzero((np.diff(kinds) != 0) | (np.diff(blocks) != 0)) + 1
        for start, stop in zip([0, *cuts], [*cuts, len(kinds)]):
            part = batch.slice(start, stop - start)
            if blocks[start] != block:
                block, held, values = blocks[start], [], None
            if kinds[start] == SEGMENTS:
                data = np.frombuffer(packer.decompress(part.column("body")[0].as_py()), dtype=np.int32)
                sizes, place = data[1:data[0] + 1].astype(np.int64), data[data[0] + 1:]
                continue
            if kinds[start] == PAIR:
                held.append([part.column(c).to_numpy(zero_copy_only=False) for c in ("at", "count", "best")])
                continue
            if values is None:
                # Each segment's sums over its links.
                count = np.zeros(sum(len(h[0]) for h in held), dtype=np.int64)
                best = np.zeros(len(count), dtype=np.int64)
                for at, c, b in held:
                    count[at], best[at] = c, b
                values = [_sums(v[place], sizes) for v in (best, count)]
                held = []
            rated = []
            for body in part.column("body"):
                own = np.frombuffer(packer.decompress(body.as_py()) if body.is_valid else b"", dtype=np.int32)
                rated.append([int(v[own].sum()) for v in values])
            n_best, total = zip(*rated)
            columns = [part.column(c) for c in ("at", "n_a", "n_b", "n_groups", "n_links")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_best), pa.array(total), part.column("groups_sha256")], schema=DOCUMENT_OUT)
    release_memory()


def align(
    df: DataFrame, a_path: str, b_path: str, text: str = "text", id_col: str = "doc_id", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per input row: id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    ``a_path`` (byte-level, .json) and ``b_path`` (pieces, .model) are read by the driver. ``n_best`` counts a text's links
    whose pair of ids has the most links in the corpus of all pairs of its B id, ``count_sum`` adds up the pairs' counts over
    the text's links. Null and empty texts, and texts that the tokens do not spell again, have zeros and an
    empty digest. The id column is a whole number; null and repeated ids stay as they are. Empty input: no rows.
    """
    contents = []
    for path in (a_path, b_path):
        with open(path, "rb") as file:
            contents.append(file.read())
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("_id"), text_of(text).alias("_text"))
    blocks = encoded_blocks(rows, *contents, block_bytes)
    counts = pair_counts(blocks)
    pairs = blocks.filter(F.col("kind") == PAIR).select("block", "kind", "at", "pair").join(counts.hint("merge"), "pair").drop("pair")
    others = blocks.filter(F.col("kind") != PAIR).drop("pair", "n")
    together = others.unionByName(pairs, allowMissingColumns=True)
    # A block is bounded by its bytes and its segments.
    dealt = together.repartition("block").sortWithinPartitions("block", "kind")
    rated = dealt.mapInArrow(_rated, DOCUMENT_SQL)
    return rated.select(F.col("_id").alias(id_col), *DOCUMENT_OUT.names[1:])
