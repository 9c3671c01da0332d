"""Byte-level BPE by merge replay over a corpus of distinct words, and decoding.

A block of texts is cut into words by the vocabulary's pattern. Its distinct new words form the corpus: an
inverted index leads from the rank of each adjacent token pair to the positions where it stands, and ranks
are replayed in order over all words at once. A merge touches two neighbours only; the pairs they now form
enter the index. Words already encoded in this partition are looked up.

Ids travel packed, as little-endian unsigned 32-bit integers in a binary column.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom.llm.common import release_memory

#: Characters cut into words at a time, words of a block, and distinct words remembered in a partition.
PART_CHARS = 1 << 18
BLOCK_WORDS = 1_000_000
MEMO_WORDS = 160_000
#: Texts that go back to Spark at a time.
OUT_TEXTS = 256
#: Between a visible character and white space no word of the pattern goes on, so texts may be cut there.
SEAM = re.compile(r"(?<=[^\s])[ \n]")
NONE = -1


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank files: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class MergeReplay:
    """Encodes lists of words by the merges of ``ranks``."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.first = np.array([ranks.get(bytes([b]), NONE) for b in range(256)], dtype=np.int32)
        self.pairs: dict[int, int] = {}
        self.hasty = self._hasty()

    def _hasty(self) -> set[int]:
        """Ranks whose merge can make a pair of a lower rank: that pair must go before further such merges."""
        out = set()
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    out.update(part for part, size in ((left, cut), (right, len(token) - cut)) if size > 1 and part >= rank)
        return out

    def rank(self, pair: int) -> int:
        """The rank at which two tokens merge; a pair is the left token, 32 bits up, and the right one."""
        found = self.pairs.get(pair)
        if found is None:
            both = self.bytes_of[pair >> 32] + self.bytes_of[pair & 0xFFFFFFFF]
            found = self.pairs[pair] = self.ranks.get(both, NONE)
        return found

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The packed ids of each word. A word that is a token is that token."""
        out: list[bytes] = [b""] * len(words)
        corpus = []
        for i, word in enumerate(words):
            whole = self.ranks.get(word)
            if whole is None:
                corpus.append(i)
            else:
                out[i] = whole.to_bytes(4, "little")
        for i, ids in zip(corpus, self._replay([words[i] for i in corpus])):
            out[i] = ids
        return out

    def _replay(self, words: list[bytes]) -> Iterator[bytes]:
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        if not lengths.sum():
            yield from (b"" for _ in words)
            return
        ends = np.cumsum(lengths)
        token = self.first[np.frombuffer(b"".join(words), dtype=np.uint8)]
        if (token < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        word_of = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        places = np.arange(len(token), dtype=np.int32)
        before, after = places - 1, places + 1
        before[np.concatenate([[0], ends[:-1]])[lengths > 0]] = NONE
        after[ends[lengths > 0] - 1] = NONE
        ranks = self._ranks_from(places, token, after)
        index: dict[int, list[int]] = {}
        queue: list[int] = []
        self._enter(index, queue, places, ranks)
        alive = np.ones(len(token), dtype=bool)
        while queue:
            rank = heapq.heappop(queue)
            at = np.unique(index.pop(rank))
            at = at[ranks[at] == rank]
            if not len(at):
                continue
            if rank in self.hasty:
                # One merge a word; the others are queued again, behind what may come up before them.
                own = word_of[at]
                later = np.concatenate([[False], own[1:] == own[:-1]])
                self._enter(index, queue, at[later], ranks[at[later]])
                at = at[~later]
            elif (ranks[after[at]] == rank).any():
                at = self._leftmost(at, after)
            gone = after[at]
            token[at] = rank
            alive[gone] = False
            ranks[gone] = NONE
            follower = after[gone]
            after[at] = follower
            followed = follower != NONE
            before[follower[followed]] = at[followed]
            leader = before[at]
            touched = np.concatenate([at, leader[leader != NONE]])
            ranks[touched] = new = self._ranks_from(touched, token, after)
            self._enter(index, queue, touched, new)
        packed = token[alive].astype("<u4").tobytes()
        stops = (4 * np.concatenate([[0], np.cumsum(alive)])[ends]).tolist()
        for start, stop in zip([0, *stops], stops):
            yield packed[start:stop]

    def _ranks_from(self, places: np.ndarray, token: np.ndarray, after: np.ndarray) -> np.ndarray:
        """The rank of the pair that starts at each place."""
        out = np.full(len(places), NONE, dtype=np.int32)
        paired = np.nonzero(after[places] != NONE)[0]
        starts = places[paired]
        keys = token[starts].astype(np.int64) << 32 | token[after[starts]]
        if len(keys) > 64:
            keys, kind = np.unique(keys, return_inverse=True)
            out[paired] = np.array([self.rank(k) for k in keys.tolist()], dtype=np.int32)[kind]
        else:
            out[paired] = [self.rank(k) for k in keys.tolist()]
        return out

    @staticmethod
    def _leftmost(at: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Of pairs that overlap, as in a run of one letter, every other from the left."""
        out, gone = [], NONE
        for place, following in zip(at.tolist(), after[at].tolist()):
            if place != gone:
                out.append(place)
                gone = following
        return np.array(out)

    @staticmethod
    def _enter(index: dict[int, list[int]], queue: list[int], places: np.ndarray, ranks: np.ndarray) -> None:
        listed = ranks != NONE
        places, ranks = places[listed], ranks[listed]
        if len(places) > 64:
            order = np.argsort(ranks, kind="stable")
            ranks = ranks[order]
            cuts = [0, *(np.nonzero(np.diff(ranks))[0] + 1).tolist(), len(ranks)]
            ordered = places[order].tolist()
            groups = zip(ranks[cuts[:-1]].tolist(), (ordered[i:j] for i, j in zip(cuts, cuts[1:])))
        else:
            groups = zip(ranks.tolist(), ([p] for p in places.tolist()))
        for rank, group in groups:
            held = index.get(rank)
            if held is None:
                index[rank] = group
                heapq.heappush(queue, rank)
            else:
                held += group


def seams(text: str, size: int | None = None) -> Iterator[str]:
    """``text`` in parts of about ``size`` characters whose words are the words of the text."""
    start = 0
    size = size or PART_CHARS
    while len(text) - start > size:
        found = SEAM.search(text, start + size)
        if not found:
            break
        yield text[start:found.start()]
        start = found.start()
    yield text[start:]


class TextEncoder:
    """Texts to packed ids, a block of texts at a time."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo_words: int = MEMO_WORDS):
        self.replay, self.split = MergeReplay(ranks), regex.compile(pattern).findall
        self.memo_words = memo_words
        self._forget()

    def _forget(self, kept: dict[str, bytes] | None = None) -> None:
        """Starts the memo anew with ``kept``."""
        self.number: dict[str, int] = defaultdict(count().__next__)
        self.packed = list((kept or {}).values())
        for word in kept or ():
            self.number[word]
        self.used = np.zeros(0, dtype=np.int64)

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The texts are held as numbers of words until a block is full."""
        block: list[np.ndarray] = []
        size = 0
        for text in texts:
            parts = [np.array(list(map(self.number.__getitem__, self.split(part))), dtype=np.int32) for part in seams(text)]
            block.append(np.concatenate(parts))
            size += len(block[-1])
            if size >= BLOCK_WORDS:
                yield from self._finish(block)
                block, size = [], 0
        yield from self._finish(block)

    def _finish(self, block: list[np.ndarray]) -> Iterator[bytes]:
        new = list(islice(self.number, len(self.packed), None))
        self.packed.extend(self.replay.encode([w.encode("utf-8", "replace") for w in new]))
        look_up = self.packed.__getitem__
        for words in block:
            yield b"".join(map(look_up, words.tolist()))
        if block:
            used = np.bincount(np.concatenate(block), minlength=len(self.packed))
            used[: len(self.used)] += self.used
            self.used = used
        if len(self.number) > self.memo_words:
            # Words met once are the most; those met again are worth their place.
            again = np.nonzero(self.used > 1)[0]
            words = list(self.number)
            kept = {words[i]: self.packed[i] for i in again.tolist()}
            self._forget(kept if len(kept) <= self.memo_words // 2 else None)


def _decoder(ranks: dict[bytes, int]) -> Callable[[bytes], bytes]:
    look_up = {rank: token for token, rank in ranks.items()}.__getitem__
    return lambda ids: b"".join(map(look_up, unpack(ids).tolist()))


def encode(text: Column, ranks: dict[bytes, int], pattern: str) -> Column:
    """Packed ids of each text. NULL and empty texts: no ids. Special tokens are ordinary text."""

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = TextEncoder(ranks, pattern)
        ids = encoder.encode(t.as_py() or "" for texts in batches for t in texts)
        while part := list(islice(ids, OUT_TEXTS)):
            yield pa.array(part, type=pa.binary())
        del ids, encoder
        release_memory()

    return run(text)


def decode(ids: Column, ranks: dict[bytes, int]) -> Column:
    """The bytes that packed ids stand for; an unknown id is an error. NULL: no bytes."""

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoded = _decoder(ranks)
        for packed in batches:
            yield pa.array((decoded(p.as_py() or b"") for p in packed), type=pa.binary())

    return run(ids)


BOTH = pa.struct([("ids", pa.binary()), ("decoded", pa.binary())])


def encode_and_decode(text: Column, ranks: dict[bytes, int], pattern: str) -> Column:
    """``ids`` as by ``encode`` and ``decoded`` as by ``decode`` of them, in one Python worker."""

    @F.arrow_udf("struct<ids: binary, decoded: binary>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, decoded = TextEncoder(ranks, pattern), _decoder(ranks)
        ids = encoder.encode(t.as_py() or "" for texts in batches for t in texts)
        while part := list(islice(ids, OUT_TEXTS)):
            yield pa.array([{"ids": p, "decoded": decoded(p)} for p in part], type=BOTH)
        del ids, encoder
        release_memory()

    return run(text)


def unpack(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, dtype="<u4")
