"""Token counts with a digest cache.

A text is known by the SHA-256 of its content, a tokenizer by the SHA-256 of its file. Counts are looked up
under both digests in a stored cache; texts that are not there are encoded once each, however often they
occur, and appended. The only normalisation that leaves every count as it is takes NULL as empty.

No text is shuffled. Digests alone tell which texts are missing and which of the rows that share one stands for it. A
bitmap of these rows goes to the tasks that read the texts, and what it lets through is encoded there. A bit set by
chance lets a row more through, whose count is dropped: the bitmap decides about cost, never about a result.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import Bitmap, bitmap_of, release_memory, text_of
from barloom.session import stage, staged

CACHE_SCHEMA = "content binary, tokenizer string, n_tokens long"
#: For byte-level BPE: no token reaches from a visible character over the white space behind it, so counts
#: of the parts of a text, cut there, add up to the count of the text.
BYTE_LEVEL_SEAM = r"(?<=\S)(?=[ \n])"
#: Texts, or parts of texts, encoded in one call, and parts remembered in a partition.
BATCH = 4_096
MEMO_PARTS = 400_000


class Counter:
    """Counts tokens with the library of the file: ``tokenizers`` for .json, ``sentencepiece`` for .model."""

    def __init__(self, content: bytes, kind: str, seam: str | None):
        if kind == "json":
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            encode = Tokenizer.from_str(content.decode()).encode_batch_fast
            self.lengths = lambda texts: [len(e.ids) for e in encode(texts, add_special_tokens=False)]
        elif kind == "model":
            import sentencepiece

            encode = sentencepiece.SentencePieceProcessor(model_proto=content).encode
            self.lengths = lambda texts: [len(ids) for ids in encode(texts, num_threads=1)]
        else:
            raise ValueError(f"no library for .{kind} files")
        self.cut = re.compile(seam).split if seam else None
        self.memo: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        if self.cut is None:
            return self._batched(texts)
        return [sum(self._parts(text)) for text in texts]

    def _parts(self, text: str) -> Iterator[int]:
        """A long text goes through in stretches, so that its parts are never all held at once."""
        start = 0
        while start < len(text):
            end = start + (1 << 20)
            seam = re.search(r"(?<=\S)[ \n]", text[end:]) if end < len(text) else None
            stop = end + seam.start() if seam and seam.start() else len(text)
            parts = self.cut(text[start:stop])
            new = list({p for p in parts if p not in self.memo})
            self.memo.update(zip(new, self._batched(new)))
            yield sum(map(self.memo.__getitem__, parts))
            if len(self.memo) > MEMO_PARTS:
                self.memo.clear()
            start = stop

    def _batched(self, texts: list[str]) -> list[int]:
        return [n for i in range(0, len(texts), BATCH) for n in self.lengths(texts[i:i + BATCH])]


def counted(rows: DataFrame, known: Bitmap | None, content: bytes, kind: str, seam: str | None = None) -> DataFrame:
    """``content``, ``n_tokens`` of the ``rows`` (``content``, ``_key``, ``_text``) whose key is in ``known``, or of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(content, kind, seam)
        for batch in batches:
            if known is not None:
                batch = batch.filter(pa.array(known.has(batch.column("_key").to_numpy().view(np.uint64))))
            # Few whole texts at a time: they may be long.
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                values = pa.array(counter.count(part.column("_text").to_pylist()), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("content"), values], ["content", "n_tokens"])
        del counter
        release_memory()

    return rows.select("content", "_key", "_text").mapInArrow(run, "content binary, n_tokens long")


def read_cache(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """``content``, ``n_tokens`` of a tokenizer's digest. A text that two runs appended counts once."""
    try:
        cache = spark.read.schema(CACHE_SCHEMA).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        cache = spark.createDataFrame([], CACHE_SCHEMA)
    return cache.filter(F.col("tokenizer") == tokenizer).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(
    df: DataFrame, tokenizer_path: str, cache_path: str, text: str = "text", id_col: str = "doc_id",
    limit: int = 1024, seam: str | None = None,
) -> DataFrame:
    """One row per input row: id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit``.

    ``tokenizer_path`` is read by the driver. ``cache_path`` is a shared folder; texts it lacks are encoded
    once and appended. ``seam`` is a pattern at which the tokenizer's counts add up; None encodes whole
    texts. Null and empty texts have no bytes and the tokens the library gives an empty text. Null or
    repeated ids stay as they are. Empty input: no rows.
    """
    spark = df.sparkSession
    with open(tokenizer_path, "rb") as file:
        content = file.read()
    kind = tokenizer_path.rsplit(".", 1)[-1]
    version = hashlib.sha256(content).hexdigest()
    body = text_of(text)
    digest = F.unhex(F.sha2(body, 256))
    row_id = F.col(f"`{id_col}`")

    def append(counts: DataFrame) -> None:
        counts.select("content", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache_path)

    read = df.select(row_id.alias("_id"), digest.alias("content"), body.alias("_text"), F.xxhash64(row_id, digest).alias("_key"))
    rows = stage(read.select("_id", "content", "_key", F.octet_length("_text").cast("long").alias("n_bytes")), "digests")
    missing = rows.join(read_cache(spark, cache_path, version), "content", "left_anti")
    # The row of the smallest key stands for its text. Rows alike in id and text have one key: one of their counts is taken.
    with staged(missing.groupBy("content").agg(F.min("_key").alias("fp")), "missing") as wanted:
        counts = counted(read, bitmap_of(wanted), content, kind, seam).dropDuplicates(["content"])
        append(counts.join(wanted, "content", "left_semi"))
        # Only if the ids came out otherwise when the rows were read again: such texts are brought together.
        left = wanted.join(read_cache(spark, cache_path, version), "content", "left_anti").select("content")
        if not left.isEmpty():
            append(counted(read.join(left, "content", "left_semi").dropDuplicates(["content"]), None, content, kind, seam))
    # Stored, so that the join's rows are not tied to an aggregate: a text that many rows share can then be split.
    known = stage(rows.select("content").distinct().join(read_cache(spark, cache_path, version), "content"), "known")
    return rows.join(known.hint("merge"), "content").select(
        F.col("_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
