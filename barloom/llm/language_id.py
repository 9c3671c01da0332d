"""Language ID by compression: the language whose dictionary shortens a text most.

Each language has a raw-content dictionary, a sample of its texts. A text is encoded with each of them and
the shortest encoding wins. Texts are encoded piece by piece, so that a text's own earlier words do not stand in for
the dictionary. Whole bytes are a coarse measure, so the head of every text is encoded several times, from another of
its words on each time, and counts with the mean. A narrow win is a rejection: some bytes for noise, and a share.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import release_memory

#: Bytes of a dictionary, and texts drawn for it at most.
DICTIONARY_BYTES = 32 << 10
SAMPLE_TEXTS = 128
#: More label values than this are an error: each is a dictionary in every task.
MAX_LANGUAGES = 256
#: Bytes encoded at a time.
PIECE = 16 << 10
#: The best size must be smaller than the second best by this share of it and so many bytes. Set on a fold of labelled
#: training rows that gave no dictionary, against the same texts in ROT13.
MARGIN, MARGIN_BYTES = 0.03, 1.0
#: Bytes of the head of a text, and from how many of its words on it is encoded.
HEAD, TURNS = 512, 8
#: Stands before every piece: the encoder stores what it cannot shorten as it is, which would hide that one
#: dictionary fits a few words better than another.
PAD = b"0" * 64

NO_LANGUAGE = "und"
NOT_LETTERS = regex.compile(r"[^\p{L}]+")
LETTER = regex.compile(r"\p{L}")


def letters_of(text: str) -> bytes:
    """What is encoded: lower-cased letters, everything between them as one space."""
    return NOT_LETTERS.sub(" ", text.lower()).encode("utf-8", "replace")


@dataclass
class LanguageModel:
    """``languages`` in order of preference at equal size, and their dictionaries."""

    languages: list[str]
    dictionaries: list[bytes]

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        out = []
        for content in self.dictionaries:
            # Greedy search with matches from three bytes on: syllables count, which the plain levels pass over.
            search = zstandard.ZstdCompressionParameters.from_level(
                3, source_size=PIECE, dict_size=len(content), strategy=zstandard.STRATEGY_GREEDY, min_match=3,
                hash_log=15, chain_log=15, search_log=4, window_log=18,
                write_content_size=False, write_checksum=False, write_dict_id=False,
            )
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(compression_params=search)
            out.append(zstandard.ZstdCompressor(compression_params=search, dict_data=dictionary))
        return out


class Sizes:
    """Encoded bytes of texts by each dictionary of a model, beyond those of nothing."""

    def __init__(self, model: LanguageModel):
        self.compressors = model.compressors()
        self.empty = np.array([len(c.compress(PAD)) for c in self.compressors])

    def of(self, data: bytes) -> np.ndarray:
        """The mean over the turns of the head, and the rest once; pieces end at a blank."""
        stop = len(data)
        if stop > HEAD:
            stop = data.rfind(b" ", 0, HEAD)
            stop = HEAD if stop <= 0 else stop
        words = data[:stop].split(b" ")
        turns = min(TURNS, len(words))
        firsts = [i * (len(words) // turns) for i in range(turns)]
        return sum(self._piece(b" ".join(words[i:] + words[:i])) for i in firsts) / turns + self._pieces(data[stop:])

    def _piece(self, data: bytes) -> np.ndarray:
        return [len(c.compress(PAD + data)) for c in self.compressors] - self.empty

    def _pieces(self, data: bytes) -> np.ndarray:
        sizes = np.zeros(len(self.compressors))
        start = 0
        while start < len(data):
            end = start + PIECE
            if end < len(data):
                end = max(data.rfind(b" ", start, end), start) + 1
                if end == start + 1:
                    end = start + PIECE
            sizes += self._piece(data[start:end])
            start = end
        return sizes


def learn(
    df: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id",
    dictionary_bytes: int = DICTIONARY_BYTES, sample_texts: int = SAMPLE_TEXTS,
) -> LanguageModel:
    """Dictionaries from a sample of the rows of ``df`` with a language: per language at most ``sample_texts``
    texts, drawn by a hash of id and text, and of these an equal share each until ``dictionary_bytes`` are filled.

    The draw is one row per language and hash bucket, so it combines on the map side; rows alike in id, text and
    language are one. Only the sample reaches the driver, ``sample_texts`` texts a language at most. No labelled row: a model without languages, which predicts ``und``.
    """
    named = df.filter(F.col(f"`{lang}`").isNotNull())
    label = F.col(f"`{lang}`").cast("string").alias("_lang")
    own = [F.col(f"`{id_col}`"), F.col(f"`{text}`")]
    draw = F.xxhash64(*own, F.lit(7)).alias("_draw")
    bucket = F.pmod(F.xxhash64(*own, F.lit(8)), F.lit(sample_texts)).alias("_bucket")
    drawn = named.select(label, draw, bucket).groupBy("_lang", "_bucket").agg(F.min("_draw").alias("_draw"), F.count("*").alias("n"))
    picks = drawn.limit(MAX_LANGUAGES * sample_texts + 1).collect()
    counts: dict[str, int] = {}
    for row in picks:
        counts[row["_lang"]] = counts.get(row["_lang"], 0) + row["n"]
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(counts, key=lambda k: (-counts[k], k))
    if not languages:
        return LanguageModel([], [])
    spark = df.sparkSession
    schema = T.StructType([T.StructField("_lang2", T.StringType()), T.StructField("_draw2", T.LongType())])
    picked = F.broadcast(spark.createDataFrame([(r["_lang"], r["_draw"]) for r in picks], schema))
    body = F.left(F.col(f"`{text}`").cast("string"), F.lit(dictionary_bytes)).alias("_text")
    texts = named.select(label, draw, body).join(picked, (F.col("_lang") == F.col("_lang2")) & (F.col("_draw") == F.col("_draw2")))
    texts = texts.dropDuplicates(["_lang", "_draw"])
    parts: dict[str, list[tuple[int, bytes]]] = {name: [] for name in languages}
    for name, order, content in texts.select("_lang", "_draw", "_text").toLocalIterator():
        parts[name].append((order, letters_of(content or "")))
    return LanguageModel(languages, [_dictionary([p for _, p in sorted(parts[name])], dictionary_bytes) for name in languages])


def _dictionary(texts: list[bytes], limit: int) -> bytes:
    """An equal share of every drawn text, so that one long or odd text does not fill the dictionary."""
    out, left = [], limit
    texts = sorted(texts, key=len)
    for i, t in enumerate(texts):
        share = t[: left // (len(texts) - i)]
        out.append(share)
        left -= len(share) + 1
    return b" ".join(out)[:limit] or b" "


RESULT = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("accepted", pa.bool_())])


def predict(text: Column, model: LanguageModel, margin: float = MARGIN, margin_bytes: float = MARGIN_BYTES) -> Column:
    """``lang``, ``score`` and ``accepted`` of each text.

    ``score`` is the share by which the best encoding is smaller than the second best (1 if only one
    language is known). ``accepted``: it is smaller by ``margin`` of the second best and ``margin_bytes``. NULL, empty
    texts and texts without a letter: ``und``, 0, false. Equal sizes: the language with more learned rows, not accepted.
    """

    @F.arrow_udf("struct<lang: string, score: double, accepted: boolean>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoded = Sizes(model)
        for texts in batches:
            out = []
            for value in texts:
                content = value.as_py()
                if not model.languages or content is None or not LETTER.search(content):
                    out.append({"lang": NO_LANGUAGE, "score": 0.0, "accepted": False})
                    continue
                sizes = encoded.of(letters_of(content).strip(b" "))
                best = int(np.argmin(sizes))
                score, accepted = 1.0, True
                if len(sizes) > 1:
                    second = float(np.partition(sizes, 1)[1])
                    saved = second - float(sizes[best])
                    score = min(1.0, saved / max(second, 1.0))
                    accepted = saved > 0 and saved >= margin * second + margin_bytes
                out.append({"lang": model.languages[best], "score": score, "accepted": accepted})
            yield pa.array(out, type=RESULT)
        release_memory()

    return run(text)


def trained_rows(df: DataFrame, id_col: str, parts: int, held_out: int = 0) -> tuple[Column, DataFrame]:
    """Whether a row is held out (crc32 of the id as text, modulo ``parts``), and the rows that are not."""
    remainder = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % parts
    out = F.coalesce(remainder == held_out, F.lit(False))
    return out, df.filter(~out)


def identify(
    df: DataFrame, model: LanguageModel, text: str = "text", id_col: str = "doc_id", margin: float = MARGIN, margin_bytes: float = MARGIN_BYTES
) -> DataFrame:
    """One row per input row: id, ``lang_pred``, ``score``, ``accepted``."""
    found = df.select(F.col(f"`{id_col}`").alias("_id"), predict(F.col(f"`{text}`").cast("string"), model, margin, margin_bytes).alias("_p"))
    return found.select(F.col("_id").alias(id_col), F.col("_p.lang").alias("lang_pred"), "_p.score", "_p.accepted")


def keep_identified(
    df: DataFrame, model: LanguageModel, text: str = "text", margin: float = MARGIN, margin_bytes: float = MARGIN_BYTES
) -> DataFrame:
    """The rows of ``df`` whose language is accepted, columns unchanged."""
    found = df.select(F.struct("*").alias("_row"), predict(F.col(f"`{text}`").cast("string"), model, margin, margin_bytes).alias("_p"))
    return found.filter("_p.accepted").select("_row.*")
