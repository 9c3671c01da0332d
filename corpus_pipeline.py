"""The document pipeline: language, exact copies, near copies, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is stored as Parquet and read again
for the next one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import bpe, decontaminate, exact_dedup, language_id, simhash_dedup
from barloom.session import remove, scratch_path

RANKS = "byte_bpe_multi_50k.tiktoken"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language, or with a narrow choice of two, go."""
    _, rows = language_id.trained_rows(docs, "doc_id", 5)
    return language_id.keep_identified(docs, language_id.learn(rows))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.drop_near_copies(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token ids of each document, and whether they decode to its text."""
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    both = bpe.encode_and_decode(F.col("text"), ranks, public_tokenizers.PATTERN).alias("b")
    same = F.col("b.decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return docs.select("doc_id", "lang", "source", "text", both).select(
        "doc_id", "lang", "source", (F.octet_length("b.ids") / 4).cast("long").alias("n_tokens"),
        same.alias("round_trip"), F.col("b.ids").alias("token_ids"),
    )


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("byte_bpe", tokenize),
]

#: SQL can express neither the compression nor the merges; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, keep_stages: bool = False) -> DataFrame:
    """The stages in order. A stage's rows go once the next one's are stored, unless they are to be kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, step in STAGES:
        kept, path = step(spark, docs, sf_dir), scratch_path(spark, name)
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if before and not keep_stages:
            remove(spark, before)
        before = path
    return docs
