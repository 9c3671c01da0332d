"""The pipeline, stage by stage, against brute force on its own input."""

import hashlib

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from barloom.llm import bpe, decontaminate, exact_dedup, simhash_dedup

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, step in corpus_pipeline.STAGES:
        step(spark, out[-1], SF).write.parquet(f"file://{folder}/{name}")
        out.append(spark.read.parquet(f"file://{folder}/{name}"))
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.collect())


def test_language_keeps_documents(stored):
    assert stored[1].schema == stored[0].schema
    assert stored[1].count() >= 0.97 * stored[0].count()


def test_language_stage_drops_a_language_outside_the_dictionaries(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    turned = F.translate(F.lower("text"), "abcdefghijklmnopqrstuvwxyz", "nopqrstuvwxyzabcdefghijklm")
    foreign = docs.filter("octet_length(text) >= 1000").select(
        (F.col("doc_id") + 10**9).alias("doc_id"), turned.alias("text"), F.lit(None).cast("string").alias("lang"), "source", "n_chars"
    )
    got = ids(corpus_pipeline.identify_language(spark, docs.unionByName(foreign.select(docs.columns)), SF))
    assert sum(i >= 10**9 for i in got) < 0.05 * foreign.count()
    assert sum(i < 10**9 for i in got) >= 0.97 * docs.count()


def test_exact_stage(stored):
    first = {}
    for r in sorted(stored[1].collect(), key=lambda r: r["doc_id"]):
        first.setdefault(exact_dedup.normalised(r["text"]), r["doc_id"])
    assert ids(stored[2]) == sorted(first.values()) and stored[2].columns == stored[0].columns


def test_near_stage(stored):
    rows = sorted(stored[2].collect(), key=lambda r: r["doc_id"])
    prints = [simhash_dedup.fingerprint_of(r["text"]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                group = [group[j] if g == group[i] else g for g in group]
    assert ids(stored[3]) == [rows[g]["doc_id"] for g in sorted(set(group))]


def test_leak_stage(spark, stored):
    bench = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = []
    for r in stored[3].collect():
        words = decontaminate.words_of(r["text"])
        held = set(decontaminate.shingles_of(words))
        hit = False
        for text in bench:
            own = decontaminate.shingles_of(decontaminate.words_of(text))
            size = len(decontaminate.words_of(text))
            if not held & set(own):
                continue
            hit |= any(
                decontaminate.weighted_similarity(decontaminate.shingles_of(words[s:s + size]), own) >= 0.8
                for s in range(max(1, len(words) - size + 1))
            )
        if not hit:
            clean.append(r["doc_id"])
    assert ids(stored[4]) == sorted(clean)


def test_tokens_of_the_last_stage(stored):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r["doc_id"]: r["text"] for r in stored[4].collect()}
    rows = stored[5].collect()
    assert sorted(texts) == ids(stored[5]) and all(r["round_trip"] for r in rows)
    for r in rows:
        assert bpe.unpack(r["token_ids"]).tolist() == library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] * 4 == len(r["token_ids"])


def test_run_is_the_stages(spark, stored):
    digest = lambda df: {r["doc_id"]: hashlib.sha256(r["token_ids"]).hexdigest() for r in df.collect()}
    assert digest(corpus_pipeline.run(spark, SF)) == digest(stored[5])


@pytest.mark.parametrize("name, step", corpus_pipeline.STAGES)
def test_stages_take_odd_rows(spark, stored, name, step):
    docs = stored[0].withColumn("_id", F.lit(1)).withColumn("_text", F.lit("x")).withColumn("fp", F.lit(2))
    odd = docs.limit(3).select(
        F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("lang"),
        F.lit(None).cast("string").alias("source"), F.lit(None).cast("long").alias("n_chars"), "_id", "_text", "fp",
    )
    out = step(spark, docs.unionByName(docs.limit(20)).unionByName(odd), SF)
    if name != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == docs.columns
    assert out.count() > 0
    assert step(spark, docs.filter("false"), SF).count() == 0
