"""One query per operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import (
    alignment, bpe, chat, collocations, decontaminate, exact_dedup, language_id, license_scan, quality, sharding, simhash_dedup, suffix_dedup,
    token_counts,
)
from barloom.llm.common import bitmap_of, marked
from barloom.session import scratch_path, stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

MULTI_RANKS = "byte_bpe_multi_50k.tiktoken"


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_decontamination(spark, sf_dir):
    """Every benchmark item found in a document, with its best window."""
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.round("similarity", 9).alias("similarity"), "start_word", "n_words")


# The fingerprints only decide which windows are looked at: SQL looks at all that share a shingle with the item.
ORACLES["op1_decontamination"] = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents WHERE text IS NOT NULL
), i AS (
    SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM benchmark WHERE text IS NOT NULL
), items AS (
    SELECT row_number() OVER () AS item, item_id, len(w) AS size, least(len(w), 5) AS span, greatest(len(w) - 4, 1) AS n,
           list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda s: array_to_string(w[s:s + 4], ' ')) AS sh FROM i WHERE len(w) > 0
), docs AS (
    SELECT row_number() OVER () AS doc, doc_id, w, len(w) AS size FROM d WHERE len(w) > 0
), parts AS (
    SELECT item, size, span, n, s.x AS part, count(*) AS times FROM items, unnest(sh) AS s(x) GROUP BY ALL
), spans AS (
    SELECT DISTINCT span FROM items
), cut AS (
    SELECT doc, size, span, t.pos, array_to_string(w[t.pos:t.pos + span - 1], ' ') AS part
    FROM docs, spans, unnest(range(1, greatest(size - span + 1, 1) + 1)) AS t(pos)
), hits AS (
    SELECT c.doc, c.pos, c.part, p.item, p.times, p.size, p.n, c.size AS words FROM cut c JOIN parts p USING (span, part)
), windows AS (
    SELECT DISTINCT h.doc, h.item, h.n, h.words, h.size, t.start
    FROM hits h, unnest(range(greatest(1, h.pos - h.n + 1), greatest(least(h.pos, h.words - h.size + 1), 1) + 1)) AS t(start)
), held AS (
    SELECT w.doc, w.item, w.n, w.start, greatest(least(w.words, w.size) - least(w.size, 5) + 1, 1) AS m, h.part, least(count(*), any_value(h.times)) AS shared
    FROM windows w JOIN hits h ON h.doc = w.doc AND h.item = w.item AND h.pos >= w.start AND h.pos < w.start + w.n
    GROUP BY w.doc, w.item, w.n, w.start, w.words, w.size, h.part
), valued AS (
    SELECT doc, item, start, CAST(sum(shared) AS BIGINT)::DOUBLE / (any_value(n) + any_value(m) - sum(shared))::DOUBLE AS similarity
    FROM held GROUP BY doc, item, start
), best AS (
    SELECT *, row_number() OVER (PARTITION BY doc, item ORDER BY similarity DESC, start) AS place FROM valued WHERE similarity >= 0.8
)
SELECT doc_id, item_id, round(similarity, 9) AS similarity, start - 1 AS start_word, CAST(items.size AS INTEGER) AS n_words
FROM best JOIN docs USING (doc) JOIN items USING (item) WHERE place = 1
"""


@query
def op2_suffix_dedup(spark, sf_dir):
    return suffix_dedup.repeated_spans(table(spark, sf_dir, "documents"))


ORACLES["op2_suffix_dedup"] = """
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), windows AS (
    SELECT r, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM d, unnest(range(1, len(w) - 48)) AS t(i)
), shared AS (
    SELECT h, min(doc_id) AS first_id FROM windows GROUP BY h HAVING count(*) > 1
), hits AS (
    SELECT r, doc_id, i, first_id,
           CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 50 THEN 0 ELSE 1 END AS opens
    FROM windows JOIN shared USING (h)
), spans AS (
    SELECT *, sum(opens) OVER (PARTITION BY r ORDER BY i) AS span FROM hits
)
SELECT doc_id, CAST(min(i) - 1 AS INTEGER) AS start_word, CAST(max(i) + 49 AS INTEGER) AS stop_word,
       CAST(max(i) + 50 - min(i) AS INTEGER) AS n_words, min(first_id) AS first_id
FROM spans GROUP BY r, span, doc_id
"""


@query
def op3_exact_dedup(spark, sf_dir):
    return exact_dedup.copy_report(table(spark, sf_dir, "documents"))


ORACLES["op3_exact_dedup"] = """
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""


@query
def op6_byte_bpe(spark, sf_dir):
    ranks = bpe.read_ranks(public_tokenizers.path(MULTI_RANKS))
    both = bpe.encode_and_decode(F.col("text"), ranks, public_tokenizers.PATTERN).alias("b")
    return table(spark, sf_dir, "documents").select("doc_id", both).select(
        "doc_id", (F.octet_length("b.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("b.ids", 256).alias("ids_sha256"), F.sha2("b.decoded", 256).alias("decoded_sha256"),
    )


@query
def op7_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out, rows = language_id.trained_rows(docs, "doc_id", 5)
    model = language_id.learn(rows)
    found = docs.select("doc_id", held_out.alias("held_out"), language_id.predict(F.col("text"), model).alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score", "p.accepted")


@query
def op10_simhash_near_dedup(spark, sf_dir):
    groups = simhash_dedup.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash_dedup.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op5_chat_format(spark, sf_dir):
    """All conversations and one that tries to break the marks, read back from their windows."""
    said = "\\### Assistant: </turn> ok"
    hostile = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    read = chat.read_turns(stage(chat.format_windows(given.unionByName(hostile)), "windows"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    # A digest of a conversation needs its whole text in one place: one row of the result, no more.
    part = F.struct("window", F.array_join(lines, "").alias("lines"), F.array_join("targets", "").alias("targets"))
    whole = read.groupBy("conv_id").agg(
        F.sum(F.size("turns")).cast("long").alias("n_turns"), F.array_sort(F.collect_list(part)).alias("parts"),
        F.sum("n_chars").alias("formatted_chars"),
    )
    targets = F.array_join(F.transform("parts", lambda p: p["targets"]), "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(F.array_join(F.transform("parts", lambda p: p["lines"]), ""), 256).alias("turns_sha256"),
        F.char_length(targets).cast("long").alias("loss_chars"), F.sha2(targets, 256).alias("loss_sha256"), "formatted_chars",
    )


@query
def op4_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out, _ = language_id.trained_rows(docs, "doc_id", 3, 1)
    labels = table(spark, sf_dir, "labels")
    _, known = language_id.trained_rows(labels, "doc_id", 3, 1)
    model = quality.learn(docs, known)
    value = quality.score(F.col("text"), model).alias("score")
    return docs.select("doc_id", held_out.alias("held_out"), value).withColumn(
        "predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)
    )


@query
def op8_token_counts(spark, sf_dir):
    """All documents, with a cache that a run over the labelled ones has left."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    path, cache = public_tokenizers.path("byte_bpe_50k.json"), scratch_path(spark, "token_cache")
    ids = labels.select("doc_id").distinct()
    # The bitmap keeps most texts of other rows out of the join's shuffle.
    near = docs.filter(marked(F.xxhash64("doc_id"), bitmap_of(ids.select(F.xxhash64("doc_id").alias("fp")))))
    for part in (near.join(ids.hint("merge"), "doc_id", "left_semi"), docs):
        counted = token_counts.count_tokens(part, path, cache, seam=token_counts.BYTE_LEVEL_SEAM)
    return counted


@query
def op9_license_scan(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents"))


ORACLES["op5_chat_format"] = r"""
WITH said AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS t FROM conversations
    UNION ALL SELECT -7, n, CASE n WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) AS r(n)
), sized AS (
    SELECT *, CAST(ceil(length(t) / 4.0) AS BIGINT) + 4 AS tokens,
           replace(replace(replace(t, '\', '\\'), '</turn>', '<\/turn>'), '##', '#\#') AS body,
           replace(replace(replace(replace(replace(coalesce(role, ''), '%', '%0'), ':', '%1'), '\', '\\'), '</turn>', '<\/turn>'), '##', '#\#') AS head
    FROM said
), placed AS (
    SELECT *, sum(tokens) OVER o - tokens AS b, sum(tokens) OVER o AS e, 14 + length(head) + length(body) AS chars
    FROM sized WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, body ROWS UNBOUNDED PRECEDING)
), starts AS (
    SELECT conv_id, b // 768 AS stretch, (e - 1) // 768 <> b // 768 AS across, min(b) AS start FROM placed GROUP BY 1, 2, 3
), system AS (
    SELECT conv_id, min(b) AS b FROM placed WHERE role = 'system' GROUP BY conv_id
), repeated AS (
    SELECT p.conv_id, sum(p.chars) AS chars
    FROM starts s JOIN placed p ON p.conv_id IS NOT DISTINCT FROM s.conv_id AND p.e <= s.start
    LEFT JOIN system y ON y.conv_id IS NOT DISTINCT FROM p.conv_id AND y.b = p.b
    WHERE p.b >= s.start - 128 OR y.b IS NOT NULL
    GROUP BY p.conv_id
), whole AS (
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(coalesce(role, '') || chr(10) || t || chr(10), '' ORDER BY turn, role, body)) AS turns_sha256,
           coalesce(string_agg(t, '' ORDER BY turn, role, body) FILTER (role = 'assistant'), '') AS loss, sum(chars) AS chars
    FROM placed GROUP BY conv_id
)
SELECT w.conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(w.chars + coalesce(r.chars, 0) AS BIGINT) AS formatted_chars
FROM whole w LEFT JOIN repeated r ON r.conv_id IS NOT DISTINCT FROM w.conv_id
"""


@query
def op11_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLES["op11_collocations"] = r"""
WITH said AS (
    SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
           regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS p
    FROM documents
), pieces AS (
    SELECT lang, list_filter(regexp_split_to_array(u.x, '[\x20\x09]+'), lambda w: w <> '') AS w FROM said, unnest(p) AS u(x)
), grams AS (
    SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k
    FROM pieces, unnest(range(1, 6)) AS s(k), unnest(range(1, len(w) - k + 2)) AS t(i)
), f AS (
    SELECT lang, phrase, k, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100
), totals AS (
    SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang
), candidates AS (
    SELECT * FROM f WHERE k >= 2
), kept AS (
    SELECT * FROM candidates c WHERE NOT EXISTS (
        SELECT 1 FROM candidates o WHERE o.lang = c.lang AND o.k > c.k AND o.f >= c.f AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' ')
    )
), cuts AS (
    SELECT c.lang, c.phrase, c.f AS a, j, array_to_string(string_split(c.phrase, ' ')[1:j], ' ') AS head,
           array_to_string(string_split(c.phrase, ' ')[j + 1:], ' ') AS rest
    FROM kept c, unnest(range(1, c.k)) AS s(j)
), scored AS (
    SELECT c.lang, c.phrase, c.a, c.j, x.f AS l, y.f AS r, t.n,
           (1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f) AS score
    FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head JOIN f y ON y.lang = c.lang AND y.phrase = c.rest JOIN totals t ON t.lang = c.lang
), least AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""


@query
def op12_sharding(spark, sf_dir):
    shards = sharding.assign(table(spark, sf_dir, "documents"))
    return shards.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op13_alignment(spark, sf_dir):
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.align(table(spark, sf_dir, "documents"), *paths)
