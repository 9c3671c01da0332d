"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of a sample of labelled documents are cut into bins; each tree grows level by level from
histograms of gradients. The finished trees are flattened into arrays, so that scoring walks all trees of
a batch of documents at once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import release_memory
from barloom.session import stage

#: Labelled documents learned from, at most (drawn by a hash of id, label and text).
TRAIN_ROWS = 20_000
BINS = 64
TREES = 80
DEPTH = 5
RATE = 0.15
MIN_WEIGHT = 5.0
SMOOTH = 1.0

MARKS = "!*$%&#|@=<>{}[]()_\"'.,;:?-/\\"
STATISTICS = [
    "chars", "words", "lines", "word_length", "distinct_words", "top_word", "repeated_next", "distinct_lines", "line_words",
    "upper", "lower", "digits", "blank", "wide", "marks", "longest_word", "short_words", "ended_lines", "distinct_pairs", "capital_words",
    *(f"mark_{ord(m)}" for m in MARKS),
]


def statistics(text: str) -> list[float]:
    """The document statistics, in the order of ``STATISTICS``. No words: zeros but for the counts."""
    data = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8), minlength=256)
    size = max(1, int(data.sum()))
    words = text.split()
    n = max(1, len(words))
    lines = [line for line in text.split("\n") if line]
    m = max(1, len(lines))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) if words else np.zeros(1, dtype=np.int64)
    counts = Counter(words)
    values = [
        np.log1p(len(text)), np.log1p(len(words)), np.log1p(len(lines)), float(lengths.mean()), len(counts) / n,
        max(counts.values(), default=0) / n, sum(map(str.__eq__, words, words[1:])) / n, len(set(lines)) / m, len(words) / m,
        data[65:91].sum() / size, data[97:123].sum() / size, data[48:58].sum() / size, (data[32] + data[9:14].sum()) / size,
        data[128:].sum() / size, data[33:48].sum() / size, np.log1p(lengths.max()), float((lengths <= 2).mean()),
        sum(line.endswith((".", "!", "?")) for line in lines) / m, len(set(zip(words, words[1:]))) / n,
        sum(map(str.istitle, words)) / n,
    ]
    return [float(v) for v in values] + [float(data[ord(mark)]) / size for mark in MARKS]


@dataclass
class Trees:
    """Complete binary trees of one depth, flattened: node i has the children 2i+1 and 2i+2."""

    feature: np.ndarray  # tree x inner node
    threshold: np.ndarray  # tree x inner node; larger values go right
    leaf: np.ndarray  # tree x leaf
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 for rows of statistics."""
        out = np.empty(len(x))
        for start in range(0, len(x), 4096):
            part = x[start:start + 4096]
            rows = np.arange(len(part))[:, None]
            trees = np.arange(len(self.feature))[None, :]
            node = np.zeros((len(part), len(self.feature)), dtype=np.int64)
            inner = self.feature.shape[1]
            for _ in range(int(np.log2(inner + 1))):
                node = 2 * node + 1 + (part[rows, self.feature[trees, node]] > self.threshold[trees, node])
            out[start:start + 4096] = self.base + self.leaf[trees, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-out))


def fit(
    x: np.ndarray, y: np.ndarray, times: np.ndarray | None = None, trees: int = TREES, depth: int = DEPTH, bins: int = BINS
) -> Trees:
    """Boosted trees for labels 0 and 1 of rows that count ``times`` each. No rows: every score is one half;
    one class: close to it."""
    n, width = x.shape
    inner = 2**depth - 1
    feature = np.zeros((trees, inner), dtype=np.int64)
    threshold = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, inner + 1))
    if not n:
        return Trees(feature, threshold, leaf, 0.0)
    times = np.ones(n) if times is None else times
    share = ((y * times).sum() + 0.5) / (times.sum() + 1)
    base = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(width)], axis=1)
    cells = binned + np.arange(width) * bins
    raw = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        gradient, weight = (y - p) * times, p * (1 - p) * times
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (width * bins) + cells).ravel()
            shape = (count, width, bins)
            g = np.bincount(at, np.repeat(gradient, width), count * width * bins).reshape(shape).cumsum(axis=2)
            h = np.bincount(at, np.repeat(weight, width), count * width * bins).reshape(shape).cumsum(axis=2)
            g_all, h_all = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + SMOOTH) + (g_all - g) ** 2 / (h_all - h + SMOOTH) - g_all**2 / (h_all + SMOOTH)
            gain[(h < MIN_WEIGHT) | (h_all - h < MIN_WEIGHT)] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            for i in range(count):
                f, b = divmod(int(best[i]), bins)
                if gain[i, f, b] > 1e-9 and b < len(edges[f]):
                    feature[t, first + i], threshold[t, first + i] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > threshold[t, node])
        place = node - inner
        g = np.bincount(place, gradient, inner + 1)
        h = np.bincount(place, weight, inner + 1)
        leaf[t] = RATE * g / (h + SMOOTH)
        raw += leaf[t][place]
    return Trees(feature, threshold, leaf, base)


def statistics_of(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([statistics(t.as_py() or "") for t in texts], type=pa.list_(pa.float64()))

    return run(text)


def learn(
    df: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", label: str = "quality", train_rows: int = TRAIN_ROWS
) -> Trees:
    """Trees from the rows of ``df`` that ``labels`` marks 0 or 1, at most ``train_rows`` of them.

    ``labels`` has the same id column. Rows without id or label are left out; a document with several labels is
    learned with each. Rows alike in id, label and text are one that counts as often. Those with the smallest hashes are
    drawn; the driver and the broadcasts get the drawn rows only.
    """
    key = F.col(f"`{id_col}`")
    marked = labels.select(key.alias("_id"), F.col(f"`{label}`").cast("int").alias("_label")).filter("_id is not null and _label in (0, 1)")
    marked = marked.groupBy("_id", "_label").agg(F.count("*").alias("_n"))
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = df.select(key.alias("_id"), F.xxhash64(body).alias("_key"))
    known = stage(rows.join(marked, "_id").groupBy("_id", "_label", "_key").agg(F.sum("_n").alias("_times")), "labelled")
    order = F.xxhash64("_id", "_label", "_key", F.lit(11))
    share = 1_000_000 * train_rows // max(known.count(), train_rows)
    about = known.filter(F.pmod(order, F.lit(1_000_000)) < share)
    drawn = stage(about.orderBy(order, "_id", "_label", "_key").limit(train_rows), "drawn")
    drawn = F.broadcast(drawn.withColumnsRenamed({"_id": "_id2", "_key": "_key2"}))
    found = df.select(key.alias("_id"), F.xxhash64(body).alias("_key"), body.alias("_text"))
    found = found.join(drawn, (F.col("_id") == F.col("_id2")) & (F.col("_key") == F.col("_key2"))).dropDuplicates(["_id", "_label", "_key"])
    learned = found.select("_id", "_label", "_times", statistics_of(F.col("_text")).alias("s")).collect()
    learned = sorted(learned, key=lambda r: (str(r["_id"]), r["_label"], r["s"]))
    x = np.array([r["s"] for r in learned]).reshape(len(learned), len(STATISTICS))
    return fit(x, *(np.array([r[c] for r in learned], dtype=float) for c in ("_label", "_times")))


def score(text: Column, model: Trees) -> Column:
    """The quality of each text, 0 to 1. NULL counts as empty; an empty text is scored like any other."""

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            x = np.array([statistics(t.as_py() or "") for t in texts]).reshape(len(texts), len(STATISTICS))
            yield pa.array(model.scores(x))
        release_memory()

    return run(text)


def scored(df: DataFrame, model: Trees, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: id, ``score``, ``predicted`` (1 from one half on)."""
    rows = df.select(F.col(f"`{id_col}`").alias("_id"), score(F.col(f"`{text}`").cast("string"), model).alias("_score"))
    return rows.select(
        F.col("_id").alias(id_col), F.col("_score").alias("score"), F.when(F.col("_score") >= 0.5, 1).otherwise(0).alias("predicted")
    )
