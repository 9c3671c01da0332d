"""CSV whose quoted values hold line breaks, read by many tasks a file.

Whether a line break ends a record depends on all quotes before it. A range of the file cannot see these, but it can
tell where it would end up from either start, outside or inside quotes: a function of two states. The functions of
the ranges before, composed in order, tell every range how it opens. Then each range cuts its own records; only
what reaches over a border, a head and a tail for each range at most, is put together across ranges.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.session import stage

# What a row of a range is: a whole record, the end of one that opened before, all inside one, the start of one.
RECORD, HEAD, THROUGH, TAIL = range(4)

RANGE_SETTINGS = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
TASKS_SETTING = "spark.sql.files.maxPartitionNum"

# Tasks a core, where the files are small, so that no core waits for the last one.
TASKS_PER_CORE = 4


def csv_records(
    spark: SparkSession, path: str | Sequence[str], sep: str = ",", quote: str = '"', range_bytes: int | None = None
) -> DataFrame:
    """``file``, ``first`` (of its file) and ``record`` of CSV files: the text of each record, line breaks in quotes and all.

    A quote opens a value at its very start only; inside, two quotes are one; behind the closing one the value goes on to
    the separator. Lines end as the first of their file does, in LF or CRLF; in CRLF files line breaks in quotes come
    out as LF. Blank lines between records are left out. The records are stored,
    since two passes over the files precede. ``range_bytes`` sets the ranges apart from the session's own setting; a task
    then reads many of them.
    """
    # LF alone, so that a CR inside quotes stays.
    lines = spark.read.option("lineSep", "\n").text(path)
    with _ranged(spark, lines, range_bytes):
        lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
        ends = lines.mapInArrow(_range_ends(sep, quote), "file string, start long, from_out boolean, from_in boolean, crlf boolean")
        opened = stage(_opened(ends), "ranges")
        # One short row for each range of the input, some 100 bytes for 128 MB; no hash join keeps the lines in order otherwise.
        known = lines.join(F.broadcast(opened), ["file", "start"], "left")
        inside = F.coalesce("inside", F.raise_error(F.lit("the files' ranges changed between two passes")).cast("boolean"))
        pieces = known.select("value", "file", "start", inside.alias("inside"), "crlf").mapInArrow(
            _cut_records(sep, quote), "file string, start long, kind int, first boolean, record string"
        )
        pieces = stage(pieces, "records")
    whole = pieces.filter(F.col("kind") == RECORD).select("file", "first", "record")
    return whole.unionByName(_stitched(pieces))


def read_records(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None, header: bool = False, mode: str = "PERMISSIVE",
    corrupt: str | None = None, range_bytes: int | None = None,
) -> DataFrame:
    """The rows that the CSV reader gives for these files with ``multiLine``, parsed in parallel. Without a
    ``schema`` all columns are text and named as the reader names them."""
    if schema is None:
        # Spark looks at the first record only.
        schema = spark.read.options(header=header, quote='"', escape='"', multiLine=True).csv(path).schema
    records = csv_records(spark, path, range_bytes=range_bytes)
    if header:
        records = records.filter(~F.col("first"))
    options = {"quote": '"', "escape": '"', "multiLine": "true", "mode": mode}
    if corrupt:
        options["columnNameOfCorruptRecord"] = corrupt
    return records.select(F.from_csv("record", _ddl(schema), options).alias("r")).select("r.*")


def _ddl(schema: T.StructType) -> Column:
    return F.lit(", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields))


@contextmanager
def _ranged(spark: SparkSession, files: DataFrame, range_bytes: int | None) -> Iterator[None]:
    """Scans of ``files`` read ranges of ``range_bytes``. A task takes as many of them as make up the session's own
    partition, fewer where there are not enough for all cores: a task for each would take longer to start than to run."""
    if range_bytes is None:
        yield
        return
    before = {name: spark.conf.get(name) for name in RANGE_SETTINGS} | {TASKS_SETTING: spark.conf.get(TASKS_SETTING, None)}
    size = files._jdf.queryExecution().analyzed().stats().sizeInBytes()
    own = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before[RANGE_SETTINGS[0]])
    tasks = max(math.ceil(size / max(own, range_bytes)), TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    try:
        for name, value in zip(before, (range_bytes, 0, min(tasks, int(before[TASKS_SETTING] or tasks)))):
            spark.conf.set(name, str(value))
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def inside_after(line: str, inside: bool, sep: str, quote: str) -> bool:
    """Whether a value is still open behind ``line``, which begins inside one or at a record's start."""
    at = 0
    while True:
        if inside:
            while True:
                at = line.find(quote, at)
                if at < 0:
                    return True
                if not line.startswith(quote, at + 1):
                    break
                at += 2
            inside = False
        elif line.startswith(quote, at):
            inside, at = True, at + 1
            continue
        at = line.find(sep, at)
        if at < 0:
            return False
        at += len(sep)


def _runs(batch: pa.RecordBatch, *keys: str) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Parts of a batch that lie in one range."""
    columns = [batch.column(k) for k in keys]
    at = 0
    for stop in [*_changes(columns, batch.num_rows), batch.num_rows]:
        if stop > at:
            yield tuple(c[at].as_py() for c in columns), batch.slice(at, stop - at)
        at = stop


def _changes(columns: list[pa.Array], n: int) -> list[int]:
    if n < 2:
        return []
    differ = [pc.not_equal(c.slice(1), c.slice(0, n - 1)) for c in columns]
    changed = differ[0]
    for d in differ[1:]:
        changed = pc.or_(changed, d)
    return [i + 1 for i in pc.indices_nonzero(changed).to_pylist()]


def _quoted(lines: pa.Array, quote: str) -> list[int]:
    """Places of the lines that can change the state."""
    return pc.indices_nonzero(pc.match_substring(lines, quote)).to_pylist()


def _range_ends(sep: str, quote: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "start", "from_out", "from_in", "crlf"]

        def row(key, ends, crlf):
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, *ends, crlf)], names)

        current, ends, crlf = None, None, False
        for batch in batches:
            for key, part in _runs(batch, "file", "start"):
                if key != current:
                    if current is not None:
                        yield row(current, ends, crlf)
                    current, ends = key, (False, True)
                    crlf = key[1] == 0 and part.column("value")[0].as_py().endswith("\r")
                lines = part.column("value")
                for i in _quoted(lines, quote):
                    line = lines[i].as_py()
                    ends = tuple(inside_after(line, inside, sep, quote) for inside in ends)
        if current is not None:
            yield row(current, ends, crlf)

    return run


def _opened(ends: DataFrame) -> DataFrame:
    """``file``, ``start``, ``inside``: how each range opens, and ``crlf`` of its file. A range either fixes the state, or keeps or turns it;
    so the last one that fixed it decides, and the number of turns since. One row a range goes through here."""
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.col("from_out") == F.col("from_in")
    turns = F.sum(F.when(~fixed & F.col("from_out"), 1).otherwise(0)).over(Window.partitionBy("file").orderBy("start"))
    counted = ends.withColumn("turns", turns).withColumn("fix", F.when(fixed, F.struct("from_out", "turns")))
    last = F.last("fix", ignorenulls=True).over(before)
    turned = F.coalesce(F.last("turns").over(before), F.lit(0)) - F.coalesce(F.col("last.turns"), F.lit(0))
    state = F.coalesce(F.col("last.from_out"), F.lit(False)) != (turned % 2 == 1)
    return counted.withColumn("last", last).select(
        "file", "start", state.alias("inside"), F.max("crlf").over(Window.partitionBy("file")).alias("crlf")
    )


def _cut_records(sep: str, quote: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, current = _Pieces(), None
        for batch in batches:
            for key, part in _runs(batch, "file", "start", "inside", "crlf"):
                if key != current:
                    out.end()
                    current = key
                    out.begin(*key)
                lines, at = part.column("value"), 0
                if key[3]:
                    lines = pc.replace_substring_regex(lines, r"\r$", "")
                for i in _quoted(lines, quote):
                    out.plain(lines, at, i)
                    line = lines[i].as_py()
                    out.quoted(line, inside_after(line, out.inside, sep, quote))
                    at = i + 1
                out.plain(lines, at, len(lines))
                if out.size() >= 1 << 14:
                    yield out.batch()
        out.end()
        yield out.batch()

    return run


class _Pieces:
    """Records and border pieces of ranges that come one after the other."""

    SCHEMA = pa.schema([("file", pa.string()), ("start", pa.int64()), ("kind", pa.int32()), ("first", pa.bool_()), ("record", pa.string())])

    def __init__(self):
        self.rows: list[tuple] = []
        self.file, self.start, self.inside, self.open, self.head, self.none_yet = None, 0, False, [], False, False

    def begin(self, file: str, start: int, inside: bool, crlf: bool) -> None:
        self.file, self.start, self.inside, self.open = file, start, inside, []
        self.head, self.none_yet = inside, start == 0

    def _add(self, kind: int, text: str) -> None:
        if kind in (RECORD, TAIL) and not text:
            return
        first = self.none_yet and kind in (RECORD, TAIL)
        if first:
            self.none_yet, text = False, text.removeprefix("﻿")
        self.rows.append((self.file, self.start, kind, first, text))

    def plain(self, lines: pa.Array, start: int, stop: int) -> None:
        """Lines without a quote."""
        texts = lines.slice(start, stop - start).to_pylist()
        if self.inside:
            self.open += texts
        else:
            for text in texts:
                self._add(RECORD, text)

    def quoted(self, line: str, inside: bool) -> None:
        self.open.append(line)
        self.inside = inside
        if not inside:
            self._add(HEAD if self.head else RECORD, "\n".join(self.open))
            self.open, self.head = [], False

    def end(self) -> None:
        if self.inside and self.file is not None:
            self._add(THROUGH if self.head else TAIL, "\n".join(self.open))
        self.inside = False

    def size(self) -> int:
        return len(self.rows)

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * len(self.SCHEMA)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.SCHEMA)], schema=self.SCHEMA)


def _stitched(pieces: DataFrame) -> DataFrame:
    """Records that reach over borders: a tail, the ranges that lie inside it, a head. Two rows a range at most."""
    borders = pieces.filter(F.col("kind") != RECORD)
    # Without the texts: all borders of a file go through one task here.
    at = Window.partitionBy("file").orderBy("start", "kind")
    opened = borders.select("file", "start", "kind", F.sum((F.col("kind") == TAIL).cast("int")).over(at).alias("opened"))
    part = F.struct("start", "kind", "record")
    joined = borders.join(opened, ["file", "start", "kind"]).groupBy("file", "opened").agg(
        F.max("first").alias("first"), F.array_sort(F.collect_list(part)).alias("parts")
    )
    return joined.select("file", "first", F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))
