"""Tables: named sources, materialisation and gated full refresh."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.quality import counted_write

# Fixed value: the logical name of the raw bars source and the table it stands for.
SOURCES = {("raw", "fs_st_if_cpl"): "raw_data.foreign_stock_info_complete"}


def source(spark: SparkSession, group: str, name: str, tables: Mapping[tuple[str, str], str] = SOURCES) -> DataFrame:
    """The table behind a logical source name."""
    return spark.table(tables[(group, name)])


def publish(df: DataFrame, table: str, gates: Sequence[Callable[[DataFrame], None]] = (), keep: int = 1) -> DataFrame:
    """Replace the content of ``table`` by ``df`` if all gates pass; otherwise leave it as it was.

    Each refresh is a table of its own, ``<table>__v<time>``, and ``table`` is a view of the current
    one. Replacing the view is one catalog operation, so readers see the old or the new rows, never
    none, and a new schema is no special case. ``keep`` older versions stay for running readers.
    A gate gets the stored rows and raises to refuse them; one that has ``metrics`` is counted by the write itself.
    """
    version, _ = _gated_version(df, table, gates)
    _swap(df.sparkSession, {table: f"SELECT * FROM {version}"})
    _forget(df.sparkSession, table, version, keep)
    return df.sparkSession.table(table)


def publish_split(
    df: DataFrame, table: str, rejects: str, marks: Sequence[str], gates: Sequence[Callable[[DataFrame], None]] = (),
    accept: Callable[[Mapping[str, int]], None] | None = None, keep: int = 1,
) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Replace ``table`` and ``rejects`` by the good and the bad rows of ``df``, written once as one version.

    The last of the ``marks`` columns is NULL on a good row. ``table`` shows the other columns of good rows,
    ``rejects`` the marks of bad ones; both are views of the version. The write counts ``rows``, ``rejects`` and what
    the gates count among good rows; ``accept`` gets the counts and raises to refuse them. Between the two views'
    replacements readers of both can meet two versions. If the job breaks there, the next call mends it.
    Returns both tables and the counts.
    """
    spark = df.sparkSession
    mend_split(spark, table, rejects, marks)
    bad = F.col(marks[-1]).isNotNull()
    metrics = {"rows": F.count(F.lit(1)), "rejects": F.count_if(bad)}
    version, counts = _gated_version(df, table, gates, metrics, ~bad, accept, marks)
    views = _split_views(version, table, rejects, [c for c in df.columns if c not in marks], marks)
    _swap(spark, views)
    _forget(spark, table, version, keep)
    # Earlier refreshes may have kept rejects in versions of their own.
    for old in versions(spark, rejects):
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    return spark.table(table), spark.table(rejects), counts


def mend_split(spark: SparkSession, table: str, rejects: str, marks: Sequence[str]) -> bool:
    """Point ``rejects`` to the version that ``table`` shows, if a broken refresh left it behind."""
    if not spark.catalog.tableExists(table) or _is_plain_table(spark, table):
        return False
    version = current_version(spark, table)
    columns = spark.table(version).columns
    if not set(marks) <= set(columns):
        return False
    if spark.catalog.tableExists(rejects) and version in _view_text(spark, rejects):
        return False
    views = _split_views(version, table, rejects, [c for c in columns if c not in marks], marks)
    _swap(spark, {rejects: views[rejects]})
    return True


def _split_views(version: str, table: str, rejects: str, good: Sequence[str], marks: Sequence[str]) -> dict[str, str]:
    listed = [", ".join(f"`{c.replace('`', '``')}`" for c in columns) for columns in (good, marks)]
    return {
        table: f"SELECT {listed[0]} FROM {version} WHERE `{marks[-1]}` IS NULL",
        rejects: f"SELECT {listed[1]} FROM {version} WHERE `{marks[-1]}` IS NOT NULL",
    }


def _gated_version(
    df: DataFrame, table: str, gates: Sequence[Callable[[DataFrame], None]], metrics: Mapping[str, Column] | None = None,
    among: Column | None = None, accept: Callable[[Mapping[str, int]], None] | None = None, marks: Sequence[str] = (),
) -> tuple[str, dict[str, int]]:
    """``df`` as a new version of ``table`` that passed the gates, and the counts of its write."""
    spark = df.sparkSession
    version = f"{table}__v{time.time_ns():020d}"
    observed = [g for g in gates if hasattr(g, "metrics")]
    wanted = dict(metrics or {})
    for gate in observed:
        wanted |= gate.metrics(among)
    try:
        counts = counted_write(df, wanted, lambda rows: rows.write.mode("errorifexists").saveAsTable(version))
        if accept is not None:
            accept(counts)
        for gate in observed:
            gate.check(counts)
        for gate in gates:
            if gate not in observed:
                stored = spark.table(version)
                gate(stored if among is None else stored.filter(among).drop(*marks))
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    return version, counts


def _swap(spark: SparkSession, views: Mapping[str, str]) -> None:
    for name, body in views.items():
        if _is_plain_table(spark, name):
            spark.sql(f"ALTER TABLE {name} RENAME TO {name}__v{0:020d}")
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {body}")


def _forget(spark: SparkSession, table: str, version: str, keep: int) -> None:
    for old in [v for v in versions(spark, table) if v != version][: -keep or None]:
        spark.sql(f"DROP TABLE IF EXISTS {old}")


def append(df: DataFrame, table: str) -> DataFrame:
    """Add rows to a plain table or to the current version of a published one; create it if it is new."""
    spark = df.sparkSession
    target = table if not spark.catalog.tableExists(table) or _is_plain_table(spark, table) else current_version(spark, table)
    if target != table:
        # A version may hold marks of rejects beside the published columns; appended rows are good ones.
        shown = spark.table(table).columns
        stored = spark.table(target).schema
        df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in stored if f.name not in shown})
    df.write.mode("append").saveAsTable(target)
    return spark.table(table)


def current_version(spark: SparkSession, table: str) -> str:
    """The stored version that a published table's view reads."""
    read = re.search(r" FROM (\S+)", _view_text(spark, table))
    if read is None or read[1] not in versions(spark, table):
        raise ValueError(f"{table} is a view, but not of a version of its own")
    return read[1]


def _view_text(spark: SparkSession, table: str) -> str:
    lines = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'View Text'").collect()
    return lines[0]["data_type"] if lines else ""


def versions(spark: SparkSession, table: str) -> list[str]:
    """Stored versions of a published table, oldest first."""
    database, _, name = table.rpartition(".")
    where = f" IN {database}" if database else ""
    rows = spark.sql(f"SHOW TABLES{where} LIKE '{name}__v*'").collect()
    # The pattern also lets through tables that are only called alike, and their versions.
    own = re.compile(re.escape(name) + r"__v[0-9]{20}", re.IGNORECASE)
    return sorted(f"{database}.{r.tableName}" if database else r.tableName for r in rows if own.fullmatch(r.tableName))


def _is_plain_table(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW"


def materialise(df: DataFrame, name: str, how: str = "view") -> DataFrame:
    """``ephemeral`` inlines the frame, ``view`` names it for the session, ``table`` stores it. A view that outlives
    the session has to be text: ``persistent_view``."""
    if how == "ephemeral":
        return df
    if how == "view":
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    if how == "table":
        return publish(df, name)
    raise ValueError(f"unknown materialisation {how}")


def persistent_view(spark: SparkSession, name: str, query: str) -> DataFrame:
    """A view in the catalog, seen by other sessions and after this one. ``query`` may read catalog tables and
    views only; its columns and types are those of the tables when they are read. It replaces a view of that name,
    never a table."""
    if _is_plain_table(spark, name):
        raise ValueError(f"{name} is a table")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
    return spark.table(name)
