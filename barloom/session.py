"""Session defaults and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "barloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs assume; ``conf`` overrides any of them.

    Partition counts are left to adaptive execution: give a generous
    ``spark.sql.shuffle.partitions`` on a cluster and let it coalesce.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        # Call-site capture costs about as much as planning a small query.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update({key.replace("__", "."): str(value) for key, value in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder of its own, because a
    machine-local path cannot be read by other executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="barloom-")
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the scratch area; nothing is created yet."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the scratch area once and return a scan of it.

    Used where several passes follow: the passes share one computation, see pruned columns and
    footer statistics, and a lost executor costs a re-read instead of a re-run.
    """
    return _stored(df, scratch_path(df.sparkSession, label))


@contextmanager
def staged(df: DataFrame, label: str = "stage") -> Iterator[DataFrame]:
    """``stage`` for an intermediate with an owner: its folder goes when the block ends."""
    path = scratch_path(df.sparkSession, label)
    try:
        yield _stored(df, path)
    finally:
        remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate whose readers have stored their results."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
