"""Shared scratch space for tables that cut lineage.

The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a
local-mode session without that setting falls back to a temporary folder, since
there the driver and the executors are the same process.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"

_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def scratch_root(spark: SparkSession) -> str:
    configured = spark.conf.get(_SETTING, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {_SETTING} to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="stockloom-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, so never overwritten."""
    return f"{scratch_root(spark)}/stockloom/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once as parquet and continue from the files.

    Later actions read columnar files instead of repeating the upstream plan, and
    a lost executor costs a re-read of some files only. With ``partition_by``, actions that
    ask for one value of these columns read the files of that value only.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if (open_stages := _staged.get()) is not None:
        open_stages.append(path)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged inside the block when it ends; write its results before that."""
    paths: list[str] = []
    token = _staged.set(paths)
    try:
        yield
    finally:
        _staged.reset(token)
        for path in paths:
            delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark reaches; an absent one is ignored."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system that Spark reaches; none if it is absent."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in system.listStatus(folder)] if system.exists(folder) else []
