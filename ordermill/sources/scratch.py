"""Intermediate tables on shared storage.

A table written here cuts lineage and survives the loss of executors. The
folder is the one named by ``spark.checkpoint.dir``. Where that is unset, as
in tests, a local session uses a folder of its own below the temporary one;
any other session is refused.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_own_root: dict[str, str] = {}  # by application, where the setting is unset
_run: ContextVar[str] = ContextVar("ordermill_run", default="shared")


def scratch_root(spark: SparkSession) -> str:
    context = spark.sparkContext
    root = spark.conf.get(_SETTING, None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder shared by all executors")
        if context.applicationId not in _own_root:
            _own_root[context.applicationId] = tempfile.mkdtemp(prefix="ordermill-")
        root = _own_root[context.applicationId]
    return root.rstrip("/")


def _run_folder(spark: SparkSession, run: str) -> str:
    return f"{scratch_root(spark)}/ordermill-{spark.sparkContext.applicationId}/{run}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the folder of the current run."""
    return f"{_run_folder(spark, _run.get())}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once and return a scan of what was written."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession, run: str | None = None) -> bool:
    """Delete the intermediate tables of one run (by default the current one)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_run_folder(spark, run or _run.get()))
    filesystem = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return filesystem.delete(path, True)


def drop_dead_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of queries that are over and that nothing can read again.

    It does so when the driver collects its garbage, which a driver with room
    to spare hardly ever does: all shuffles of a run would lie on disk at once.
    """
    gc.collect()  # tables that hang in reference cycles hold on to their plans
    spark.sparkContext._jvm.System.gc()


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """A folder of its own for the tables made inside; they alone are deleted at the end."""
    token = _run.set(f"run-{uuid.uuid4().hex}")
    try:
        yield _run.get()
    finally:
        drop_scratch(spark)
        _run.reset(token)
