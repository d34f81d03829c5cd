"""Sends this package to the executors, as ``--py-files`` would."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


ROWS_PER_BATCH = 2000


def ship(spark: SparkSession) -> None:
    """Once per application; Spark serves the archive to every executor, also to later ones.

    Texts go to Python workers in batches of at most ``ROWS_PER_BATCH`` rows,
    so that a few workers fit beside the executor's heap.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="run-")) / f"{_PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for file in sorted(_PACKAGE.rglob("*.py")):
            packed.write(file, file.relative_to(_PACKAGE.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
