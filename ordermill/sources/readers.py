"""Scans of raw files, stored tables and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ordermill.sources.contract import METADATA_PREFIX


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file, folder or glob is there, on any file system Spark can read."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    filesystem = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(filesystem.globStatus(hadoop_path))


def source_path(spark: SparkSession, sources: dict[str, str], table: str) -> str:
    """Path of a configured source; raises if it is not configured or not there."""
    if table not in sources:
        raise KeyError(f"no source configured for {table}")
    path = sources[table]
    if not path_exists(spark, path):
        raise FileNotFoundError(f"source of {table} is missing: {path}")
    return path


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    multiline: bool = False,
) -> DataFrame:
    """CSV with a header row. Without a schema the types are inferred, which costs a pass.

    ``multiline`` keeps quoted line breaks inside a row and fails on malformed
    rows; such a file cannot be split, so many files are needed for parallelism.
    """
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    if multiline:
        reader = reader.options(multiLine=True, quote='"', escape='"', mode="FAILFAST")
    return reader.csv(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """JSON report; an absent file reads as a table without rows."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema or "status string")
    reader = spark.read
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_report(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV report that must be there and hold rows."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"report is missing: {path}")
    report = read_csv(spark, path, schema)
    if report.isEmpty():
        raise FileNotFoundError(f"report has no rows: {path}")
    return report


CORRUPT = "_corrupt_record"


def scan_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored CSV or JSON report (by the name of its path) read without trust.

    Rows that do not fit ``schema`` are kept as text in ``_corrupt_record``
    instead of failing the scan; columns are taken by name, so a report
    without a column has NULLs there (``report_columns`` tells).
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"report is missing: {path}")
    wanted = StructType.fromDDL(schema)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    if path.endswith(".json"):
        return spark.read.schema(StructType([*wanted, StructField(CORRUPT, StringType())])).options(**options).json(path)
    types = {field.name: field for field in wanted}
    there = [types.get(name, StructField(name, StringType())) for name in report_columns(spark, path)]
    rows = spark.read.schema(StructType([*there, StructField(CORRUPT, StringType())])).options(header=True, **options).csv(path)
    absent = {name: F.lit(None).cast(field.dataType) for name, field in types.items() if name not in rows.columns}
    return rows.withColumns(absent).select(*types, CORRUPT) if absent else rows.select(*types, CORRUPT)


def corrupt_rows(report: DataFrame) -> DataFrame:
    """Number of rows of ``scan_report`` that did not fit (``corrupt_rows``).

    Looks at all columns of a row, for Spark finds a misfit only in what it parses.
    """
    parsed = F.hash(*[name for name in report.columns if name != CORRUPT]) >= -(1 << 31)  # always so
    return report.agg(F.count_if(F.col(CORRUPT).isNotNull() & parsed).alias("corrupt_rows"))


def report_columns(spark: SparkSession, path: str) -> list[str]:
    """Names of the columns that a stored CSV or JSON report has."""
    return spark.read.json(path).columns if path.endswith(".json") else spark.read.option("header", True).csv(path).columns


def read_table(
    spark: SparkSession, path: str, columns: list[str] | None = None, fmt: str = "parquet"
) -> DataFrame:
    """A stored table, optionally only some columns (pruned in the scan)."""
    table = spark.read.format(fmt).load(path)
    return table if columns is None else table.select(*columns)


def without_metadata(df: DataFrame) -> DataFrame:
    """Drop the ingestion metadata columns."""
    return df.drop(*[name for name in df.columns if name.startswith(METADATA_PREFIX)])


def read_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


WHOLE_BYTES = 256 << 20  # files up to here are hashed as one value; Spark ends at 2 GB
BLOCK_BYTES = 8 << 20


def _open(uri: str):
    """A file of any file system that Arrow knows, as a stream."""
    from pyarrow import fs

    local = uri.removeprefix("file:") if uri.startswith("file:") else None
    system, path = (fs.LocalFileSystem(), f"/{local.lstrip('/')}") if local else fs.FileSystem.from_uri(uri)
    return system.open_input_stream(path)


def _streamed_hashes(files: DataFrame) -> DataFrame:
    """SHA-256 of files of any size, read block by block, one file after the other in a task."""

    def work(batches):
        import hashlib

        import pyarrow as pa

        for batch in batches:
            for path, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist()):
                digest = hashlib.sha256()
                with _open(path) as stream:
                    while block := stream.read(BLOCK_BYTES):
                        digest.update(block)
                yield pa.RecordBatch.from_pydict({"path": [path], "length": pa.array([length], pa.int64()), "sha256": [digest.hexdigest()]})

    return files.select("path", "length").repartition("path").mapInArrow(work, "path string, length bigint, sha256 string")


def source_manifest(
    spark: SparkSession, path: str, pattern: str = "*.csv", with_hash: bool = True, whole_bytes: int = WHOLE_BYTES
) -> DataFrame:
    """Name, size and SHA-256 of each file below ``path``, files of any size.

    Files up to ``whole_bytes`` are hashed where Spark reads them; larger ones
    are streamed through a fixed buffer, on file systems that Arrow can open.
    ``with_hash=False`` lists names and sizes from the file system's metadata.
    """
    files = (
        spark.read.format("binaryFile")
        .options(pathGlobFilter=pattern, recursiveFileLookup=True)
        .load(path)
    )
    name = F.element_at(F.split("path", "/"), -1).alias("filename")
    if not with_hash:
        return files.select(name, F.col("length").alias("bytes"))
    # The filters on the length reach the scan, which then does not open the other files.
    small = files.where(F.col("length") <= whole_bytes).select("path", "length", F.sha2("content", 256).alias("sha256"))
    large = _streamed_hashes(files.where(F.col("length") > whole_bytes))
    return small.unionAll(large).select(name, F.col("length").alias("bytes"), "sha256")


def reader_reconciliation(spark: SparkSession, path: str, true_rows: int | DataFrame) -> DataFrame:
    """Rows seen by a line-wise and by a multiline reader against the true count.

    The multiline reader explains the difference if it alone finds all rows.
    ``true_rows`` is a number or the table the file was written from.
    """
    expected = (
        F.lit(true_rows)
        if isinstance(true_rows, int)
        else true_rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    )
    header = spark.read.option("header", True).csv(path).schema
    naive = read_csv(spark, path, header).agg(F.count(F.lit(1)).alias("n"))
    safe = read_csv(spark, path, header, multiline=True).agg(F.count(F.lit(1)).alias("n"))
    counts = naive.select(
        expected.cast("bigint").alias("expected_rows"),
        F.col("n").alias("naive_rows"),
        safe.scalar().alias("multiline_rows"),
    )
    explained = (F.col("multiline_rows") == F.col("expected_rows")) & (
        F.col("naive_rows") != F.col("expected_rows")
    )
    return counts.withColumn("multiline_explains_difference", explained)
