"""Session settings and intermediate tables.

Intermediate results that must be read twice from the very same rows are
written as Parquet below the shared folder that the cluster names in
``spark.checkpoint.dir``: such a table survives the loss of any executor.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Settings a session should carry; all of them can be changed at run time.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings the operators are designed for."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach.

    Only a local session, where driver and executors are one process, may fall
    back to a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    folder = spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir must name a folder shared by all executors"
        )
    folder = tempfile.mkdtemp(prefix="ampertide-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/ampertide/{label}-{uuid.uuid4().hex}"


def drop_at_exit(spark: SparkSession, path: str) -> str:
    """Have an existing scratch path deleted when the application ends."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.deleteOnExit(target)
    return path


# Paths that open ``scratch`` blocks will delete, innermost last.
_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that ``materialise`` stores inside the block when it is left.

    For long sessions: results that read those tables must be stored before.
    """
    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a reader of the stored rows."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    return spark.read.schema(df.schema).parquet(drop_at_exit(spark, path))


def _is_parquet_scan(df: DataFrame) -> bool:
    """True when the place of each row in its Parquet file can still be asked for."""
    hidden = df._jdf.queryExecution().analyzed().metadataOutput()
    return hidden.size() == 1 and "row_index" in hidden.apply(0).dataType().catalogString()


_ROW_BITS = 40


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """Add a number that no other row has: the number of the row's Parquet file, then its place in the file.

    A re-run task finds the same number. A frame that is no plain scan is stored first.
    ``name`` must not be a column of ``df``.
    """
    if name in df.columns:
        raise ValueError(f"{name} is a column already")
    scan = df if _is_parquet_scan(df) else materialise(df, "rows")
    path, place = free_name(df, "_file"), free_name(df, "_place")
    # One row per file; the list is written once, so that every reader of it counts alike.
    files = scan.select(F.col("_metadata.file_path").alias(path)).distinct()
    files = materialise(files.withColumn(name, F.row_number().over(Window.orderBy(path)).cast("long")), "files")
    rows = scan.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(place))
    number = F.shiftleft(F.col(name), _ROW_BITS).bitwiseOR(F.col(place))
    return rows.join(files, path).select(*(F.col(f"`{c}`") for c in df.columns), number.alias(name))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many ``_`` before it as no column of ``df`` has."""
    while name in df.columns:
        name = f"_{name}"
    return name


def with_row_tie(df: DataFrame, name: str = "_tie") -> DataFrame:
    """Add a number that tells copies of a row apart.

    It comes from the row's place in its Parquet file, so a re-run task finds
    the same number; added to a range shuffle it spreads equal rows. A frame
    that is no plain scan is stored first.
    """
    scan = df if _is_parquet_scan(df) else materialise(df, "rows")
    return scan.select("*", F.xxhash64("_metadata.file_path", "_metadata.row_index").alias(name))
