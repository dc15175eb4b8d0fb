"""Writing, copying, verifying and measuring layers."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from candlemill.session import range_sort, small_table


def write_layer(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> int:
    """Write zstd Parquet and return the number of rows written, in one pass."""
    seen = Observation()
    writer = (
        df.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode(mode)
        .option("compression", "zstd")
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return seen.get["rows"]


def write_sorted(
    df: DataFrame,
    path: str,
    order: Sequence[str],
    mode: str = "overwrite",
    unique: bool = False,
) -> int:
    """Write a layer whose files follow each other in ``order``."""
    return write_layer(range_sort(df, order, unique), path, mode=mode)


def write_quarters(
    df: DataFrame, path: str, order: Sequence[str] = ("open_ts",), unique: bool = False
) -> int:
    """Write one folder per quarter with time-sorted files.

    Range-partitioned by quarter and time, so a large quarter is written by
    several tasks and a small one does not get a task of its own.
    """
    in_order = range_sort(df, ["year_quarter", *order], unique)
    return write_layer(in_order, path, ["year_quarter"])


def copy_layer(spark: SparkSession, source: str, target: str) -> dict[str, int]:
    """Copy a Parquet layer between stores; rows written and rows read back."""
    df = spark.read.parquet(source)
    written = write_layer(df, target)
    return {"rows_written": written, "rows_read": spark.read.parquet(target).count()}


def verified_copy(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Copy a layer and return it as a table: rows written, read, and equality."""
    counts = copy_layer(spark, source, target)
    table = small_table(spark, **{name: (pa.int64(), [n]) for name, n in counts.items()})
    return table.withColumn("verified", F.col("rows_written") == F.col("rows_read"))


def stored_size(spark: SparkSession, path: str) -> DataFrame:
    """Files and megabytes of a stored layer; reads no file contents."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
    )
    return files.agg(
        F.count(F.lit(1)).alias("files"),
        (F.sum("length") / (1024 * 1024)).alias("megabytes"),
    )


def write_report(
    table: DataFrame, path: str, order: Sequence[str] = (), single: bool = True
) -> None:
    """Write a report table as CSV with a header, in ``order``.

    A small table becomes one file: only its rows move there, not the work
    above. With ``single`` off, files follow each other in ``order`` and are as
    many as the table needs.
    """
    if single:
        out = table.repartition(1)
        out = out.sortWithinPartitions(*order) if order else out
    else:
        out = range_sort(table, order) if order else table
    out.write.mode("overwrite").option("header", True).csv(path)
