"""Clustered layout and partition-pruning report.

``write_clustered`` stores a table with one directory per value of the
clustering column, so a filter on that column becomes a ``PartitionFilters``
entry in the scan and whole directories are skipped.  Rows are range
partitioned on ``(column, tie-breaker)``: the sampled range bounds give each
value a share of tasks proportional to its size, so a value holding a third
of all rows is written by a third of the tasks, not one.
``maxRecordsPerFile`` caps file size.  Inside each file rows are sorted by
the column plus an optional secondary key, so Parquet min/max statistics
also skip row groups on that key.

``pruning_report`` measures what a filtered scan actually reads: the files,
their directories and the rows behind the files the pruned scan opens, next to
the table's totals.  It reads only the ``_metadata`` file path (no data columns),
one row per file after the first aggregate; ``inputFiles()`` is not used because
it ignores pruning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_clustered(df: DataFrame, path: str, column: str, sort_by: list[str] | None = None,
                    max_records_per_file: int = 5_000_000) -> str:
    """``CLUSTER BY (column)`` as a partitioned, sorted Parquet layout.

    The tie-breaker is ``sort_by`` when given, else a hash of the row.
    """
    tie = ([F.col(c) for c in sort_by] if sort_by
           else [F.xxhash64(*[F.col(c) for c in df.columns if c != column])])
    (df.repartitionByRange(F.col(column), *tie)
       .sortWithinPartitions(column, *(sort_by or []))
       .write.mode("errorifexists")
       .option("maxRecordsPerFile", max_records_per_file)
       .partitionBy(column).parquet(path))
    return path


def write_range_clustered(df: DataFrame, path: str, column: str, tie_breaker: str,
                          files: int | None = None, max_records_per_file: int = 5_000_000) -> str:
    """A13, range form: ``repartitionByRange(column, tie_breaker).sortWithinPartitions``.

    For a high-cardinality column (dates, ids) a directory per value would
    explode; instead each file holds one contiguous range of the column, so
    Parquet min/max statistics let a range filter skip whole files and row
    groups.  The tie-breaker joins the range key, so a hot value is split
    over several files rather than landing in one task.
    """
    ranged = (df.repartitionByRange(files, F.col(column), F.col(tie_breaker)) if files
              else df.repartitionByRange(F.col(column), F.col(tie_breaker)))
    (ranged.sortWithinPartitions(column, tie_breaker)
           .write.mode("errorifexists").option("maxRecordsPerFile", max_records_per_file)
           .parquet(path))
    return path


def read_clustered(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def pruning_report(spark: SparkSession, path: str, predicate: Column, unit: str = "directory") -> DataFrame:
    """Two rows, ``scope`` = total / scanned, with ``partitions`` and ``rows``.

    A partition is a directory of ``write_clustered`` or, with ``unit="file"``, a
    file of ``write_range_clustered``.  Rows of the scanned part are those
    that the filter keeps.
    """
    scan = read_clustered(spark, path)
    part = F.col("_file") if unit == "file" else F.regexp_extract("_file", r"^(.*)/[^/]*$", 1)

    def measure(df: DataFrame, scope: str) -> DataFrame:
        files = df.select(F.col("_metadata.file_path").alias("_file")).groupBy("_file").agg(F.count(F.lit(1)).alias("n"))
        return files.agg(F.lit(scope).alias("scope"), F.count_distinct(part).cast("bigint").alias("partitions"),
                         F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"))

    return measure(scan, "total").unionByName(measure(scan.filter(predicate), "scanned"))
