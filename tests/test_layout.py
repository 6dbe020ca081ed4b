"""Clustered layout: the filter prunes directories; the report counts what is read."""

from pyspark.sql import functions as F

from tests.conftest import plan_text
from tierflow.operators.layout import pruning_report, write_clustered
from tierflow.session import work_dir


def test_clustered_scan_prunes_partitions(spark):
    df = spark.range(2000).select(F.col("id"), F.concat(F.lit("C"), (F.col("id") % 5).cast("string")).alias("ciudad"))
    path = write_clustered(df, work_dir(spark, "clustered"), "ciudad", sort_by=["id"])
    scan = spark.read.parquet(path).filter(F.col("ciudad") == "C1")
    plan = plan_text(scan)
    assert "PartitionFilters: [isnotnull(ciudad" in plan and "(ciudad#" in plan
    assert scan.count() == 400
    rep = {r["scope"]: (r["partitions"], r["rows"]) for r in
           pruning_report(spark, path, F.col("ciudad") == "C1").collect()}
    assert rep == {"total": (5, 2000), "scanned": (1, 400)}


def test_range_clustered_files_hold_contiguous_ranges(spark):
    from tierflow.operators.layout import write_range_clustered
    df = spark.range(4000).select(F.col("id"), (F.col("id") * 7 % 1000).alias("d"))
    path = write_range_clustered(df, work_dir(spark, "ranged"), "d", "id", files=8)
    scan = spark.read.parquet(path).filter(F.col("d").between(100, 149))
    assert "PushedFilters: [IsNotNull(d), GreaterThanOrEqual(d,100), LessThanOrEqual(d,149)]" in plan_text(scan)
    assert scan.count() == 200
    touched = scan.select(F.col("_metadata.file_path")).distinct().count()
    assert touched <= 2 < len(spark.read.parquet(path).inputFiles())     # the range lives in 1-2 of 8 files


def test_hot_value_is_written_by_many_tasks(spark):
    # one value holds a third of the rows: range bounds on (value, id) split it
    df = spark.range(6000).select(F.col("id"),
                                  F.when(F.col("id") % 3 == 0, "HOT").otherwise(
                                      F.concat(F.lit("C"), (F.col("id") % 50).cast("string"))).alias("ciudad"))
    # tiny test data: stop AQE from coalescing the range partitions back into one task
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = write_clustered(df, work_dir(spark, "clustered-hot"), "ciudad", sort_by=["id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hot = spark.read.parquet(path).filter("ciudad = 'HOT'")
    assert hot.select(F.col("_metadata.file_path")).distinct().count() > 1
    assert spark.read.parquet(path).filter("ciudad = 'HOT'").count() == 2000


def test_report_counts_files_of_the_range_layout(spark):
    from tierflow.operators.layout import write_range_clustered
    df = spark.range(4000).select(F.col("id"), (F.col("id") * 7 % 1000).alias("d"))
    path = write_range_clustered(df, work_dir(spark, "ranged"), "d", "id", files=8)
    total, scanned = pruning_report(spark, path, F.col("d").between(100, 149), unit="file").orderBy(F.desc("scope")).collect()
    assert total["partitions"] == len(spark.read.parquet(path).inputFiles()) > scanned["partitions"] and scanned["rows"] == 200
