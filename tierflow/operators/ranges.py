"""Running over an order that spans partitions: last value before, first value after.

A window over a key sends all rows of the key to one task.  Here the rows are
range partitioned on (key, time, ...), so a key with a third of them spreads over
tasks; each task works through its own range, and one narrow row per range
carries what the neighbours need across the borders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.session import stage

PART = "_part"


def ordered_ranges(df: DataFrame, order: list[str], name: str = "ranges") -> DataFrame:
    """``df`` cut at range borders of ``order``, written once, with the range's number in ``_part``."""
    by = [F.col(c).asc_nulls_first() for c in order]
    return stage(df.repartitionByRange(*by).withColumn(PART, F.spark_partition_id()), name)


def inside(order: list[str]):
    """The window of one range."""
    return Window.partitionBy(PART).orderBy(*[F.col(c).asc_nulls_first() for c in order])


def carried(ranges: DataFrame, value: Column, order: list[str]) -> DataFrame:
    """(_part, _carry): the last non-NULL ``value`` of all earlier ranges."""
    place = F.struct(*[F.col(c) for c in order])
    last = ranges.where(value.isNotNull()).groupBy(PART).agg(F.max_by(value, place).alias("_last"))
    last = ranges.select(PART).distinct().join(last, PART, "left")
    before = Window.partitionBy(F.lit(0)).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    return last.select(PART, F.last("_last", ignorenulls=True).over(before).alias("_carry"))


def following(ranges: DataFrame, value: Column, order: list[str]) -> DataFrame:
    """(_part, _next): ``value`` of the next range's first row."""
    place = F.struct(*[F.col(c) for c in order])
    first = ranges.groupBy(PART).agg(F.min_by(value, place).alias("_first"))
    return first.select(PART, F.lead("_first").over(Window.partitionBy(F.lit(0)).orderBy(PART)).alias("_next"))  # one row per range
