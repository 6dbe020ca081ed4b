"""Batch ids and surrogate keys.

``assign_surrogate_keys`` numbers rows ``start, start+1, ...`` in a given
total order without sending them through one task: the rows are range
partitioned on the order (a hot leading column is split by the later ones),
sorted inside each partition and tagged with (partition, position).  The
tagged rows are written once to the shared work folder so the numbering
pass sees exactly the positions that were counted.  One count per partition
gives each partition's offset.  Keys are unique and gap-free, and equal to
``start - 1 + row_number()`` over the order.  Loads that number rows at the same
time need a lock around ``continue_from`` and the write that follows it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierflow.operators.dedup import _order_cols
from tierflow.session import stage

_POS_BITS = 33  # monotonically_increasing_id = partition << 33 | position


def next_batch_id(df: DataFrame, col: str = "_batch_id") -> DataFrame:
    """``coalesce(max(batch), 0) + 1`` as a one-row DataFrame."""
    return df.agg((F.coalesce(F.max(col), F.lit(0)) + 1).cast("int").alias("next_batch_id"))


def next_batch_value(df: DataFrame, col: str = "_batch_id") -> int:
    return next_batch_id(df, col).collect()[0]["next_batch_id"]


def continue_from(existing: DataFrame, col: str, start: int) -> int:
    """First id of the next batch: ``max(col) + 1`` of the ids already given, else ``start``
    (a sequence ``START = start, INCREMENT = 1``).  One value reaches the driver."""
    last = existing.agg(F.max(col).alias("m")).collect()[0]["m"]
    return start if last is None else int(last) + 1


def assign_surrogate_keys(df: DataFrame, order_by: Sequence, start: int = 1, name: str = "sk",
                          partitions: int | None = None) -> DataFrame:
    """Add ``name`` = ``start + rank - 1`` in ``order_by`` (a total order)."""
    order = _order_cols(order_by)
    ranged = (df.repartitionByRange(partitions, *order) if partitions
              else df.repartitionByRange(*order))
    tagged = (ranged.sortWithinPartitions(*order)
              .select("*", F.spark_partition_id().alias("_pid"),
                      F.monotonically_increasing_id().alias("_mid")))
    tagged = stage(tagged, "surrogate-keys")
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: a tiny window; the join is broadcast when Spark measures it as small.
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _POS_BITS)
    return (tagged.join(offsets, "_pid")
                  .withColumn(name, (F.lit(start) + F.col("_off") + pos).cast("long"))
                  .drop("_pid", "_mid", "_off"))
