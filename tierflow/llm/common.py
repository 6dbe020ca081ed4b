"""Helpers shared by the corpus operators.

Work columns start with ``_w_`` so that extra columns of the input tables keep
their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierflow.session import stage

#: ASCII white space of the contracts: blank and tab to carriage return.
BLANKS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
WORDS = r"[^\x20\x09-\x0D]+"
#: Rows of one Arrow batch; a batch of whole long texts then stays small.
BATCH_ROWS = 200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; NULL ids have remainder NULL."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def map_batches(df: DataFrame, fn: Callable[[Iterator], Iterator], schema: str) -> DataFrame:
    """``mapInPandas`` over small batches."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInPandas(fn, schema)


def collapse(df: DataFrame, name: str) -> DataFrame:
    """Equal rows as one row with their count ``_w_n``, written and reread.

    Partial counts are made before the shuffle, so a row that is repeated in a
    third of the table reaches the shuffle once per task.
    """
    return stage(df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_w_n")), name)


def expand(df: DataFrame, chunk: int = 65_536) -> DataFrame:
    """Undo ``collapse``: one row per copy, numbered ``_w_copy`` from 0.

    The copies are made in chunks, so no task holds a long sequence.
    """
    out = df.withColumn("_w_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_w_n") - 1) / chunk))))
    first = F.col("_w_chunk") * chunk
    out = out.withColumn("_w_copy", F.explode(F.sequence(first, F.least(first + chunk - 1, F.col("_w_n") - 1))))
    return out.drop("_w_chunk", "_w_n")


def bucket_count(rows: int) -> int:
    """As many buckets as rows in each, so neither level of a running sum outgrows the other."""
    return max(1, math.isqrt(rows))


def running_start(df: DataFrame, amount: Column, keys: list[str], order: list[Column], buckets: int) -> DataFrame:
    """Adds ``_w_start``: the sum of ``amount`` over all earlier rows of the same keys.

    Rows are dealt to hash buckets inside the keys, so that a key with a third
    of the rows is summed by many tasks; the buckets' own sums (one narrow row
    per key and bucket) give each bucket's offset.  The order is
    (bucket, ``order``) and depends on the data alone.
    """
    df = df.withColumn("_w_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets))).withColumn("_w_amount", amount)
    sums = df.groupBy(*keys, "_w_bucket").agg(F.sum("_w_amount").alias("_w_sum"))
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_w_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, "_w_bucket", F.coalesce(F.sum("_w_sum").over(before), F.lit(0)).alias("_w_offset"))
    inside = (Window.partitionBy(*keys, "_w_bucket").orderBy(F.xxhash64(F.lit(7), *order), *order)
              .rowsBetween(Window.unboundedPreceding, -1))
    out = df.join(sums, [*keys, "_w_bucket"])
    start = F.col("_w_offset") + F.coalesce(F.sum("_w_amount").over(inside), F.lit(0))
    return out.withColumn("_w_start", start).drop("_w_bucket", "_w_amount", "_w_offset")
