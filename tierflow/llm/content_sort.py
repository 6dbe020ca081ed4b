"""Operator 5: exact dedup by content sort.

Normalised texts are dealt by sampled range splitters, sorted outside memory so
that equals are adjacent, and compared in full with their neighbours.  Of equal
texts the longest original stays, then the smallest id.

The splitters are (leading bytes, digest) instead of whole texts, so what the
driver samples has a bounded size, and texts with one common beginning still
spread.  A text that more than one row in a thousand repeats would fill one
range: such texts (fewer than a thousand, by that very share) are salted by id
into many ranges, and their winner is a partial aggregate made before the sort.

Defined results: a NULL text counts as empty; a NULL id sorts last; of equal
(text, id) rows exactly one is kept (all of them share a salt); an empty table gives an empty result; other
columns are ignored by ``content_sort``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.common import BLANKS, text_or_empty

#: A text is hot when more than one in so many rows has it.
HOT_SHARE = 1000
SALTS = 64
LEAD = 32


def normalised(text: Column) -> Column:
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def salt_of(doc_id: Column, length: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id, length.cast("long")), F.lit(SALTS))


def content_sort(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    original = text_or_empty()
    rows = (documents.select("doc_id", F.length(original).alias("_w_len"), normalised(original).alias("_w_norm"))
            .withColumn("text_sha256", F.coalesce(F.sha2(F.col("_w_norm").cast("binary"), 256), F.lit(""))))

    least = max(1, documents.count() // HOT_SHARE)
    best = F.min(F.struct((-F.col("_w_len")).alias("l"), F.col("doc_id").isNull().alias("u"), F.col("doc_id").alias("d")))
    hot = (rows.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("_g_size"), best.alias("_g_best"))
           .where(F.col("_g_size") > least)
           .select("text_sha256", "_g_size", F.col("_g_best.d").alias("_g_keep"),
                   salt_of(F.col("_g_best.d"), -F.col("_g_best.l")).alias("_g_salt"), F.lit(True).alias("_g_hot")))
    # fewer than HOT_SHARE rows: each stands for more than a thousandth of the table
    marked = rows.join(F.broadcast(hot), "text_sha256", "left").withColumn("_w_hot", F.coalesce("_g_hot", F.lit(False)))
    dealt = (marked.withColumn("_w_salt", F.when(F.col("_w_hot"), salt_of(F.col("doc_id"), F.col("_w_len"))).otherwise(F.lit(0)))
             .withColumn("_w_lead", F.substring("_w_norm", 1, LEAD)))

    splitters = ["_w_lead", "text_sha256", "_w_salt"]
    ranged = dealt.repartitionByRange(*splitters)
    equal = Window.partitionBy(*splitters, "_w_norm")
    best_first = equal.orderBy(F.col("_w_len").desc(), F.col("doc_id").asc_nulls_last())
    first = F.row_number().over(best_first) == 1
    return ranged.select(
        "doc_id",
        F.when(F.col("_w_hot"), F.col("_g_keep")).otherwise(F.first("doc_id").over(best_first)).alias("keep_id"),
        F.when(F.col("_w_hot"), F.col("_g_size")).otherwise(F.count(F.lit(1)).over(equal)).cast("long").alias("group_size"),
        (first & (~F.col("_w_hot") | (F.col("_w_salt") == F.col("_g_salt")))).alias("kept"),
        "text_sha256")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS len,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
w AS (
  SELECT doc_id, text_sha256,
         row_number() OVER (PARTITION BY text_sha256 ORDER BY len DESC, doc_id ASC NULLS LAST) AS k,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY len DESC, doc_id ASC NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, k = 1 AS kept, text_sha256 FROM w
"""
