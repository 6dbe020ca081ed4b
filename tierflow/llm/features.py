"""Labelled rows and hashed features for the two trained classifiers."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import remainder

#: Entries of a worker's word memo before it starts anew; bounds its memory.
MEMO = 300_000


def held_out(folds: int, fold: int):
    """True for the rows no label is learnt from; rows without an id count as held out."""
    return F.coalesce(remainder(F.col("doc_id"), folds) == fold, F.lit(True))


def training_rows(documents: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, most: int) -> DataFrame:
    """(doc_id, text, label) of at most ``most`` labelled rows outside the held-out fold.

    The rows with the smallest hashes of their id are taken, so the sample is
    the same on every run.  The sampled labels (at most ``most`` narrow rows)
    are broadcast; the documents are not shuffled.  Of the rows of one id that
    with the least text hash stays, so partial aggregates of at most ``most``
    rows are all that is moved.
    """
    known = (labels.select("doc_id", F.col(label).cast("int").alias("_w_label")).where("doc_id IS NOT NULL AND _w_label IS NOT NULL")
             .where(~held_out(folds, fold)).groupBy("doc_id").agg(F.max("_w_label").alias("_w_label"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    rows = documents.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    one = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("_w_one")
    rows = rows.join(F.broadcast(known), "doc_id").groupBy("doc_id", "_w_label").agg(one)
    return rows.select("doc_id", F.col("_w_one.text").alias("text"), F.col("_w_label").alias("label"))


def bucket(word: str, dims: int) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % dims
