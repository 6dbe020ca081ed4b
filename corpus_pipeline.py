"""The corpus pipeline: five operators of ``tierflow.llm`` in a row.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's result as Parquet into the shared folder and rereads it as the
next stage's documents.  All stages but the last return the columns of the
documents they were given; the last returns the shard manifest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierflow.llm import factor, feistel, latent, mixing, order_minhash
from tierflow.llm.common import table
from tierflow.session import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine accepts (operator 10)."""
    return factor.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies (operator 3)."""
    return order_minhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage (operator 7)."""
    return latent.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, each as often as its source's target asks (operator 4)."""
    return mixing.mix_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document copy (operator 8)."""
    return feistel.manifest(docs)


STAGES = [("quality", quality), ("near-duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixing", mix_sources), ("sharding", shards)]

#: Trained models, sketches and alignments are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
