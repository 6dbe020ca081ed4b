"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.session import stage


def stars(edges: DataFrame) -> DataFrame:
    """From undirected edges (u, v): one row (u, root) per node that is not its component's least.

    Each round is written to the shared folder; rounds grow with the logarithm
    of the longest path.  Least neighbours are partial aggregates, so a hub with
    a third of all edges is no single task's work.
    """
    e = stage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        # repeated edges do no harm before the distinct at the end of the round
        state = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if tuple(state) == seen or not state["n"]:
            return e.select("u", F.col("v").alias("root"))
        seen = tuple(state)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stage(small.unionByName(down.select("u", F.col("m").alias("v"))).distinct(), "edges")
