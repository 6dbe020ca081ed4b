"""Operator 8: sharding by a Feistel permutation with cycle walking.

Every row gets a global number 0..N-1; a keyed Feistel network permutes these
numbers, and the permuted number p gives shard ``p mod shards`` and slot
``p div shards``.  Both are computable from the number alone, shard sizes
differ by at most one, slots have no gaps, and the same rows give the same
shuffle whatever files or partitions hold them.

Defined results: NULLs in any column are values like others (a NULL text has no
bytes); equal rows are interchangeable and each gets a place of its own; an
empty table gives an empty result; the input's columns keep their names and
types, except that columns named ``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import bucket_count, collapse, expand, running_start

ROUNDS = 8
#: Applications of the network after the first.  The square that holds the N
#: numbers has fewer than sqrt(N) + 1 others, so each step leaves the walk
#: unfinished with a chance below 1/sqrt(N); up to N = 4096 this many steps
#: always end it, and beyond that ``raise_error`` guards the result.
WALKS = 64


def permute(x: Column, n: Column, seed: int) -> Column:
    """The image of ``x`` (0 <= x < n) under a keyed permutation of 0..n-1.

    Alternating Feistel rounds over pairs (l, r) of a near-square a x b >= n;
    a value outside 0..n-1 is permuted again until it is inside (cycle walking).
    """
    a = F.greatest(F.lit(1).cast("long"), F.ceil(F.sqrt(n.cast("double"))))
    b = F.greatest(F.lit(1).cast("long"), F.ceil(n / a))

    def move(s: Column, i: Column) -> Column:
        left = F.pmod(s["l"] + F.pmod(F.xxhash64(s["r"], i, F.lit(seed)), a), a)
        right = F.pmod(s["r"] + F.pmod(F.xxhash64(s["l"], i, F.lit(seed)), b), b)
        return F.when(i % 2 == 0, F.struct(left.alias("l"), s["r"].alias("r"))).otherwise(
            F.struct(s["l"].alias("l"), right.alias("r")))

    def network(v: Column) -> Column:
        pair = F.struct(F.floor(v / b).cast("long").alias("l"), F.pmod(v, b).alias("r"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), pair, move, lambda s: s["l"] * b + s["r"])

    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), network(x.cast("long")),
                         lambda v, _: F.when(v >= n, network(v)).otherwise(v),
                         lambda v: F.when(v < n, v).otherwise(F.raise_error(F.lit("cycle walk did not end")).cast("long")))
    return walked


def shard(df: DataFrame, shards: int, seed: int = 17) -> DataFrame:
    """``df`` with ``shard`` (int, 0..shards-1) and ``slot`` (long, gapless from 0)."""
    cols = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    groups = collapse(df.select(*[F.col(f"`{c}`") for c in cols]), "shard-rows")
    seen = groups.agg(F.sum("_w_n").alias("n"), F.count(F.lit(1)).alias("g")).first()
    n = int(seen["n"] or 0)
    placed = expand(running_start(groups, F.col("_w_n"), [], [F.col(f"`{c}`") for c in cols], bucket_count(seen["g"])))
    at = permute(F.col("_w_start") + F.col("_w_copy"), F.lit(n).cast("long"), seed)
    return placed.withColumn("_w_at", at).select(
        *[F.col(f"`{c}`") for c in cols], F.pmod("_w_at", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("_w_at") / shards).cast("long").alias("slot"))


def manifest(documents: DataFrame, shards: int = 40, seed: int = 17) -> DataFrame:
    """One row per document: id, size in bytes, text checksum and its place.

    Only these narrow columns are shuffled; the texts stay where they are.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = documents.select("doc_id", (F.length(text).cast("long") + 16).alias("size"), F.crc32(text).alias("text_crc32"))
    return shard(rows, shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
