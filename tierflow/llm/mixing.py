"""Operator 4: mixing sources to target weights by Sainte-Lague apportionment.

The token stream of a source (its documents in a seeded order) is cut into
equal blocks, of ``BLOCK`` words or, in a source of under ``FEW`` of those, shorter
ones down to one word.  Blocks are seats.  The seats of all sources stand in one
order, by the quotients ``x / (k - 1/2)`` of seat k of a source whose target is x
of its blocks, highest first.  The house has as many seats as bring every source
within half a block of its target; it is dealt to the output shards in equal
parts: shard j gets the seats of the house of ``seats * (j + 1) / shards`` that the
house before doesn't have, which gives every source an integer quota per shard
(``quotas``).  Only then are blocks selected: a seeded permutation of a source's
blocks, gone through again when it ends, fills its quotas shard by shard.

Defined results: a NULL source is a source of its own, sorted last; NULL and
empty texts have size 0 and take no words; equal rows share their words as
evenly as whole numbers allow; a text of any length is cut like others, a long one
into many blocks; of seats with equal quotients the source that sorts first comes
first; an empty table gives an empty result; other columns are ignored by ``mix`` and
kept by ``mix_documents``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.common import WORDS, bucket_count, collapse, expand, running_start
from tierflow.llm.feistel import permute
from tierflow.operators.keys import assign_surrogate_keys
from tierflow.operators.ranges import PART, inside, ordered_ranges
from tierflow.session import stage

WEIGHTS = (3, 1, 2)
BLOCK = 64
#: A source that would have fewer blocks than this gets shorter ones, down to one word.
FEW = 256
#: Output shards that the house is dealt to.
SHARDS = 16
SHARE = 1.5
MOST = 2.0
SEED = 23


def _earlier(df: DataFrame, sums: dict[str, str], order: list[str]) -> DataFrame:
    """Adds to each row the sums of columns over all earlier rows, a range of the order per task."""
    ranges = ordered_ranges(df, order, "mix-order")
    before = Window.partitionBy(F.lit(0)).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    own = ranges.groupBy(PART).agg(*[F.sum(c).alias(c) for c in sums])
    starts = own.select(PART, *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{n}_0") for c, n in sums.items()])
    rows = inside(order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranges.join(starts, PART).withColumns(
        {n: F.col(f"{n}_0") + F.coalesce(F.sum(c).over(rows), F.lit(0)) for c, n in sums.items()})
    return out.drop(PART, *[f"{n}_0" for n in sums.values()])


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Target words per source, from one row per source (source, source_size), with its ``place`` in the order.

    Weighted shares of ``share`` times all words; a source stops at ``most``
    times its size and the excess goes to the others by weight.  Sorted by
    size over weight, the level after the first k sources are full is
    ``(total - their caps) / (weight of the rest)``; the final level is the
    highest of these.  Sources may be many: they are numbered and summed in ranges.
    """
    named = sizes.withColumns({"_w_null": F.col("source").isNull().cast("int"), "_w_name": F.col("source").cast("string")})
    placed = assign_surrogate_keys(named, ["_w_null", "_w_name"], start=0, name="place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    out = placed.drop("_w_null", "_w_name").withColumn("weight", weight).withColumn("_w_cap", F.col("source_size") * F.lit(most))
    out = _earlier(out.withColumn("_w_full", F.col("_w_cap") / F.col("weight")),
                   {"_w_cap": "_w_caps", "weight": "_w_weights"}, ["_w_full", "place"])
    whole = out.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    level = (F.lit((whole["size"] or 0) * share) - F.col("_w_caps")) / (F.lit(whole["weight"] or 1.0) - F.col("_w_weights"))
    highest = out.agg(F.max(level).alias("level")).first()["level"]
    return (out.withColumn("target", F.least("_w_cap", F.lit(highest).cast("double") * F.col("weight")))
            .drop("_w_cap", "_w_full", "_w_caps", "_w_weights"))


def house(sources: DataFrame, shards: int) -> DataFrame:
    """``seats``: per source the seats it has in the houses of shards 0, 0..1, 0..2 and so on, as an array.

    From one row per source: ``place``, ``blocks`` (its target in blocks, a double) and
    ``limit`` (seats that it can fill).  In a house of h seats, n sources and X
    blocks in all, the quotient of the last seat lies between X / (h + 2 n) and
    X / (h - 2 n), as rounding moves no source by more than one seat.  Seats above are sure;
    the at most 5 n seats between are numbered by quotient, and the house is filled from them.
    """
    own = stage(sources.select("place", "blocks", F.least("limit", F.floor(F.col("blocks") + 0.5)).cast("long").alias("all")), "mix-house")
    whole = own.agg(F.sum("all").alias("seats"), F.sum("blocks").alias("blocks"), F.count(F.lit(1)).alias("n")).first()
    seats, blocks, n = whole["seats"] or 0, max(whole["blocks"] or 0.0, 1e-300), whole["n"]
    of = own.withColumn("j", F.explode(F.sequence(F.lit(1), F.lit(shards))))
    size = F.floor(F.lit(seats) * F.col("j") / shards)

    def upto(h):  # seats of quotient blocks / h or more
        return F.greatest(F.lit(0).cast("long"), F.least("all", F.floor(F.col("blocks") * (h / F.lit(blocks)) + 0.5)))

    last = F.col("j") == shards
    of = of.withColumns({"sure": F.when(last, F.col("all")).otherwise(upto(size - 2 * n)),
                         "most": F.when(last, F.col("all")).otherwise(upto(size + 2 * n))})
    open_seats = (of.where("most > sure").withColumn("k", F.explode(F.sequence(F.col("sure") + 1, F.col("most"))))
                  .select("j", "place", ((F.col("k") - 0.5) / F.col("blocks")).alias("at"), "k"))
    ranked = stage(assign_surrogate_keys(open_seats, ["j", "at", "place", "k"], start=0, name="rank"), "mix-seats")
    room = of.groupBy("j").agg((F.first(size) - F.sum("sure")).alias("room"))  # a row per shard
    first = ranked.groupBy("j").agg(F.min("rank").alias("first"))
    won = (ranked.join(first.join(room, "j"), "j").where("rank - first < room")
           .groupBy("j", "place").agg(F.count(F.lit(1)).alias("won")))
    out = of.join(won, ["j", "place"], "left").withColumn("has", F.col("sure") + F.coalesce("won", F.lit(0)))
    return out.groupBy("place").agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "has"))), lambda s: s["has"]).alias("seats"))


def quotas(sources: DataFrame, shards: int = SHARDS, block: int = BLOCK) -> DataFrame:
    """Blocks per source and output shard, from (source, target): (source, shard, quota)."""
    numbered = stage(assign_surrogate_keys(sources.select("source", "target"), ["source"], start=0, name="place"), "mix-quotas")
    has = house(numbered.select("place", (F.col("target") / F.lit(float(block))).alias("blocks"), F.lit(1 << 62).alias("limit")), shards)
    out = numbered.join(has, "place").select("source", "seats", F.posexplode(F.array(F.lit(0).cast("long"), *[F.col("seats")[j] for j in range(shards - 1)])))
    return out.select("source", F.col("pos").alias("shard"), (F.col("seats")[F.col("pos")] - F.col("col")).alias("quota"))


def mix(documents: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST,
        block: int = BLOCK, seed: int = SEED, shards: int = SHARDS) -> DataFrame:
    """One row per document: the words that the mix takes from it, repeats counted.

    ``pieces`` lists them in text order, once per block and shard that takes it: (shard, words).
    Only (source, id, size) is shuffled, after equal rows were counted.
    """
    rows = documents.select("source", "doc_id", F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")),
                                                               F.lit(WORDS)).cast("long").alias("size"))
    groups = collapse(rows, "mix-rows").withColumn(
        "_w_source", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")))
    seen = groups.count()
    sizes = groups.groupBy("_w_source", "source").agg(F.sum(F.col("size") * F.col("_w_n")).alias("source_size"))
    aims = stage(
        targets(sizes, weights, share, most)
        .withColumn("_w_block", F.greatest(F.lit(1), F.least(F.lit(block), F.floor(F.col("source_size") / FEW))))
        .withColumn("_w_blocks", F.greatest(F.lit(1).cast("long"), F.round(F.col("source_size") / F.col("_w_block")).cast("long"))),
        "mix-sources").drop("source")
    # counted in the source's own blocks, which are source_size / _w_blocks words long
    inner = F.col("target") * F.col("_w_blocks") / F.greatest(F.col("source_size"), F.lit(1))
    dealt = house(aims.select("place", inner.alias("blocks"), F.floor(F.lit(most) * F.col("_w_blocks")).alias("limit")), shards)
    known = stage(aims.join(dealt, "place"), "mix-known")
    laid = running_start(groups, F.col("size") * F.col("_w_n"), ["_w_source"],
                         [F.xxhash64("doc_id", F.lit(seed)), F.col("doc_id"), F.col("size")], bucket_count(seen))
    placed = expand(laid.join(known, "_w_source")).withColumn("_w_start", F.col("_w_start") + F.col("_w_copy") * F.col("size"))

    blocks, total, seats = F.col("_w_blocks"), F.col("source_size"), F.col("seats")
    start, end = F.col("_w_start"), F.col("_w_start") + F.col("size")

    def cut(k):  # first word of block k: equal lengths, to one word
        return F.floor(k * total / blocks)

    def taken_of(k):  # the block fills the seats p, p + blocks, ... of its source, p its place in the permutation
        overlap = F.greatest(F.lit(0).cast("long"), F.least(end, cut(k + 1)) - F.greatest(start, cut(k)))
        return F.transform(F.array(permute(k, blocks, seed)), lambda p: F.transform(
            F.filter(F.transform(F.sequence(F.lit(0), F.lit(max(0, math.ceil(most) - 1))), lambda again: p + again * blocks),
                     lambda seat: (seat < F.element_at(seats, -1)) & (overlap > 0)),
            lambda seat: F.struct(F.size(F.filter(seats, lambda upto: upto <= seat)).alias("shard"), overlap.alias("words"))))[0]

    first = F.greatest(F.lit(0).cast("long"), F.floor(start * blocks / total) - 1)
    last = F.least(blocks - 1, F.floor(end * blocks / total) + 1)
    pieces = F.when(F.col("size") > 0, F.flatten(F.transform(F.sequence(first, last), taken_of))).otherwise(
        F.array().cast("array<struct<shard:int,words:bigint>>"))
    taken = F.aggregate("pieces", F.lit(0).cast("long"), lambda sum_, piece: sum_ + piece["words"])
    return placed.withColumn("pieces", pieces).select(
        "doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "pieces")


def mix_documents(documents: DataFrame, seed: int = SEED, **how) -> DataFrame:
    """The mixed corpus: whole documents, each as often as the mix takes it.

    A document's share taken / size is rounded to whole copies (0, 1 or 2) by a
    seeded draw, so a source's expected words equal what ``mix`` takes.  Equal rows
    are counted, and their shares rounded as one sum: n of them give n times the
    share to one copy, not n times the same draw.  Rows that are not repeated
    aren't shuffled for that; columns of repeated ones must be comparable.
    """
    rate = (mix(documents, seed=seed, **how).groupBy("source", "doc_id", "size")
            .agg((F.sum("taken") / F.greatest(F.sum("size"), F.lit(1))).alias("_w_rate"), F.count(F.lit(1)).alias("_w_rows"))
            .select(F.col("source").alias("_w_s"), F.col("doc_id").alias("_w_d"), F.col("size").alias("_w_z"), "_w_rate", "_w_rows"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sized = documents.withColumn("_w_size", F.regexp_count(text, F.lit(WORDS)).cast("long"))
    joined = sized.join(rate, F.col("source").eqNullSafe(F.col("_w_s")) & F.col("doc_id").eqNullSafe(F.col("_w_d"))
                        & (F.col("_w_size") == F.col("_w_z")))
    columns = [F.col(f"`{c}`") for c in documents.columns]
    once = joined.where("_w_rows = 1").select(*columns, "_w_rate", F.lit(1).cast("long").alias("_w_same"))
    again = joined.where("_w_rows > 1").groupBy(*columns, "_w_rate").agg(F.count(F.lit(1)).alias("_w_same"))
    draw = F.pmod(F.xxhash64("doc_id", text, F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = F.floor(F.col("_w_same") * F.col("_w_rate") + draw).cast("long")
    out = once.unionByName(again).withColumn("_w_n", copies).where("_w_n > 0")
    return expand(out.drop("_w_rate", "_w_same")).select(*columns)
