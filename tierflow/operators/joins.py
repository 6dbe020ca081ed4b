"""Joins between layers.

No join hints: Spark broadcasts a side when its statistics or, at run time,
the measured size of its shuffle are under ``spark.sql.autoBroadcastJoinThreshold``
(bytes), and otherwise shuffles both and splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierflow.operators.ranges import PART, carried, inside, ordered_ranges


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "inner") -> DataFrame:
    """Fact x dimension equi-join."""
    return fact.join(dim, on, how)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key has no parent (``relationships`` test).

    A NULL child key is not an orphan (it is ``not_null``'s business).
    """
    parent_key = parent_key or child_key
    parent_keys = parent.select(F.col(parent_key).alias("_pk")).distinct()
    return (child.filter(F.col(child_key).isNotNull())
                 .join(parent_keys, F.col(child_key) == F.col("_pk"), "left_anti"))


def asof_join(probe: DataFrame, history: DataFrame, key: str, probe_ts: str,
              valid_from: str = "valid_from", valid_to: str = "valid_to",
              how: str = "left") -> DataFrame:
    """State of an entity at time T, from a validity-interval history.

    A merge scan instead of a join on the key: versions and probes are put in
    one order (key, time, versions first) that is range partitioned, and each
    probe takes the last version before it, from its own range or carried over
    from an earlier one.  The work is linear in probes plus versions and a key
    that has a third of both spreads over tasks.  Intervals of one key are
    disjoint, so the last version that began by T is the one that can hold T.
    With ``how='left'`` a probe without a version keeps its row with NULL state;
    a NULL key or time has none.
    """
    state = [c for c in history.columns if c != key]
    versions = (history.where(F.col(key).isNotNull() & F.col(valid_from).isNotNull())
                .select(F.col(key).alias("_k"), F.col(valid_from).alias("_t"), F.lit(0).alias("_side"), F.lit(0).cast("long").alias("_tie"),
                        F.struct(F.col(key).alias("_k"), *[F.col(c).alias(f"_v{i}") for i, c in enumerate(state)]).alias("_version"),
                        F.lit(None).cast(probe.schema).alias("_probe")))
    row = F.struct(*[F.col(c) for c in probe.columns])
    probes = probe.select(F.col(key).alias("_k"), F.col(probe_ts).alias("_t"), F.lit(1).alias("_side"), F.xxhash64(F.to_json(row)).alias("_tie"),
                          F.lit(None).cast(versions.schema["_version"].dataType).alias("_version"), row.alias("_probe"))
    order = ["_k", "_t", "_side", "_tie"]
    ranges = ordered_ranges(versions.unionByName(probes), order, "asof")
    so_far = inside(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = ranges.withColumn("_own", F.last("_version", ignorenulls=True).over(so_far)).where("_side = 1")
    seen = seen.join(carried(ranges, F.col("_version"), order), PART, "left").withColumn("_held", F.coalesce("_own", "_carry"))
    until = F.col(f"_held._v{state.index(valid_to)}")
    holds = (F.col("_held._k") == F.col("_k")) & F.col("_t").isNotNull() & (until.isNull() | (F.col("_t") < until))
    seen = seen.withColumn("_held", F.when(holds, F.col("_held")))
    if how == "inner":
        seen = seen.where(F.col("_held").isNotNull())
    elif how != "left":
        raise ValueError(f"an as-of join is left or inner, not {how}")
    return seen.select("_probe.*", *[F.col(f"_held._v{i}").alias(c) for i, c in enumerate(state)])
