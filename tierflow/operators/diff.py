"""Change rows between two states of a table and recovery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.scalar import ntz_literal
from tierflow.operators.dedup import latest_per_key


def table_diff(before: DataFrame, after: DataFrame, key) -> DataFrame:
    """One row per changed key with ``_change_type`` insert / update / delete.

    One aggregate over both states puts a key's two rows side by side; values are
    compared as they are, NULL equal to NULL.  Each state is read and shuffled
    once.  Keys are unique in either state; a NULL key is a key of its own.
    Output columns: the key, ``<col>_before`` / ``<col>_after``, ``_change_type``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = [c for c in after.columns if c not in keys]
    row = F.struct(F.lit(True).alias("_there"), *cols)

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.lit(name).alias("_side"), row.alias("_row"))

    def of(name: str) -> Column:
        return F.first(F.when(F.col("_side") == name, F.col("_row")), ignorenulls=True)

    both = (side(before, "before").unionByName(side(after, "after")).groupBy(*keys)
            .agg(of("before").alias("_before"), of("after").alias("_after")))
    change = (F.when(F.col("_before").isNull(), "insert").when(F.col("_after").isNull(), "delete")
              .when(~F.col("_before").eqNullSafe(F.col("_after")), "update"))
    return both.withColumn("_change_type", change).where("_change_type IS NOT NULL").select(
        *keys, *[F.col(f"_before.{c}").alias(f"{c}_before") for c in cols],
        *[F.col(f"_after.{c}").alias(f"{c}_after") for c in cols], "_change_type")


def state_as_of(history: DataFrame, key, ts_col: str, at, order_by) -> DataFrame:
    """Each key's newest row loaded at or before ``at`` (time travel on an append-only table)."""
    return latest_per_key(history.filter(F.col(ts_col) <= ntz_literal(at)), key, order_by)


def deleted_rows(old: DataFrame, current: DataFrame, key) -> DataFrame:
    """Rows of an old state whose key is gone from the current one."""
    keys = [key] if isinstance(key, str) else list(key)
    return old.join(current.select(*keys), keys, "left_anti")
