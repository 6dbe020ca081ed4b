"""Keyed incremental merge, high-water mark and in-place repair.

``merge_rows`` is the merge as a function of two frames; ``merge_upsert`` applies
it to the buckets of a ``KeyedTable`` that the batch touches.  Given an order,
the stored row takes part in it: an older change that arrives late never
replaces a newer one, and the result is the same however the changes are cut
into batches.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.functions.scalar import ntz_literal
from tierflow.operators.dedup import _order_cols, latest_per_key, qualify
from tierflow.session import stage
from tierflow.sources.storage import BatchTable, KeyedTable, Table, bucket_of


class DuplicateKeyError(ValueError):
    """A merge batch holds the same key twice (the merge would be ambiguous)."""


def assert_unique_keys(batch: DataFrame, key) -> None:
    keys = [key] if isinstance(key, str) else list(key)
    dup = batch.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"duplicate key in merge batch: {dup[0].asDict()}")


def high_water_mark(df: DataFrame, col: str, default: str = "1900-01-01 00:00:00"):
    """``coalesce(max(col), default)`` as a driver-side literal (one value)."""
    dflt = F.lit(default).cast(df.schema[col].dataType)
    return df.agg(F.coalesce(F.max(col), dflt).alias("m")).collect()[0]["m"]


def above_mark(source: DataFrame, col: str, mark, lookback: _dt.timedelta | None = None) -> DataFrame:
    """Rows strictly after the mark; with ``lookback``, re-read a window.

    The mark is a literal, so the predicate reaches the Parquet scan as a
    pushed filter (row groups wholly at or below the mark are skipped).
    Re-read rows are harmless: the merge is keyed and the newest row wins.
    """
    if lookback is None:
        return source.filter(F.col(col) > ntz_literal(mark))
    return source.filter(F.col(col) >= ntz_literal(mark - lookback))


def merge_rows(current: DataFrame, batch: DataFrame, key, order_by: Sequence = ()) -> DataFrame:
    """One row per key of both; of a key in both the first under ``order_by``, then the batch's.

    A NULL key is a key of its own.  One window over the union: both sides
    are limited to one row per key before the shuffle.
    """
    both = (current.withColumn("_from_batch", F.lit(0))
            .unionByName(batch.select(*current.columns).withColumn("_from_batch", F.lit(1))))
    return latest_per_key(both, key, [*order_by, "-_from_batch"]).drop("_from_batch")


class ChangeLog(BatchTable):
    """The change rows of a merged table, one partition per run.

    Rows have the key, ``<col>_before``, ``<col>_after`` and ``_change_type`` (insert or
    update; a merge deletes nothing), like those of ``table_diff``.  A run's rows
    are written before the table changes, so a run that is repeated after a
    failure merges what it has recorded and records nothing anew.
    """

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, root, by=("_run",))

    def record(self, run: int, changes: DataFrame) -> None:
        self.write(changes.withColumn("_run", F.lit(run).cast("int")))

    def of(self, run: int) -> DataFrame:
        return self.read().where(F.col("_run") == run).drop("_run")


def change_schema(schema: T.StructType, keys: list[str]) -> T.StructType:
    cols = [f for f in schema.fields if f.name not in keys]
    return T.StructType([*[schema[k] for k in keys], *[T.StructField(f"{f.name}_before", f.dataType) for f in cols],
                         *[T.StructField(f"{f.name}_after", f.dataType) for f in cols], T.StructField("_change_type", T.StringType())])


def image(changes: DataFrame, keys: list[str], columns: list[str], side: str) -> DataFrame:
    """The rows of a change log before or after the change, with the table's columns."""
    there = changes.where("_change_type <> 'insert'") if side == "before" else changes.where("_change_type <> 'delete'")
    return there.select(*[F.col(c) if c in keys else F.col(f"{c}_{side}").alias(c) for c in columns])


def merge_with_before(current: DataFrame, batch: DataFrame, key, order_by: Sequence = ()) -> DataFrame:
    """``merge_rows`` with the stored row of each key in ``_before`` and whether the batch's row won in ``_from_batch``."""
    keys = [key] if isinstance(key, str) else list(key)
    both = (current.withColumn("_from_batch", F.lit(0))
            .unionByName(batch.select(*current.columns).withColumn("_from_batch", F.lit(1))))
    stored = F.when(F.col("_from_batch") == 0, F.struct(*current.columns))
    both = both.withColumn("_before", F.first(stored, ignorenulls=True).over(Window.partitionBy(*keys)))
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*_order_cols([*order_by, "-_from_batch"])))
    return qualify(both, first, lambda c: c == 1)


def changed_rows(merged: DataFrame, key) -> DataFrame:
    """The change rows among those of ``merge_with_before``; a row that replaces its equal is none."""
    keys = [key] if isinstance(key, str) else list(key)
    cols = [c for c in merged.columns if c not in (*keys, "_before", "_from_batch")]
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_before.{c}")) for c in cols], F.lit(True))
    new = F.col("_before").isNull()
    return merged.where((F.col("_from_batch") == 1) & (new | ~same)).select(
        *keys, *[F.col(f"_before.{c}").alias(f"{c}_before") for c in cols], *[F.col(c).alias(f"{c}_after") for c in cols],
        F.when(new, "insert").otherwise("update").alias("_change_type"))


def merge_upsert(table: KeyedTable, batch: DataFrame, order_by: Sequence = (), check_unique: bool = True,
                 log: ChangeLog | None = None, run: int | None = None, staged: bool = False) -> None:
    """Upsert ``batch`` into ``table``; only the buckets that hold a batch key are rewritten.

    The batch is staged unless it is read from files already, so that the key
    check, the bucket list (at most one number per bucket) and the merge read the
    same rows.  Replaying a batch
    leaves the table as it is.  With a ``log`` the change rows of the run come out
    of the merge itself, which has both sides of every key at hand.  A table
    whose buckets have outgrown their aim is laid out anew.
    """
    repeated = log is not None and run in log.batches()
    if repeated:
        names = table.schema().fieldNames() if table.exists() else [c for c in batch.columns]
        batch = image(log.of(run), table.keys, names, "after")
    if not staged or repeated:
        batch = stage(batch, "merge-batch")
    if check_unique:
        assert_unique_keys(batch, table.keys)
    if not table.exists():
        if log is not None and not repeated:
            none = F.lit(None).cast(batch.schema)
            log.record(run, changed_rows(batch.withColumns({"_before": none, "_from_batch": F.lit(1)}), table.keys))
        table.overwrite(batch)
        return
    touched = [r[0] for r in batch.select(bucket_of(table.keys, table.buckets)).distinct().collect()]
    if not touched:
        return
    rows = Observation()
    if log is None or repeated:
        merged = merge_rows(table.read(touched), batch, table.keys, order_by)
    else:
        merged = merge_with_before(table.read(touched), batch, table.keys, order_by)
    merged = stage(merged.observe(rows, F.count(F.lit(1)).alias("n")), "merged")
    if log is not None and not repeated:
        log.record(run, changed_rows(merged, table.keys))
    table.replace_buckets(merged, staged=True)
    table.regrow(rows.get["n"] / len(touched))


def incremental_run(table: KeyedTable, source: DataFrame, ts_col: str, order_by: Sequence,
                    lookback: _dt.timedelta | None = None, log: ChangeLog | None = None, run: int | None = None) -> None:
    """High-water filter -> newest row per key in the batch -> merge.

    The mark is ``max(ts_col)`` of the target (a scan of that one column).
    """
    if table.exists():
        source = above_mark(source, ts_col, high_water_mark(table.read(), ts_col), lookback)
    merge_upsert(table, latest_per_key(source, table.keys, order_by), order_by, check_unique=False, log=log, run=run)


class Ledger(BatchTable):
    """The batches that an incremental model has processed, one partition per run.

    A mark or a lookback misses a batch that comes later than it reaches back; the
    ledger knows each batch by its id, whatever its age.  A batch is complete when it
    is first seen.  NULL is a batch like any other.
    """

    def __init__(self, spark: SparkSession, root: str, col: str = "_batch_id"):
        super().__init__(spark, root, by=("_run",))
        self.col = col

    def unseen(self, source: DataFrame) -> DataFrame:
        """The batch ids of ``source`` that no run has processed, one row each."""
        ids = source.select(self.col).distinct()
        if not self.exists():
            return ids
        seen = self.read().select(F.col(self.col).cast(source.schema[self.col].dataType).alias("_seen"))
        return ids.join(seen, F.col(self.col).eqNullSafe(F.col("_seen")), "left_anti")


def ledger_run(table: KeyedTable, source: DataFrame, ledger: Ledger, order_by: Sequence) -> int:
    """Merge the rows of the batches that the ledger doesn't hold, then enter these batches.

    Returns their number.  A run that fails before the entry merges the same
    rows again, which the order of the merge leaves without effect.
    """
    new = stage(ledger.unseen(source), "ledger-new")
    n = new.count()
    if n:
        picked = new.withColumnRenamed(ledger.col, "_new")
        rows = source.join(picked, F.col(ledger.col).eqNullSafe(F.col("_new")), "left_semi")
        merge_upsert(table, latest_per_key(rows, table.keys, order_by), order_by, check_unique=False)
        ledger.write(new.withColumn("_run", F.lit(max(ledger.batches(), default=0) + 1)))
    return n


def replace_with_dedup(table: Table, key, order_by: Sequence) -> None:
    """Replace a table by its own newest-row-per-key content (one refresh).

    Rows are limited to one per key before the shuffle, so a key with a third
    of the rows costs one row per task.
    """
    table.overwrite(latest_per_key(table.read(), key, order_by))
