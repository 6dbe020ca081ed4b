"""Raw-layer loads (A5, A6): stamped batch appends and JSON parsed on insert.

A raw table is append-only.  Each load is one partition of a ``BatchTable``,
stamped with the next batch id and one load time for the whole batch, the way a
column default fills every row of one ``INSERT``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.scalar import ntz_literal
from tierflow.sources.storage import BatchTable


def stamp_batch(df: DataFrame, batch_id: int, loaded_at: _dt.datetime | Column | None = None) -> DataFrame:
    """Add ``_batch_id`` and ``_inserted_at`` (default: the load's local time, no zone)."""
    if loaded_at is None:
        ts = F.localtimestamp()
    elif isinstance(loaded_at, Column):
        ts = loaded_at
    else:
        ts = ntz_literal(loaded_at)
    return df.withColumn("_batch_id", F.lit(batch_id).cast("int")).withColumn("_inserted_at", ts)


def next_batch_for(table: BatchTable) -> int:
    """The batch id the next load of ``table`` gets (A8): one more than its last partition's."""
    return max(table.batches(), default=0) + 1


def append_batch(table: BatchTable, rows: DataFrame, loaded_at=None, batch_id: int | None = None) -> int:
    """A5: append ``rows`` as the next batch of ``table``; returns the batch id used.

    A load that failed is repeated under the same ``batch_id``: the batch is
    its own partition, so the repeat replaces what was left of it.
    """
    batch_id = next_batch_for(table) if batch_id is None else batch_id
    table.write(stamp_batch(rows, batch_id, loaded_at))
    return batch_id


def positional(df: DataFrame, names: list[str]) -> DataFrame:
    """Rename columns by position (``$1 .. $n``)."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(df.columns)} columns, {len(names)} names")
    return df.select(*[F.col(c).alias(n) for c, n in zip(df.columns, names)])


def parse_json_columns(df: DataFrame, json_cols: list[str]) -> DataFrame:
    """JSON text -> VARIANT on insert; malformed text becomes NULL."""
    return df.select(*[F.try_parse_json(F.col(c)).alias(c) if c in json_cols else F.col(c)
                       for c in df.columns])


def insert_parsed(table: BatchTable, values: DataFrame, names: list[str], json_cols: list[str]) -> None:
    """``INSERT INTO t (names) SELECT $1.., PARSE_JSON($k) FROM values``.

    A load time that is not among ``names`` is filled with its default, the time of the insert.
    """
    rows = parse_json_columns(positional(values, names), json_cols)
    table.write(rows if "_inserted_at" in names else rows.withColumn("_inserted_at", F.localtimestamp()))


def variant_keys(c: str) -> Column:
    """Sorted, comma-joined top-level keys of a VARIANT object (NULL for NULL)."""
    return F.array_join(F.sort_array(F.json_object_keys(F.to_json(F.col(c)))), ",")

