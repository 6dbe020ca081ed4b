"""The incremental orders model (I5) and its batch-by-batch fold."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions.scalar import clean_text
from tierflow.operators.merge import ChangeLog, incremental_run
from tierflow.plans.models import PEDIDOS_ORDER
from tierflow.session import work_dir
from tierflow.sources.storage import KeyedTable

INCREMENTAL_COLUMNS = ("pedido_id", "cliente_id", "producto", "cantidad", "precio_unitario",
                       "fecha_pedido", "estado", "_batch_id", "_inserted_at")


def incremental_source(bronze: DataFrame) -> DataFrame:
    """The incremental model's select list over bronze orders (no date filter, no flags)."""
    return bronze.select("pedido_id", "cliente_id", clean_text("producto").alias("producto"),
                         "cantidad", "precio_unitario", "fecha_pedido", "estado",
                         "_batch_id", "_inserted_at")


def batches_of(rows: DataFrame, col: str = "_batch_id") -> list:
    """The distinct batches of the data in order, one value per load; NULL, if any, comes first."""
    return sorted((r[0] for r in rows.select(col).distinct().collect()), key=lambda b: (b is not None, b))


def in_batches(batches: list, col: str = "_batch_id") -> Column:
    """True for the rows of these batches; NULL is a batch like any other."""
    known = F.col(col).isin([b for b in batches if b is not None])
    return F.when(F.col(col).isNull(), F.lit(None in batches)).otherwise(known)


def fold_batches(spark: SparkSession, bronze: DataFrame, order: list,
                 lookback: _dt.timedelta | None = None, buckets: int | None = None,
                 table: KeyedTable | None = None, after_run=None, log: ChangeLog | None = None) -> KeyedTable:
    """Run the incremental model once per arriving batch.

    Run ``i`` sees the source as it stands after batches ``order[:i+1]``
    have landed (the landing table only grows); the high-water mark decides
    which of its rows are new.  ``after_run(i, table)`` is called after each run;
    ``log`` gets the change rows of run ``i``.
    """
    src = incremental_source(bronze)
    table = table or KeyedTable(spark, work_dir(spark, "pedidos_incremental"), "pedido_id", buckets)
    landed = F.lit(False)
    for i, b in enumerate(order):
        landed = landed | F.col("_batch_id").eqNullSafe(F.lit(b))
        incremental_run(table, src.filter(landed), "_inserted_at", PEDIDOS_ORDER, lookback=lookback,
                        log=log, run=i)
        if after_run:
            after_run(i, table)
    return table
