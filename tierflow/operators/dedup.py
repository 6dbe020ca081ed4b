"""Deduplication and top-per-key operators.

``latest_per_key`` is written the way a Spark user writes it: a
``row_number()`` window and a ``= 1`` filter.  Catalyst turns that into a
``WindowGroupLimit`` that runs *partially before the shuffle*, so each map
task forwards at most one row per key: a hot key holding a third of all rows
costs one row per map task in the exchange, not a third of the data in one
reducer.  Every window gets a total order (ties broken by the listed columns)
so the kept row is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order_cols(order_by: Sequence) -> list[Column]:
    """``"-x"`` = descending nulls last, ``"x"`` = ascending nulls first."""
    out = []
    for o in order_by:
        if isinstance(o, Column):
            out.append(o)
        elif o.startswith("-"):
            out.append(F.col(o[1:]).desc_nulls_last())
        else:
            out.append(F.col(o).asc_nulls_first())
    return out


def _keys(keys) -> list:
    return [keys] if isinstance(keys, (str, Column)) else list(keys)


def qualify(df: DataFrame, ranking: Column, keep: Column, name: str = "_rk") -> DataFrame:
    """the ``QUALIFY`` form: add the window column, filter on it, drop it."""
    return df.withColumn(name, ranking).filter(keep(F.col(name)) if callable(keep) else keep).drop(name)


def latest_per_key(df: DataFrame, keys, order_by: Sequence) -> DataFrame:
    """keep the first row per key under ``order_by`` (one row per key)."""
    w = Window.partitionBy(*_keys(keys)).orderBy(*_order_cols(order_by))
    return qualify(df, F.row_number().over(w), lambda c: c == 1)


def latest_per_expr_key(df: DataFrame, key_expr: Column, order_by: Sequence,
                        key_name: str = "_dedup_key") -> DataFrame:
    """partition by an *expression* of columns (e.g. a normalised email).

    The expression is materialised once as a column so the exchange hashes a
    plain attribute, then dropped.
    """
    out = latest_per_key(df.withColumn(key_name, key_expr), key_name, order_by)
    return out.drop(key_name)


def rank_top1(df: DataFrame, keys, order_by: Sequence) -> DataFrame:
    """``rank() = 1``: every row tied for first place is kept.

    Ties are all kept, so a rank window would send a hot key's tied rows to
    one task.  Instead: the best order values per key (one row per key, limited
    before the shuffle), then an equi-join of the rows to them on (key, order
    values).  A hot group becomes a skewed join key, which AQE splits.
    """
    ks = [F.col(k) if isinstance(k, str) else k for k in _keys(keys)]
    order = [o.lstrip("-") if isinstance(o, str) else o for o in order_by]
    if any(isinstance(o, Column) for o in order):
        raise TypeError("rank_top1 orders by column names")
    best = (latest_per_key(df.select(*[k.alias(f"_bk{i}") for i, k in enumerate(ks)], *order), [f"_bk{i}" for i in range(len(ks))], order_by)
            .select(*[f"_bk{i}" for i in range(len(ks))], *[F.col(c).alias(f"_bo{i}") for i, c in enumerate(order)]))
    cond = ([k.eqNullSafe(F.col(f"_bk{i}")) for i, k in enumerate(ks)]
            + [F.col(c).eqNullSafe(F.col(f"_bo{i}")) for i, c in enumerate(order)])
    return df.join(best, cond, "inner").select(*df.columns)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct (hash aggregate, partial on the map side)."""
    return df.dropDuplicates()


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct values of one key."""
    return df.select(key).distinct()
