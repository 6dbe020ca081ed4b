"""Registered queries for stored tables: merge, high-water mark, late data,
in-place repair, full refresh, time travel, recovery and diff."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.operators.diff import deleted_rows, state_as_of, table_diff
from tierflow.operators.merge import ChangeLog, above_mark, high_water_mark, replace_with_dedup
from tierflow.operators.versions import Versions
from tierflow.plans import core_queries as Q
from tierflow.plans.incremental import INCREMENTAL_COLUMNS, batches_of, fold_batches, in_batches, incremental_source
from tierflow.plans.incremental_mart import IncrementalMart
from tierflow.plans.models import PEDIDOS_ORDER
from tierflow.plans.oracle import AS_OF, PEDIDOS_NEWEST, with_models
from tierflow.plans.registry import register
from tierflow.session import stage, work_dir
from tierflow.sources.storage import KeyedTable, Table

_INC_SRC = """
, inc_src as (
select pedido_id, cliente_id, trim(producto) as producto, cantidad, precio_unitario, fecha_pedido, estado,
       _batch_id, _inserted_at from bronze_pedidos)"""

# Batches in order of arrival: the first two, and all.
_FIRST = "(select distinct _batch_id from inc_src order by 1 limit {n})"


def _latest(where: str) -> str:
    return f"""select * exclude (rn) from (
  select *, row_number() over (partition by pedido_id order by {PEDIDOS_NEWEST}) as rn
  from inc_src where {where}) x where rn = 1"""


_BASE = with_models("bronze_pedidos") + _INC_SRC + "\n"


def _bronze(spark, sf) -> DataFrame:
    """Bronze orders, written once: the fold reads them for every batch."""
    return stage(Q.bronze_p(spark, sf), "bronze_pedidos")


def _late_first(batches: list) -> list:
    return [*batches[1:2], *batches[:1], *batches[2:]]


@register("incremental_merge", _BASE + _latest("true"))
def q_incremental_merge(spark, sf):
    b = _bronze(spark, sf)
    return fold_batches(spark, b, batches_of(b)).read()


@register("late_arrivals", _BASE + _latest(f"_batch_id not in {_FIRST.format(n=1)}"))
def q_late_arrivals(spark, sf):
    """The first batch lands after the second: strict mode skips its rows (at or below the mark)."""
    b = _bronze(spark, sf)
    return fold_batches(spark, b, _late_first(batches_of(b))).read()


@register("late_arrivals_lookback", _BASE + _latest("true"))
def q_late_arrivals_lookback(spark, sf):
    """G7 with ``lookback``: the late batch is re-read under the mark and merged (newest row wins)."""
    b = _bronze(spark, sf)
    return fold_batches(spark, b, _late_first(batches_of(b)), lookback=_dt.timedelta(days=3)).read()


@register("highwater_filter", _BASE + f"""
select * from inc_src
where _batch_id in {_FIRST.format(n=3)}
  and _inserted_at > (select coalesce(max(_inserted_at), timestamp '1900-01-01') from inc_src
                      where _batch_id in {_FIRST.format(n=2)})""")
def q_highwater(spark, sf):
    b = _bronze(spark, sf)
    batches = batches_of(b)
    mark = high_water_mark(fold_batches(spark, b, batches[:2]).read(), "_inserted_at")
    return above_mark(incremental_source(b).filter(in_batches(batches[:3])), "_inserted_at", mark)


@register("replace_table_dedup", _BASE + _latest("true"))
def q_replace_dedup(spark, sf):
    t = Table(spark, work_dir(spark, "bronze_repair"))
    t.overwrite(incremental_source(Q.bronze_p(spark, sf)))
    replace_with_dedup(t, "pedido_id", PEDIDOS_ORDER)
    return t.read()


@register("full_refresh_roundtrip", with_models("dim_clientes") + "select * from dim_clientes")
def q_full_refresh(spark, sf):
    """A10: the dimension is refreshed twice, the second time from the table itself."""
    t = Table(spark, work_dir(spark, "dim_clientes"))
    t.overwrite(Q.dim_c(spark, sf))
    t.overwrite(t.read())
    return t.read()


def _versions(spark, sf) -> Versions:
    """The incremental table with its past: change rows of every run, committed a day apart."""
    b = _bronze(spark, sf)
    table = KeyedTable(spark, work_dir(spark, "pedidos_incremental"), "pedido_id")
    past = Versions(spark, work_dir(spark, "pedidos_versions"), table)
    fold_batches(spark, b, batches_of(b), table=table, log=past.log,
                 after_run=lambda i, _: past.enter(i, _dt.datetime(2024, 1, 1) + _dt.timedelta(days=i)))
    return past


@register("table_as_of", _BASE + _latest(f"_batch_id in {_FIRST.format(n=2)}"))
def q_table_as_of(spark, sf):
    """The incremental table as it stood after the second run."""
    return _versions(spark, sf).at_run(1)


@register("table_at_commit_time", _BASE + _latest(f"_batch_id in {_FIRST.format(n=2)}"))
def q_table_at_commit_time(spark, sf):
    """D7 ``AT(TIMESTAMP)``: the table at noon of the second run's day."""
    return _versions(spark, sf).at_time(_dt.datetime(2024, 1, 2, 12))


@register("table_before_commit", _BASE + _latest("_batch_id <> (select max(_batch_id) from inc_src)"))
def q_table_before_commit(spark, sf):
    """D7 ``BEFORE(STATEMENT)``: the table as it was just before the last merge."""
    past = _versions(spark, sf)
    return past.before_run(past.runs.batches()[-1])


@register("table_as_of_time", _BASE + _latest("_inserted_at <= timestamp '2024-01-03 00:00:00'"))
def q_table_as_of_time(spark, sf):
    """Time travel on the append-only source: newest row per key loaded by T."""
    src = incremental_source(Q.bronze_p(spark, sf))
    return state_as_of(src, "pedido_id", "_inserted_at", _dt.datetime(2024, 1, 3), PEDIDOS_ORDER)


@register("recover_deleted", _BASE + "select * from (" + _latest("true") + ") where estado = 'P'")
def q_recover(spark, sf):
    """Rows deleted by a refresh, taken from the copy before it."""
    b = _bronze(spark, sf)
    t = fold_batches(spark, b, batches_of(b))
    before = stage(t.read(), "before-delete")
    t.overwrite(t.read().filter(F.col("estado") != "P"))
    return deleted_rows(before, t.read(), "pedido_id")


_DIFF_COLS = [c for c in INCREMENTAL_COLUMNS if c != "pedido_id"]


def _diff_sql() -> str:
    before = ", ".join(f"b.{c} as {c}_before" for c in _DIFF_COLS)
    after = ", ".join(f"a.{c} as {c}_after" for c in _DIFF_COLS)
    differs = " or ".join(f"b.{c} is distinct from a.{c}" for c in _DIFF_COLS)
    return _BASE + f"""
, v_before as ({_latest(f"_batch_id in {_FIRST.format(n=2)}")})
, v_after as (select * from ({_latest("true")}) where estado <> 'P')
select coalesce(b.pedido_id, a.pedido_id) as pedido_id, {before}, {after},
  case when b.pedido_id is null then 'insert' when a.pedido_id is null then 'delete' else 'update' end
    as _change_type
from v_before b full outer join v_after a on b.pedido_id = a.pedido_id
where b.pedido_id is null or a.pedido_id is null or {differs}"""


@register("table_diff", _diff_sql())
def q_table_diff(spark, sf):
    past = _versions(spark, sf)
    last = past.table.read()
    return table_diff(past.at_run(1), last.filter(F.col("estado") != "P"), "pedido_id")


def _merge_changes_sql() -> str:
    before = ", ".join(f"b.{c} as {c}_before" for c in _DIFF_COLS)
    after = ", ".join(f"a.{c} as {c}_after" for c in _DIFF_COLS)
    differs = " or ".join(f"b.{c} is distinct from a.{c}" for c in _DIFF_COLS)
    return _BASE + f"""
, runs as (select _batch_id, cast(row_number() over (order by _batch_id) - 1 as int) as run
           from (select distinct _batch_id from inc_src) d)
, states as (
  select * exclude (rn) from (
    select *, row_number() over (partition by run, pedido_id order by {PEDIDOS_NEWEST}) as rn
    from (select r.run, s.* from inc_src s join runs b on s._batch_id = b._batch_id join runs r on b.run <= r.run) y) x
  where rn = 1)
select a.run as _run, a.pedido_id, {before}, {after},
  case when b.pedido_id is null then 'insert' else 'update' end as _change_type
from states a left join states b on b.run = a.run - 1 and b.pedido_id = a.pedido_id
where b.pedido_id is null or {differs}"""


@register("merge_changes", _merge_changes_sql())
def q_merge_changes(spark, sf):
    """The change rows of every run, out of the merges themselves; no state is compared with another."""
    b = _bronze(spark, sf)
    log = ChangeLog(spark, work_dir(spark, "pedidos_changes"))
    fold_batches(spark, b, batches_of(b), log=log)
    return log.read()


@register("mart_incremental", with_models("mart") + "select * from mart")
def q_mart_incremental(spark, sf):
    """I8 by deltas: the mart after the last batch, of which each was taken by itself."""
    mart = IncrementalMart(spark, work_dir(spark, "mart_incremental"))
    people, orders = stage(Q.bronze_c(spark, sf), "bronze_clientes"), _bronze(spark, sf)
    for run, b in enumerate(batches_of(people.select("_batch_id").unionByName(orders.select("_batch_id")))):
        mine = F.col("_batch_id").eqNullSafe(F.lit(b))
        mart.run(run, people.where(mine), orders.where(mine), AS_OF)
    return mart.read()
