"""Registered queries for version history (SCD2) and as-of lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierflow.functions.scalar import ntz_literal
from tierflow.operators.dedup import latest_per_key
from tierflow.operators.joins import asof_join, join_dimension
from tierflow.operators.scd2 import Scd2Table, history_from_changes
from tierflow.plans import core_queries as Q
from tierflow.plans.incremental import batches_of
from tierflow.plans.oracle import with_models
from tierflow.plans.registry import register
from tierflow.session import stage, work_dir
from tierflow.sources.fixtures import raw_clientes_history
from tierflow.sources.tables import read_table

HISTORY_COLUMNS = ("cliente_id", "nombre", "email", "ciudad", "fecha_registro", "_inserted_at")


def customer_changes(spark, sf):
    """City moves joined with the other customer attributes from silver (left join)."""
    moves = raw_clientes_history(spark, sf)
    attrs = Q.stg_c(spark, sf).select("cliente_id", "nombre", "email", "fecha_registro")
    return join_dimension(moves, attrs, "cliente_id", "left").select(*HISTORY_COLUMNS)


def fold(table: Scd2Table, changes, order_by=()) -> Scd2Table:
    """Apply the changes load by load, as the daily job does.

    A load stamps one time on all its rows, so there is one run per distinct
    time.  A run is given the rows of its load only: earlier rows open nothing.
    """
    for t in batches_of(changes, "_inserted_at"):
        load = changes.filter(F.col("_inserted_at") == ntz_literal(t))
        table.apply(latest_per_key(load, table.key, ["-_inserted_at", *order_by]))
    return table


_HIST_SQL = with_models("stg_clientes", "raw_clientes_history") + """
, hist as (
  select h.cliente_id, s.nombre, s.email, h.ciudad, s.fecha_registro, h._inserted_at
  from raw_clientes_history h left join stg_clientes s on h.cliente_id = s.cliente_id)
, versions as (
  select cliente_id, nombre, email, ciudad, fecha_registro, _inserted_at as valid_from,
         lead(_inserted_at) over (partition by cliente_id order by _inserted_at) as valid_to,
         sha256(cast(cliente_id as varchar) || '|' || cast(_inserted_at as varchar)) as version_hash
  from hist)
"""


@register("scd2_snapshot", _HIST_SQL + "select * from versions")
def q_scd2(spark, sf):
    changes = stage(customer_changes(spark, sf), "customer-changes")
    return fold(Scd2Table(spark, work_dir(spark, "clientes_snapshot"), "cliente_id", "_inserted_at"), changes).history()


@register("scd2_rebuild", _HIST_SQL + "select * from versions")
def q_scd2_rebuild(spark, sf):
    return history_from_changes(customer_changes(spark, sf), "cliente_id", "_inserted_at")


_PROBE = "timestamp_ntz '2024-01-01 00:00:00' + interval '1' day * cast(o_orderkey % 90 as int)"


@register("asof_history_join", _HIST_SQL + """
, probes as (
  select o_orderkey, o_custkey,
         timestamp '2024-01-01 00:00:00' + interval '1' day * cast(o_orderkey % 90 as int) as probe_ts
  from orders)
select p.o_orderkey, p.o_custkey, p.probe_ts, v.ciudad, v.valid_from
from probes p left join versions v
  on p.o_custkey = v.cliente_id and p.probe_ts >= v.valid_from
 and (v.valid_to is null or p.probe_ts < v.valid_to)""")
def q_asof(spark, sf):
    probes = read_table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.expr(_PROBE).alias("probe_ts"))
    hist = (history_from_changes(customer_changes(spark, sf), "cliente_id", "_inserted_at")
            .select("cliente_id", "ciudad", "valid_from", "valid_to"))
    out = asof_join(probes, hist.withColumnRenamed("cliente_id", "o_custkey"), "o_custkey", "probe_ts")
    return out.select("o_orderkey", "o_custkey", "probe_ts", "ciudad", "valid_from")


_ORDER_VERSION_COLS = ("pedido_id", "cliente_id", "estado", "precio_unitario", "cantidad", "_inserted_at")


@register("scd2_check_strategy", with_models("bronze_pedidos") + """
, src as (
  select pedido_id, cliente_id, estado, precio_unitario, cantidad, _inserted_at from (
    select *, row_number() over (partition by pedido_id, _inserted_at
                                 order by cliente_id nulls first, estado nulls first, precio_unitario nulls first,
                                          cantidad nulls first) as k
    from bronze_pedidos) x where k = 1)
, marked as (
  select *, row_number() over w as rn, lag(estado) over w as prev_estado, lag(precio_unitario) over w as prev_precio
  from src window w as (partition by pedido_id order by _inserted_at))
, starts as (
  select * from marked
  where rn = 1 or prev_estado is distinct from estado or prev_precio is distinct from precio_unitario)
select pedido_id, cliente_id, estado, precio_unitario, cantidad, _inserted_at as valid_from,
       lead(_inserted_at) over (partition by pedido_id order by _inserted_at) as valid_to,
       sha256(cast(pedido_id as varchar) || '|' || cast(_inserted_at as varchar)) as version_hash
from starts""")
def q_scd2_check(spark, sf):
    """Order history tracking (status, price); a reload with a new quantity opens no version."""
    changes = stage(Q.bronze_p(spark, sf).select(*_ORDER_VERSION_COLS), "order-changes")
    table = Scd2Table(spark, work_dir(spark, "pedidos_snapshot"), "pedido_id", "_inserted_at",
                      check_cols=["estado", "precio_unitario"])
    return fold(table, changes, ["cliente_id", "estado", "precio_unitario", "cantidad"]).history()
