"""Raw landing tables derived from the driver's TPC-H-style tables.

The driver data is clean, so the dirt classes of the raw layer (untrimmed
text, bad dates, non-numeric quantities, orphan keys, re-loaded rows, JSON
attributes) are added by three plain-SQL views.  The same text runs on Spark
and on the DuckDB oracle; the marker ``TS`` becomes ``timestamp_ntz`` in Spark
and ``timestamp`` in DuckDB.

All work grows with ``customer`` / ``orders``: nothing here is a fixed input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierflow.sources.tables import read_table

# The overlay views (shared with the oracle; see FIXTURES.md).
RAW_CLIENTES_SQL = """
select c_custkey as id,
  case when c_custkey % 41 = 0 then '  ' || upper(c_name) || '  ' else c_name end as nombre,
  case when c_custkey % 43 = 0 then null
       when c_custkey % 47 = 0 then 'usuariosinarroba.com'
       when c_custkey % 53 = 0 then ' USER.' || cast(c_custkey - 1 as string) || '@Empresa.com '
       else 'user.' || cast(c_custkey as string) || '@empresa.com' end as email,
  case when c_custkey % 41 = 0 then '  ' || n_name else n_name end as ciudad,
  case when c_custkey % 59 = 0 then '1800-03-15'
       when c_custkey % 61 = 0 then '99/99/9999'
       when c_custkey % 67 = 0 then '2030-01-01'
       else '202' || cast(c_custkey % 5 as string) || '-0' || cast(1 + c_custkey % 9 as string) || '-15' end as fecha_registro,
  cast(1 + c_custkey % 3 as int) as _batch_id,
  TS '2024-01-01 00:00:00' + interval '1' day * cast(1 + c_custkey % 3 as int) as _inserted_at
from {customer} join {nation} on c_nationkey = n_nationkey
"""

RAW_PEDIDOS_SQL = """
with base as (
select o_orderkey as id,
  case when o_orderkey % 101 = 0 then 990000 + o_orderkey % 1000 else o_custkey end as cliente_id,
  case when o_orderkey % 13 = 0 then '  ' || lower(o_orderpriority) || '  ' else o_orderpriority end as producto,
  case when o_orderkey % 97 = 0 then 'N/A'
       when o_orderkey % 89 = 0 then '0'
       when o_orderkey % 83 = 0 then '-3'
       else cast(1 + o_orderkey % 20 as string) end as cantidad,
  case when o_orderkey % 79 = 0 then null
       when o_orderkey % 73 = 0 then '-12.50'
       else cast(cast(o_totalprice as decimal(10,2)) as string) end as precio_unitario,
  case when o_orderkey % 71 = 0 then '15/03/2024'
       when o_orderkey % 67 = 0 then '2030-01-01'
       else cast(cast(o_orderdate as date) as string) end as fecha_pedido,
  o_orderstatus as estado,
  cast(1 + o_orderkey % 3 as int) as _batch_id,
  case when o_orderkey % 4 = 0 then '{{"color":"rojo","garantia_meses":12}}'
       when o_orderkey % 4 = 1 then '{{"canal_venta":"web","descuento_pct":5,"promocion":null}}'
       when o_orderkey % 4 = 2 then '{{"color":"azul","sku_proveedor":"PRV-' || cast(1000 + o_orderkey % 9000 as string) || '"}}'
       else '{{"canal_venta":"app","promocion":"black_friday","garantia_meses":24,"color":"gris"}}' end as atributos_extra,
  TS '2024-01-01 00:00:00' + interval '1' day * cast(1 + o_orderkey % 3 as int) as _inserted_at
from {orders})
select * from base
union all
select id, cliente_id, producto, '7', precio_unitario, fecha_pedido, estado,
  _batch_id + 1, '{{"color":"negro"}}', _inserted_at + interval '1' day
from base where id % 37 = 0
union all
select id, cliente_id, producto || ' twice', cantidad, precio_unitario, fecha_pedido, estado,
  _batch_id, atributos_extra, _inserted_at
from base where id % 31 = 0
"""

RAW_CLIENTES_HISTORY_SQL = """
select c_custkey as cliente_id, n_name as ciudad, TS '2024-01-01 00:00:00' as _inserted_at
from {customer} join {nation} on c_nationkey = n_nationkey
union all
select c_custkey, 'NATION_' || cast((c_nationkey + 1) % 25 as string), TS '2024-02-01 00:00:00'
from {customer} where c_custkey % 7 = 0
union all
select c_custkey, 'NATION_' || cast((c_nationkey + 2) % 25 as string), TS '2024-03-01 00:00:00'
from {customer} where c_custkey % 21 = 0
"""

_VIEWS = {
    "raw_clientes": RAW_CLIENTES_SQL,
    "raw_pedidos": RAW_PEDIDOS_SQL,
    "raw_clientes_history": RAW_CLIENTES_HISTORY_SQL,
}


def _spark_text(sql: str) -> str:
    return sql.replace("TS '", "timestamp_ntz '")


def _duck_text(sql: str) -> str:
    # DuckDB reads the plain table names; undo the Spark DataFrame placeholders.
    out = sql.replace("TS '", "timestamp '")
    for t in ("customer", "nation", "orders"):
        out = out.replace("{" + t + "}", t)
    return out.replace("{{", "{").replace("}}", "}")


def raw_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One overlay view as a DataFrame, with its inputs bound as parameters."""
    sql = _VIEWS[name]
    args = {}
    for t in ("customer", "nation", "orders"):
        if "{" + t + "}" in sql:
            args[t] = read_table(spark, sf_dir, t)
    return spark.sql(_spark_text(sql), **args)


def raw_clientes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_view(spark, sf_dir, "raw_clientes")


def raw_pedidos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_view(spark, sf_dir, "raw_pedidos")


def raw_clientes_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_view(spark, sf_dir, "raw_clientes_history")


def oracle_ctes(*names: str) -> str:
    """``with`` prefix for DuckDB that defines the named overlay views."""
    parts = [f"{n} as ({_duck_text(_VIEWS[n]).strip()})" for n in names]
    return "with " + ",\n".join(parts) + "\n"
