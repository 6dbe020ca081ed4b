"""Registered queries for the layered models, scalar functions and dedup operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierflow.functions.scalar import (clean_text, json_field, norm_key, parse_json_safe, safe_date,
                                       safe_decimal, safe_int)
from tierflow.operators import dedup
from tierflow.operators.joins import orphans
from tierflow.plans import models as M
from tierflow.plans.oracle import AS_OF, BRONZE_PEDIDOS_NEWEST, CLIENTES_NEWEST, with_models
from tierflow.plans.registry import register
from tierflow.sources.fixtures import raw_clientes, raw_pedidos
from tierflow.sources.tables import read_table


# --- model chain -------------------------------------------------------------------

def bronze_c(spark, sf):
    return M.bronze_clientes(raw_clientes(spark, sf))


def bronze_p(spark, sf):
    return M.bronze_pedidos(raw_pedidos(spark, sf))


def stg_c(spark, sf):
    return M.stg_clientes(bronze_c(spark, sf), AS_OF)


def stg_p(spark, sf):
    return M.stg_pedidos(bronze_p(spark, sf), AS_OF)


def dim_c(spark, sf):
    return M.dim_clientes(stg_c(spark, sf), AS_OF)


def fct(spark, sf):
    return M.fct_pedidos(stg_p(spark, sf), dim_c(spark, sf))


def mart(spark, sf):
    return M.mart_ventas_por_ciudad(fct(spark, sf))


register("bronze_customers", with_models("bronze_clientes") + "select * from bronze_clientes")(bronze_c)
register("bronze_orders", with_models("bronze_pedidos") + "select * from bronze_pedidos")(bronze_p)
register("stg_customers", with_models("stg_clientes") + "select * from stg_clientes")(stg_c)
register("stg_orders", with_models("stg_pedidos") + "select * from stg_pedidos")(stg_p)
register("dim_customers", with_models("dim_clientes") + "select * from dim_clientes")(dim_c)
register("fact_orders", with_models("fct_pedidos") + "select * from fct_pedidos")(fct)
register("sales_mart", with_models("mart") + "select * from mart order by ingresos_totales desc")(
    lambda spark, sf: M.sorted_mart(mart(spark, sf)))


@register("flatten_attributes", with_models("bronze_pedidos") + """
select p.pedido_id, p.cliente_id, f.key as atributo_nombre, f.value ->> '$' as atributo_valor
from bronze_pedidos p, json_each(p.atributos_extra) f""")
def q_flatten(spark, sf):
    return M.flatten_attributes(bronze_p(spark, sf))


@register("orphan_orders", with_models("stg_pedidos", "stg_clientes") + """
select pedido_id, cliente_id, producto, fecha_pedido from stg_pedidos p
where cliente_id is not null
  and not exists (select 1 from stg_clientes c where c.cliente_id = p.cliente_id)""")
def q_orphans(spark, sf):
    return (orphans(stg_p(spark, sf), stg_c(spark, sf), "cliente_id")
            .select("pedido_id", "cliente_id", "producto", "fecha_pedido"))


@register("json_extract", with_models("bronze_pedidos") + """
select pedido_id, _batch_id,
       json_extract_string(atributos_extra, '$.color') as color,
       try_cast(json_extract_string(atributos_extra, '$.garantia_meses') as int) as garantia_meses,
       json_extract_string(atributos_extra, '$.canal_venta') as canal_venta,
       try_cast(json_extract_string(atributos_extra, '$.descuento_pct') as int) as descuento_pct,
       json_extract_string(atributos_extra, '$.promocion') as promocion,
       json_extract_string(atributos_extra, '$.sku_proveedor') as sku_proveedor
from bronze_pedidos""")
def q_json_extract(spark, sf):
    b = bronze_p(spark, sf).withColumn("_v", parse_json_safe("atributos_extra"))
    return b.select("pedido_id", "_batch_id",
                    json_field("_v", "color").alias("color"),
                    json_field("_v", "garantia_meses", "int").alias("garantia_meses"),
                    json_field("_v", "canal_venta").alias("canal_venta"),
                    json_field("_v", "descuento_pct", "int").alias("descuento_pct"),
                    json_field("_v", "promocion").alias("promocion"),
                    json_field("_v", "sku_proveedor").alias("sku_proveedor"))


# --- scalar functions ------------------------------------------------------------------

@register("scalar_strings", with_models("raw_clientes") + """
select id, trim(nombre) as nombre, lower(trim(email)) as email_norm, trim(ciudad) as ciudad,
       nombre <> trim(nombre) as nombre_padded
from raw_clientes""")
def q_scalar_strings(spark, sf):
    r = raw_clientes(spark, sf)
    return r.select("id", clean_text("nombre").alias("nombre"), norm_key("email").alias("email_norm"),
                    clean_text("ciudad").alias("ciudad"),
                    (F.col("nombre") != clean_text("nombre")).alias("nombre_padded"))


@register("safe_casts", with_models("raw_pedidos") + """
select id, _batch_id,
       try_cast(cantidad as int) as cantidad,
       try_cast(precio_unitario as decimal(10,2)) as precio_unitario,
       try_cast(fecha_pedido as date) as fecha_pedido,
       (cantidad is not null and try_cast(cantidad as int) is null) as cantidad_rechazada,
       (fecha_pedido is not null and try_cast(fecha_pedido as date) is null) as fecha_rechazada
from raw_pedidos""")
def q_safe_casts(spark, sf):
    r = raw_pedidos(spark, sf)
    return r.select("id", "_batch_id",
                    safe_int("cantidad").alias("cantidad"),
                    safe_decimal("precio_unitario").alias("precio_unitario"),
                    safe_date("fecha_pedido").alias("fecha_pedido"),
                    (F.col("cantidad").isNotNull() & safe_int("cantidad").isNull()).alias("cantidad_rechazada"),
                    (F.col("fecha_pedido").isNotNull() & safe_date("fecha_pedido").isNull()).alias("fecha_rechazada"))


# --- dedup / window operators --------------------------------------------------------------

@register("latest_per_key", with_models("bronze_pedidos") + f"""
select * exclude (rn) from (
  select *, row_number() over (partition by pedido_id order by {BRONZE_PEDIDOS_NEWEST}) as rn
  from bronze_pedidos) x where rn = 1""")
def q_latest_per_key(spark, sf):
    return dedup.latest_per_key(bronze_p(spark, sf), "pedido_id", M.BRONZE_PEDIDOS_ORDER)


@register("latest_per_expr_key", with_models("bronze_clientes") + f"""
select lower(trim(email)) as email_key, cliente_id, _batch_id, _inserted_at from (
  select *, row_number() over (partition by lower(trim(email))
                               order by {CLIENTES_NEWEST}) as rn
  from bronze_clientes where email is not null) x where rn = 1""")
def q_latest_per_expr_key(spark, sf):
    b = bronze_c(spark, sf).filter(F.col("email").isNotNull())
    out = dedup.latest_per_expr_key(b, norm_key("email"), M.CLIENTES_ORDER)
    return out.select(norm_key("email").alias("email_key"), "cliente_id", "_batch_id", "_inserted_at")


@register("rank_top1", """
select o_custkey, o_orderkey, o_orderpriority, o_totalprice from (
  select *, rank() over (partition by o_custkey order by o_orderpriority) as rk from orders) x
where rk = 1""")
def q_rank_top1(spark, sf):
    o = read_table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_totalprice")
    return dedup.rank_top1(o, "o_custkey", ["o_orderpriority"])


@register("distinct_rows", with_models("raw_pedidos") + """
select distinct cliente_id, producto, cantidad, precio_unitario, fecha_pedido, estado, atributos_extra
from raw_pedidos""")
def q_distinct_rows(spark, sf):
    return dedup.distinct_rows(raw_pedidos(spark, sf).select(
        "cliente_id", "producto", "cantidad", "precio_unitario", "fecha_pedido", "estado", "atributos_extra"))


@register("distinct_keys", with_models("raw_pedidos") + "select distinct cliente_id from raw_pedidos")
def q_distinct_keys(spark, sf):
    return dedup.distinct_keys(raw_pedidos(spark, sf), "cliente_id")
