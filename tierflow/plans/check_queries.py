"""Registered queries for the data tests (H1-H8) and quality profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierflow.functions.scalar import EMAIL_REGEX, as_of
from tierflow.operators import checks as C
from tierflow.plans import core_queries as Q
from tierflow.plans import models as M
from tierflow.plans.data_tests import model_checks
from tierflow.plans.oracle import AS_OF, with_models
from tierflow.plans.registry import register
from tierflow.session import stage
from tierflow.sources.fixtures import raw_clientes, raw_pedidos


@register("dq_not_null", with_models("bronze_pedidos") + """
select pedido_id, 'cantidad' as column_name from bronze_pedidos where cantidad is null
union all select pedido_id, 'precio_unitario' from bronze_pedidos where precio_unitario is null
union all select pedido_id, 'fecha_pedido' from bronze_pedidos where fecha_pedido is null""")
def q_not_null(spark, sf):
    b = Q.bronze_p(spark, sf)
    parts = [C.not_null(b, c).select("pedido_id", F.lit(c).alias("column_name"))
             for c in ("cantidad", "precio_unitario", "fecha_pedido")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("dq_unique", with_models("bronze_pedidos") + """
select pedido_id, count(*) as n_rows from bronze_pedidos group by pedido_id having count(*) > 1""")
def q_unique(spark, sf):
    return C.duplicate_keys(Q.bronze_p(spark, sf), "pedido_id")


@register("dq_accepted_range", with_models("bronze_pedidos") + """
select pedido_id, cast(cantidad * precio_unitario as decimal(21,2)) as monto_total
from bronze_pedidos where not (cantidad * precio_unitario >= 0)""")
def q_accepted_range(spark, sf):
    b = Q.bronze_p(spark, sf).select(
        "pedido_id", (F.col("cantidad") * F.col("precio_unitario")).cast("decimal(21,2)").alias("monto_total"))
    return C.below_min(b, "monto_total", 0, inclusive=True)


@register("dq_regex", with_models("bronze_clientes") + f"""
select cliente_id, email from bronze_clientes
where not regexp_full_match(email, '{EMAIL_REGEX}')""")
def q_regex(spark, sf):
    return C.not_matching(Q.bronze_c(spark, sf), "email", EMAIL_REGEX).select("cliente_id", "email")


@register("dq_between", with_models("bronze_clientes") + f"""
select cliente_id, fecha_registro from bronze_clientes
where not (fecha_registro between date '2020-01-01' and date '{AS_OF}')""")
def q_between(spark, sf):
    b = Q.bronze_c(spark, sf)
    return C.not_between(b, "fecha_registro", F.lit("2020-01-01").cast("date"), as_of(AS_OF)) \
        .select("cliente_id", "fecha_registro")


@register("dq_row_count", with_models("mart", "stg_clientes") + """
select 'mart_ventas_por_ciudad' as model, count(*) as row_count, count(*) >= 1 as passed from mart
union all
select 'stg_clientes', count(*), count(*) between 1 and 1000 from stg_clientes""")
def q_row_count(spark, sf):
    a = C.row_count_between(Q.mart(spark, sf), 1).select(F.lit("mart_ventas_por_ciudad").alias("model"), "*")
    b = C.row_count_between(Q.stg_c(spark, sf), 1, 1000).select(F.lit("stg_clientes").alias("model"), "*")
    return a.unionByName(b)


def _report_models(spark, sf, written: C.WriteChecks):
    """The checked models, each written once to the shared work folder.

    Every set check is its own aggregate over a model; left lazy, each would
    recompute the silver windows.  ``written`` counts the row checks as the models are written.
    """
    def keep(name, df):
        return stage(written.on(name, df), name)

    stg_c = keep("stg_clientes", Q.stg_c(spark, sf))
    stg_p = keep("stg_pedidos", Q.stg_p(spark, sf))
    dim = keep("dim_clientes", M.dim_clientes(stg_c, AS_OF))
    fct = keep("fct_pedidos", M.fct_pedidos(stg_p, dim))
    return {"stg_clientes": stg_c, "stg_pedidos": stg_p, "dim_clientes": dim, "fct_pedidos": fct,
            "mart_ventas_por_ciudad": keep("mart_ventas_por_ciudad", M.mart_ventas_por_ciudad(fct))}


_REPORT_SQL = with_models("stg_clientes", "stg_pedidos", "dim_clientes", "fct_pedidos", "mart") + f"""
, raw_report as (
select 'not_null_stg_clientes_cliente_id' as check_name, 'stg_clientes' as model, 'error' as severity,
       count(*) filter (where cliente_id is null) as failures from stg_clientes
union all select 'not_null_stg_clientes_email', 'stg_clientes', 'error',
       count(*) filter (where email is null) from stg_clientes
union all select 'regex_stg_clientes_email', 'stg_clientes', 'error',
       count(*) filter (where not regexp_full_match(email, '{EMAIL_REGEX}')) from stg_clientes
union all select 'between_stg_clientes_fecha_registro', 'stg_clientes', 'error',
       count(*) filter (where not (fecha_registro between date '2020-01-01' and date '{AS_OF}')) from stg_clientes
union all select 'not_null_stg_pedidos_pedido_id', 'stg_pedidos', 'error',
       count(*) filter (where pedido_id is null) from stg_pedidos
union all select 'relationships_stg_pedidos_cliente_id', 'stg_pedidos', 'warn', count(*) from stg_pedidos p
       where cliente_id is not null and not exists (select 1 from stg_clientes c where c.cliente_id = p.cliente_id)
union all select 'unique_dim_clientes_cliente_id', 'dim_clientes', 'error', count(*) from
       (select cliente_id from dim_clientes group by cliente_id having count(*) > 1)
union all select 'not_null_dim_clientes_cliente_id', 'dim_clientes', 'error',
       count(*) filter (where cliente_id is null) from dim_clientes
union all select 'unique_fct_pedidos_pedido_id', 'fct_pedidos', 'error', count(*) from
       (select pedido_id from fct_pedidos group by pedido_id having count(*) > 1)
union all select 'not_null_fct_pedidos_pedido_id', 'fct_pedidos', 'error',
       count(*) filter (where pedido_id is null) from fct_pedidos
union all select 'min_fct_pedidos_monto_total', 'fct_pedidos', 'error',
       count(*) filter (where not (monto_total >= 0)) from fct_pedidos
union all select 'row_count_mart_ventas_por_ciudad', 'mart_ventas_por_ciudad', 'error',
       case when count(*) >= 1 then 0 else 1 end from mart
union all select 'min_mart_ventas_por_ciudad_ingresos_totales', 'mart_ventas_por_ciudad', 'error',
       count(*) filter (where not (ingresos_totales >= 0)) from mart)
select check_name, model, severity, cast(failures as bigint) as failures,
       case when failures = 0 then 'pass' when severity = 'warn' then 'warn' else 'fail' end as status
from raw_report"""


@register("dq_report", _REPORT_SQL)
def q_report(spark, sf):
    """Row checks and row counts come from the writes; unique and relationships read the written models."""
    checks = model_checks(AS_OF)
    written = C.WriteChecks(checks)
    return C.run_checks(_report_models(spark, sf, written), checks, written)


@register("batch_quality_profile", with_models("raw_pedidos", "raw_clientes") + f"""
, profile as (
select _batch_id, count(*) as total_rows,
  count(*) filter (where precio_unitario is null) as null_price,
  count(*) filter (where cantidad is not null and try_cast(cantidad as int) is null) as corrupt_quantity,
  count(*) filter (where try_cast(cantidad as int) <= 0) as non_positive_quantity,
  count(*) filter (where try_cast(precio_unitario as decimal(10,2)) <= 0) as non_positive_price,
  count(*) filter (where fecha_pedido is not null and try_cast(fecha_pedido as date) is null) as bad_date_format,
  count(*) filter (where try_cast(fecha_pedido as date) > date '{AS_OF}') as future_date,
  count(*) filter (where producto <> trim(producto)) as untrimmed_product
from raw_pedidos group by _batch_id)
, copies as (
select _batch_id, sum(n - 1) as copies_new_id from (
  select _batch_id, count(*) as n from raw_pedidos
  group by cliente_id, producto, cantidad, precio_unitario, fecha_pedido, estado, _batch_id, atributos_extra,
           _inserted_at) g
where n > 1 group by _batch_id)
, orphans as (
select _batch_id, count(*) as orphan_customer from raw_pedidos p
where cliente_id is not null and not exists (select 1 from raw_clientes c where c.id = p.cliente_id)
group by _batch_id)
select p.*, cast(coalesce(c.copies_new_id, 0) as bigint) as copies_new_id,
       cast(coalesce(o.orphan_customer, 0) as bigint) as orphan_customer
from profile p left join copies c using (_batch_id) left join orphans o using (_batch_id)""")
def q_profile(spark, sf):
    return C.batch_quality_profile(raw_pedidos(spark, sf), AS_OF, customers=raw_clientes(spark, sf))
