"""The layered models' 13 data tests (6 silver, 7 gold) as ``Check`` values."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierflow.functions.scalar import EMAIL_REGEX, as_of
from tierflow.operators.checks import Check


def model_checks(as_of_date=None) -> list[Check]:
    return [
        Check("not_null_stg_clientes_cliente_id", "stg_clientes", "not_null", "cliente_id"),
        Check("not_null_stg_clientes_email", "stg_clientes", "not_null", "email"),
        Check("regex_stg_clientes_email", "stg_clientes", "regex", "email",
              args={"pattern": EMAIL_REGEX}),
        Check("between_stg_clientes_fecha_registro", "stg_clientes", "between", "fecha_registro",
              args={"low": F.lit("2020-01-01").cast("date"), "high": as_of(as_of_date)}),
        Check("not_null_stg_pedidos_pedido_id", "stg_pedidos", "not_null", "pedido_id"),
        Check("relationships_stg_pedidos_cliente_id", "stg_pedidos", "relationships", "cliente_id",
              severity="warn", args={"to": "stg_clientes", "field": "cliente_id"}),
        Check("unique_dim_clientes_cliente_id", "dim_clientes", "unique", "cliente_id"),
        Check("not_null_dim_clientes_cliente_id", "dim_clientes", "not_null", "cliente_id"),
        Check("unique_fct_pedidos_pedido_id", "fct_pedidos", "unique", "pedido_id"),
        Check("not_null_fct_pedidos_pedido_id", "fct_pedidos", "not_null", "pedido_id"),
        Check("min_fct_pedidos_monto_total", "fct_pedidos", "min", "monto_total",
              args={"min_value": 0, "inclusive": True}),
        Check("row_count_mart_ventas_por_ciudad", "mart_ventas_por_ciudad", "row_count",
              args={"min_rows": 1}),
        Check("min_mart_ventas_por_ciudad_ingresos_totales", "mart_ventas_por_ciudad", "min",
              "ingresos_totales", args={"min_value": 0, "inclusive": True}),
    ]
