"""Independent DuckDB SQL for every registered query (the correctness oracle).

These are hand-written SQL over the overlay views, not generated from the
Spark plans.  Types are pinned on both sides (bigint counts, decimal(31,2)
sums, double averages) so values hash identically.  ``AS_OF`` is the pinned
"today" both engines use.
"""

from __future__ import annotations

from tierflow.sources.fixtures import oracle_ctes

AS_OF = "2025-01-01"

# Total orders of "newest row wins" (the same column lists as the models').
CLIENTES_NEWEST = """_inserted_at desc nulls last, _batch_id desc nulls last, cliente_id desc nulls last,
  nombre nulls first, email nulls first, ciudad nulls first, fecha_registro nulls first"""
PEDIDOS_NEWEST = """_inserted_at desc nulls last, _batch_id desc nulls last, cliente_id nulls first, producto nulls first,
  cantidad nulls first, precio_unitario nulls first, fecha_pedido nulls first, estado nulls first"""
BRONZE_PEDIDOS_NEWEST = PEDIDOS_NEWEST + ", atributos_extra nulls first"

# Model CTEs (DuckDB dialect), in dependency order.
_MODELS = {
    "bronze_clientes": """
select id as cliente_id, nombre, email, ciudad, try_cast(fecha_registro as date) as fecha_registro,
       _batch_id, _inserted_at
from raw_clientes""",
    "bronze_pedidos": """
select id as pedido_id, cliente_id, producto, try_cast(cantidad as int) as cantidad,
       try_cast(precio_unitario as decimal(10,2)) as precio_unitario,
       try_cast(fecha_pedido as date) as fecha_pedido, estado, _batch_id, atributos_extra, _inserted_at
from raw_pedidos""",
    "stg_clientes": f"""
select cliente_id, trim(nombre) as nombre, lower(trim(email)) as email, trim(ciudad) as ciudad,
       fecha_registro, _batch_id, _inserted_at
from (select *, row_number() over (partition by lower(trim(email))
                                   order by {CLIENTES_NEWEST}) as rn
      from (select distinct * from bronze_clientes) d
      where email is not null and email like '%@%') x
where rn = 1 and fecha_registro between date '2020-01-01' and date '{AS_OF}'""",
    "stg_pedidos": f"""
select pedido_id, cliente_id, trim(producto) as producto, cantidad, precio_unitario, fecha_pedido, estado,
       _batch_id, _inserted_at,
       json_extract_string(atributos_extra, '$.color') as color,
       try_cast(json_extract_string(atributos_extra, '$.garantia_meses') as int) as garantia_meses,
       json_extract_string(atributos_extra, '$.canal_venta') as canal_venta,
       try_cast(json_extract_string(atributos_extra, '$.descuento_pct') as int) as descuento_pct,
       json_extract_string(atributos_extra, '$.promocion') as promocion,
       atributos_extra as atributos_extra_raw,
       (cantidad is null or cantidad <= 0) as flag_cantidad_invalida,
       (precio_unitario is null or precio_unitario <= 0) as flag_precio_invalido,
       coalesce(fecha_pedido > date '{AS_OF}', false) as flag_fecha_futura
from (select *, row_number() over (partition by pedido_id
                                   order by {BRONZE_PEDIDOS_NEWEST}) as rn
      from bronze_pedidos) d
where rn = 1 and fecha_pedido is not null""",
    "dim_clientes": f"""
select cliente_id, nombre, email, ciudad, fecha_registro,
       cast(date_diff('day', fecha_registro, date '{AS_OF}') as bigint) as dias_como_cliente
from stg_clientes""",
    "fct_pedidos": """
select p.pedido_id, p.cliente_id, c.ciudad, p.producto, p.cantidad, p.precio_unitario,
       cast(p.cantidad * p.precio_unitario as decimal(21,2)) as monto_total,
       p.fecha_pedido, p.estado, p.color, p.canal_venta
from stg_pedidos p join dim_clientes c on p.cliente_id = c.cliente_id
where not p.flag_cantidad_invalida and not p.flag_precio_invalido and not p.flag_fecha_futura""",
    "mart": """
select ciudad, producto, count(*) as total_pedidos,
       cast(sum(cantidad) as bigint) as unidades_vendidas,
       cast(sum(monto_total) as decimal(31,2)) as ingresos_totales,
       cast(sum(monto_total) as double) / count(*) as ticket_promedio
from fct_pedidos group by ciudad, producto""",
}

_DEPS = {
    "bronze_clientes": ["raw_clientes"],
    "bronze_pedidos": ["raw_pedidos"],
    "stg_clientes": ["bronze_clientes"],
    "stg_pedidos": ["bronze_pedidos"],
    "dim_clientes": ["stg_clientes"],
    "fct_pedidos": ["stg_pedidos", "dim_clientes"],
    "mart": ["fct_pedidos"],
}
_RAW = {"raw_clientes", "raw_pedidos", "raw_clientes_history"}


def with_models(*names: str, extra: dict[str, str] | None = None) -> str:
    """A ``with`` clause defining the named views and everything they need."""
    extra = dict(extra or {})
    deps = dict(_DEPS)
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in deps.get(n, []):
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    raws = [n for n in order if n in _RAW]
    models = [n for n in order if n not in _RAW]
    head = oracle_ctes(*raws) if raws else "with "
    parts = []
    for n in models:
        body = extra.get(n) or _MODELS[n]
        parts.append(f"{n} as ({body.strip()})")
    if raws and parts:
        head = head.rstrip("\n") + ",\n"
    return head + ",\n".join(parts) + "\n"
