"""Models by name and as views.

``MODELS`` names each model and the models it is built from; ``create_views``
registers the wanted ones as temporary views, sources first, so that a query
reads any of them by name.  A view is lazy: reading it plans the models below it
into one query.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tierflow.plans import models as M
from tierflow.plans.oracle import AS_OF, with_models
from tierflow.plans.registry import register
from tierflow.sources.fixtures import raw_clientes, raw_pedidos


@dataclass(frozen=True)
class Model:
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    dated: bool = False  # takes the pinned "today"


MODELS = {
    "bronze_clientes": Model(M.bronze_clientes, ("raw_clientes",)),
    "bronze_pedidos": Model(M.bronze_pedidos, ("raw_pedidos",)),
    "stg_clientes": Model(M.stg_clientes, ("bronze_clientes",), dated=True),
    "stg_pedidos": Model(M.stg_pedidos, ("bronze_pedidos",), dated=True),
    "stg_pedidos_atributos": Model(M.flatten_attributes, ("bronze_pedidos",)),
    "dim_clientes": Model(M.dim_clientes, ("stg_clientes",), dated=True),
    "fct_pedidos": Model(M.fct_pedidos, ("stg_pedidos", "dim_clientes")),
    "mart_ventas_por_ciudad": Model(M.mart_ventas_por_ciudad, ("fct_pedidos",)),
}


def model(spark: SparkSession, name: str) -> DataFrame:
    """A2: a model or source by its name, as the session's view of it."""
    return spark.table(name)


def create_views(spark: SparkSession, sources: dict[str, DataFrame], names: list[str], as_of_date=None) -> None:
    """Temporary views of the named models, of all models below them and of the sources."""
    done: set[str] = set()

    def create(name: str) -> None:
        if name in done:
            return
        done.add(name)
        if name in sources:
            sources[name].createOrReplaceTempView(name)
            return
        m = MODELS[name]
        for i in m.inputs:
            create(i)
        inputs = [model(spark, i) for i in m.inputs]
        (m.build(*inputs, as_of_date) if m.dated else m.build(*inputs)).createOrReplaceTempView(name)

    for name in names:
        create(name)


@register("silver_by_name", with_models("stg_pedidos", "stg_clientes") + """
select p.pedido_id, p.cliente_id, c.ciudad, p.producto, p.color
from stg_pedidos p left join stg_clientes c on p.cliente_id = c.cliente_id""")
def q_silver_by_name(spark, sf):
    """Silver read by name, through views, in plain SQL."""
    create_views(spark, {"raw_clientes": raw_clientes(spark, sf), "raw_pedidos": raw_pedidos(spark, sf)},
                 ["stg_pedidos", "stg_clientes"], AS_OF)
    return spark.sql("""select p.pedido_id, p.cliente_id, c.ciudad, p.producto, p.color
                        from stg_pedidos p left join stg_clientes c on p.cliente_id = c.cliente_id""")
