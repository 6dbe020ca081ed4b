"""Registered queries for raw loads, keys, layout and the whole job."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from tierflow.functions.scalar import json_field
from tierflow.operators.ingest import append_batch, insert_parsed, next_batch_for, variant_keys
from tierflow.operators.keys import assign_surrogate_keys, next_batch_id
from tierflow.operators.layout import pruning_report, write_clustered, write_range_clustered
from tierflow.plans import core_queries as Q
from tierflow.plans import models as M
from tierflow.plans.oracle import AS_OF, with_models
from tierflow.plans.incremental import batches_of
from tierflow.plans.pipeline import run_pipeline
from tierflow.plans.registry import register
from tierflow.session import work_dir
from tierflow.sources.fixtures import raw_clientes, raw_pedidos
from tierflow.sources.tables import RAW_CLIENTES_SCHEMA, ensure_table, layer_path, scan_raw
from tierflow.sources.storage import BatchTable


@register("scan_raw_orders", with_models("raw_pedidos") + "select * from raw_pedidos")
def q_scan_raw(spark, sf):
    """Land the raw orders under the dev environment, then scan them by name."""
    base = work_dir(spark, "warehouse")
    raw_pedidos(spark, sf).write.parquet(layer_path(base, "dev", "raw", "pedidos"))
    return scan_raw(spark, base, "dev", "pedidos")


@register("next_batch_id", with_models("raw_pedidos") + """
select cast(coalesce(max(_batch_id), 0) + 1 as integer) as next_batch_id from raw_pedidos""")
def q_next_batch_id(spark, sf):
    return next_batch_id(raw_pedidos(spark, sf))


_RAW_C_COLS = ["id", "nombre", "email", "ciudad", "fecha_registro"]


@register("raw_append_batch", with_models("raw_clientes") + "select * from raw_clientes")
def q_raw_append(spark, sf):
    """A5: one load per batch of the data, each stamped with the next batch id and its load time."""
    t = BatchTable(spark, work_dir(spark, "raw_clientes"))
    src = raw_clientes(spark, sf)
    for b in batches_of(src):
        rows = src.filter(F.col("_batch_id").eqNullSafe(F.lit(b))).select(*_RAW_C_COLS)
        append_batch(t, rows, _dt.datetime(2024, 1, 1) + _dt.timedelta(days=next_batch_for(t)))
    return t.read().select(*RAW_CLIENTES_SCHEMA.fieldNames())


@register("ensure_table", with_models("raw_clientes") + "select * from raw_clientes")
def q_ensure_table(spark, sf):
    """Create-if-absent twice around a load; the second call keeps the rows."""
    path = work_dir(spark, "raw_clientes_ddl")
    ensure_table(spark, path, RAW_CLIENTES_SCHEMA)
    raw_clientes(spark, sf).write.mode("append").parquet(path)
    return ensure_table(spark, path, RAW_CLIENTES_SCHEMA)


_PED_NAMES = ["id", "cliente_id", "producto", "cantidad", "precio_unitario", "fecha_pedido", "estado",
              "_batch_id", "atributos_extra"]


@register("parse_json_ingest", with_models("raw_pedidos") + """
select id, _batch_id, array_to_string(list_sort(json_keys(atributos_extra)), ',') as attr_keys,
       json_extract_string(atributos_extra, '$.color') as color,
       try_cast(json_extract_string(atributos_extra, '$.garantia_meses') as int) as garantia_meses
from raw_pedidos""")
def q_parse_json_ingest(spark, sf):
    """Positional values with JSON text, parsed to VARIANT on insert, read back."""
    values = raw_pedidos(spark, sf).select(*_PED_NAMES)
    values = values.toDF(*[f"c{i + 1}" for i in range(len(_PED_NAMES))])  # $1 .. $9
    t = BatchTable(spark, work_dir(spark, "raw_pedidos_json"))
    insert_parsed(t, values, _PED_NAMES, ["atributos_extra"])
    return t.read().select("id", "_batch_id", variant_keys("atributos_extra").alias("attr_keys"),
                           json_field("atributos_extra", "color").alias("color"),
                           json_field("atributos_extra", "garantia_meses", "int").alias("garantia_meses"))


@register("assign_surrogate_keys", with_models("raw_pedidos") + """
select id, _batch_id, 299999 + row_number() over (order by id, _batch_id) as pedido_sk from raw_pedidos""")
def q_surrogate(spark, sf):
    """Gap-free ids from 300000 in (id, batch) order, numbered without a single-task window."""
    rows = raw_pedidos(spark, sf).select("id", "_batch_id")
    return assign_surrogate_keys(rows, ["id", "_batch_id"], start=300000, name="pedido_sk")


_CLUSTER_VALUE = "NATION_2"


def _clustered_fact(spark, sf) -> str:
    return write_clustered(Q.fct(spark, sf), work_dir(spark, "fct_pedidos_clustered"), "ciudad",
                           sort_by=["pedido_id"])


@register("clustered_layout_scan", with_models("fct_pedidos") + f"""
select * from fct_pedidos where ciudad = '{_CLUSTER_VALUE}'""")
def q_clustered_scan(spark, sf):
    """The fact table clustered by city; a city filter reads one directory."""
    path = _clustered_fact(spark, sf)
    return spark.read.parquet(path).filter(F.col("ciudad") == _CLUSTER_VALUE)


_RANGE_FROM, _RANGE_TO = "1997-03-01", "1997-03-31"


@register("clustered_range_scan", with_models("fct_pedidos") + f"""
select * from fct_pedidos where fecha_pedido between date '{_RANGE_FROM}' and date '{_RANGE_TO}'""")
def q_clustered_range(spark, sf):
    """A13, range form: the fact table range-clustered by order date; a month filter skips files by stats."""
    path = write_range_clustered(Q.fct(spark, sf), work_dir(spark, "fct_pedidos_by_date"),
                                 "fecha_pedido", "pedido_id")
    lo, hi = F.lit(_RANGE_FROM).cast("date"), F.lit(_RANGE_TO).cast("date")
    return spark.read.parquet(path).filter(F.col("fecha_pedido").between(lo, hi))


@register("pruning_report", with_models("fct_pedidos") + f"""
select 'total' as scope, count(distinct ciudad) as partitions, count(*) as "rows" from fct_pedidos
union all
select 'scanned', count(distinct ciudad), count(*) from fct_pedidos where ciudad = '{_CLUSTER_VALUE}'""")
def q_pruning(spark, sf):
    """Partitions and rows behind the pruned scan vs the whole clustered table."""
    return pruning_report(spark, _clustered_fact(spark, sf), F.col("ciudad") == _CLUSTER_VALUE)


@register("pipeline_end_to_end", with_models("mart") + "select * from mart order by ingresos_totales desc")
def q_pipeline(spark, sf):
    """The whole job (ingest, build, test, snapshot); returns the built sales mart."""
    run = run_pipeline(spark, sf, work_dir(spark, "warehouse"), "dev", AS_OF)
    return M.sorted_mart(run.read("mart_ventas_por_ciudad"))
