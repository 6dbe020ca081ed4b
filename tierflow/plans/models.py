"""The layered models (I1-I8) as compositions of operators.

Each model is a function of upstream DataFrames, so a caller decides whether
an upstream is a lazy view (inlined by Catalyst) or a materialised table.
``as_of_date`` pins "today" (default ``current_date()``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.functions.scalar import (as_of, clean_text, days_between, json_field, norm_key,
                                       parse_json_safe, safe_date, safe_decimal, safe_int)
from tierflow.operators.dedup import latest_per_expr_key, latest_per_key
from tierflow.operators.joins import join_dimension

# "Newest row wins": load time (NULL last), then batch.  One load stamps all its rows
# alike, so each model breaks ties by all its other columns: the order is total.
NEWEST_FIRST = ("-_inserted_at", "-_batch_id")
CLIENTES_ORDER = (*NEWEST_FIRST, "-cliente_id", "nombre", "email", "ciudad", "fecha_registro")
PEDIDOS_ORDER = (*NEWEST_FIRST, "cliente_id", "producto", "cantidad", "precio_unitario", "fecha_pedido", "estado")
BRONZE_PEDIDOS_ORDER = (*PEDIDOS_ORDER, "atributos_extra")


# --- bronze: rename + safe casts (I1, B1, B2) ---------------------------------

def bronze_clientes(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("cliente_id"),
        "nombre", "email", "ciudad",
        safe_date("fecha_registro").alias("fecha_registro"),
        "_batch_id", "_inserted_at",
    )


def bronze_pedidos(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("pedido_id"),
        "cliente_id", "producto",
        safe_int("cantidad").alias("cantidad"),
        safe_decimal("precio_unitario").alias("precio_unitario"),
        safe_date("fecha_pedido").alias("fecha_pedido"),
        "estado", "_batch_id", "atributos_extra", "_inserted_at",
    )


# --- silver (I2, I3, I4) ---------------------------------------------------------

def stg_clientes(bronze: DataFrame, as_of_date=None) -> DataFrame:
    """Valid email -> newest per normalised email -> date in range.

    The order is total, so equal rows need no distinct first: one of them is
    kept either way.  The date filter runs *after* the per-email dedup: an
    email whose newest row has a bad date disappears entirely.
    """
    valid = bronze.filter(F.col("email").isNotNull() & F.col("email").like("%@%"))
    newest = latest_per_expr_key(valid, norm_key("email"), CLIENTES_ORDER)
    return (newest
            .filter(F.col("fecha_registro").between(F.lit("2020-01-01").cast("date"), as_of(as_of_date)))
            .select("cliente_id",
                    clean_text("nombre").alias("nombre"),
                    norm_key("email").alias("email"),
                    clean_text("ciudad").alias("ciudad"),
                    "fecha_registro", "_batch_id", "_inserted_at"))


def _invalid_amount(c: str):
    return F.col(c).isNull() | (F.col(c) <= 0)


def stg_pedidos(bronze: DataFrame, as_of_date=None) -> DataFrame:
    """Newest row per order id, JSON attributes promoted, quality flags, dated rows only."""
    newest = latest_per_key(bronze, "pedido_id", BRONZE_PEDIDOS_ORDER)
    attrs = parse_json_safe("atributos_extra")
    today = as_of(as_of_date)
    return (newest
            .filter(F.col("fecha_pedido").isNotNull())
            .withColumn("_attrs", attrs)
            .select("pedido_id", "cliente_id",
                    clean_text("producto").alias("producto"),
                    "cantidad", "precio_unitario", "fecha_pedido", "estado",
                    "_batch_id", "_inserted_at",
                    json_field("_attrs", "color").alias("color"),
                    json_field("_attrs", "garantia_meses", "int").alias("garantia_meses"),
                    json_field("_attrs", "canal_venta").alias("canal_venta"),
                    json_field("_attrs", "descuento_pct", "int").alias("descuento_pct"),
                    json_field("_attrs", "promocion").alias("promocion"),
                    F.col("atributos_extra").alias("atributos_extra_raw"),
                    _invalid_amount("cantidad").alias("flag_cantidad_invalida"),
                    _invalid_amount("precio_unitario").alias("flag_precio_invalido"),
                    F.coalesce(F.col("fecha_pedido") > today, F.lit(False)).alias("flag_fecha_futura")))


def flatten_attributes(bronze: DataFrame) -> DataFrame:
    """I4 / D3: one row per JSON attribute of every bronze order (not deduplicated).

    ``variant_explode`` (inner lateral) yields no row for NULL or ``{}`` and one
    row, value NULL, for a JSON-null attribute.  The value is emitted as text.
    """
    parsed = bronze.select("pedido_id", "cliente_id",
                           parse_json_safe("atributos_extra").alias("_attrs"))
    exploded = parsed.lateralJoin(
        parsed.sparkSession.tvf.variant_explode(F.col("_attrs").outer()))
    return exploded.select(
        "pedido_id", "cliente_id",
        F.col("key").alias("atributo_nombre"),
        F.try_variant_get(F.col("value"), "$", "string").alias("atributo_valor"))


# --- gold (I6, I7, I8) -------------------------------------------------------------

def dim_clientes(stg: DataFrame, as_of_date=None) -> DataFrame:
    return stg.select("cliente_id", "nombre", "email", "ciudad", "fecha_registro",
                      days_between("fecha_registro", as_of(as_of_date)).alias("dias_como_cliente"))


def fct_pedidos(stg_orders: DataFrame, dim: DataFrame) -> DataFrame:
    """Clean orders x customer dimension; amount = quantity x unit price."""
    clean = stg_orders.filter(~F.col("flag_cantidad_invalida")
                              & ~F.col("flag_precio_invalido")
                              & ~F.col("flag_fecha_futura"))
    joined = join_dimension(clean, dim.select("cliente_id", "ciudad"), "cliente_id")
    return joined.select(
        "pedido_id", "cliente_id", "ciudad", "producto", "cantidad", "precio_unitario",
        (F.col("cantidad") * F.col("precio_unitario")).cast("decimal(21,2)").alias("monto_total"),
        "fecha_pedido", "estado", "color", "canal_venta")


def mart_ventas_por_ciudad(fct: DataFrame) -> DataFrame:
    """Sales per (city, product).  Partial aggregation runs map-side.

    The average is ``double(sum) / count`` (exact sum, one rounding), which
    is what the oracle computes as well.
    """
    return (fct.groupBy("ciudad", "producto")
               .agg(F.count(F.lit(1)).alias("total_pedidos"),
                    F.sum("cantidad").cast("bigint").alias("unidades_vendidas"),
                    F.sum("monto_total").cast("decimal(31,2)").alias("ingresos_totales"),
                    (F.sum("monto_total").cast("double") / F.count(F.lit(1))).alias("ticket_promedio")))


def sorted_mart(mart: DataFrame) -> DataFrame:
    """the mart's presentation order (applied on read, not stored)."""
    return mart.orderBy(F.col("ingresos_totales").desc())
