"""Scans of declared tables (A1, A2) and raw-layer schemas.

A declared source is resolved by environment to a base path; a scan always
goes through ``spark.read.parquet`` so Catalyst can prune columns and push
filters into the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tierflow.session import empty_frame

RAW_CLIENTES_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("nombre", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("ciudad", T.StringType()),
    T.StructField("fecha_registro", T.StringType()),
    T.StructField("_batch_id", T.IntegerType()),
    T.StructField("_inserted_at", T.TimestampNTZType()),
])

RAW_PEDIDOS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("cliente_id", T.LongType()),
    T.StructField("producto", T.StringType()),
    T.StructField("cantidad", T.StringType()),
    T.StructField("precio_unitario", T.StringType()),
    T.StructField("fecha_pedido", T.StringType()),
    T.StructField("estado", T.StringType()),
    T.StructField("_batch_id", T.IntegerType()),
    T.StructField("atributos_extra", T.StringType()),
    T.StructField("_inserted_at", T.TimestampNTZType()),
])

PEDIDOS_CSV_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("cliente_id", T.LongType()),
    T.StructField("producto", T.StringType()),
    T.StructField("cantidad", T.StringType()),
    T.StructField("precio_unitario", T.StringType()),
    T.StructField("fecha_pedido", T.StringType()),
    T.StructField("estado", T.StringType()),
])

RAW_SCHEMAS = {"clientes": RAW_CLIENTES_SCHEMA, "pedidos": RAW_PEDIDOS_SCHEMA}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def layer_path(base: str, env: str, layer: str, table: str) -> str:
    """Location of ``table`` in ``layer`` for an environment.

    Mirrors the per-layer namespace: a custom layer name is used as given
    (trimmed), otherwise the environment's default namespace.
    """
    layer = (layer or "").strip() or "default"
    return f"{base.rstrip('/')}/{env}/{layer}/{table}"


def scan_raw(spark: SparkSession, base: str, env: str, table: str) -> DataFrame:
    """A1: scan a declared raw table with its fixed schema (no inference)."""
    return spark.read.schema(RAW_SCHEMAS[table]).parquet(layer_path(base, env, "raw", table))


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Create an empty typed table at ``path`` if none exists; return it.

    ``mode("ignore")`` is the DataFrame form of ``CREATE TABLE IF NOT EXISTS``:
    an existing table is left untouched.
    """
    empty_frame(spark, schema).write.mode("ignore").parquet(path)
    return spark.read.schema(schema).parquet(path)
