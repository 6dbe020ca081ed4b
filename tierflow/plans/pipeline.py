"""The daily job (I10): ingest -> build -> test -> snapshot, as one Spark job function.

A run takes one new batch.  Raw and bronze are append-only: the run adds the
batch's partition and casts that partition alone.  The incremental table merges
what is above its mark, and the snapshot folds today's customers into their
history.  Silver, dimension, fact and mart are rebuilt from all of bronze, as
their definition asks (the newest row per key may be in any batch); silver is
written once because it has many readers in one run.  A run that failed, or is
repeated, replaces its own partitions and changes nothing else.

Row checks and row counts are counted as the models are written; unique and
relationships read the built tables.  An ``error`` failure stops the job before the
snapshot, a ``warn`` failure does not.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.operators.checks import CheckFailed, WriteChecks, duplicate_keys, enforce, run_checks
from tierflow.operators.merge import incremental_run
from tierflow.operators.scd2 import Scd2Table
from tierflow.plans import models as M
from tierflow.plans.data_tests import model_checks
from tierflow.plans.incremental import batches_of, in_batches, incremental_source
from tierflow.sources.fixtures import raw_clientes, raw_pedidos
from tierflow.sources.storage import BatchTable, KeyedTable, Table
from tierflow.sources.tables import layer_path

SNAPSHOT_COLUMNS = ("cliente_id", "nombre", "email", "ciudad", "fecha_registro", "_inserted_at")


@dataclass
class PipelineRun:
    tables: dict[str, Table | BatchTable]
    report: list
    snapshot: Scd2Table

    def read(self, name: str) -> DataFrame:
        return self.tables[name].read()

    def flatten_view(self) -> DataFrame:
        """I4 as a view over the built bronze orders (recomputed on read)."""
        return M.flatten_attributes(self.read("bronze_pedidos"))


def run_batch(spark: SparkSession, clientes: DataFrame, pedidos: DataFrame, base: str, env: str = "dev",
              as_of_date=None, checks=None) -> PipelineRun:
    """Run the job on one batch of raw rows, stamped with its ``_batch_id`` and load time.

    ``checks`` defaults to the models' 13 data tests.
    """
    def path(layer: str, name: str) -> str:
        return layer_path(base, env, layer, name)

    tables: dict[str, Table | BatchTable] = {}
    checks = model_checks(as_of_date) if checks is None else checks
    written = WriteChecks(checks)

    def append(layer: str, name: str, df: DataFrame) -> DataFrame:
        t = tables[name] = BatchTable(spark, path(layer, name))
        t.write(df)
        return t.read(df.schema)

    def build(layer: str, name: str, df: DataFrame) -> DataFrame:
        t = tables[name] = Table(spark, path(layer, name))
        t.overwrite(written.on(name, df))
        return t.read()

    # 1. ingest: the batch joins the raw layer
    batches = {}
    for name, df in (("clientes", clientes), ("pedidos", pedidos)):
        ids = batches_of(df)
        batches[name] = append("raw", f"raw_{name}", df).where(in_batches(ids))

    # 2. build: bronze of the new batch; silver, incremental table and gold
    bronze_c = append("bronze", "bronze_clientes", M.bronze_clientes(batches["clientes"]))
    bronze_p = append("bronze", "bronze_pedidos", M.bronze_pedidos(batches["pedidos"]))
    stg_c = build("silver", "stg_clientes", M.stg_clientes(bronze_c, as_of_date))
    stg_p = build("silver", "stg_pedidos", M.stg_pedidos(bronze_p, as_of_date))
    tables["pedidos_incremental"] = KeyedTable(spark, path("silver", "pedidos_incremental"), "pedido_id")
    incremental_run(tables["pedidos_incremental"], incremental_source(bronze_p), "_inserted_at", M.PEDIDOS_ORDER)
    dim = build("gold", "dim_clientes", M.dim_clientes(stg_c, as_of_date))
    # Email dedup does not make the customer id unique: gate the join on it, or
    # duplicate dimension rows would multiply orders in the fact table.
    if not duplicate_keys(dim, "cliente_id").isEmpty():
        raise CheckFailed("dim_clientes.cliente_id is not unique; fact join not built")
    fct = build("gold", "fct_pedidos", M.fct_pedidos(stg_p, dim))
    mart = build("gold", "mart_ventas_por_ciudad", M.mart_ventas_por_ciudad(fct))

    # 3. test: 13 checks, one small result row each; an error stops the job here.
    models = {"stg_clientes": stg_c, "stg_pedidos": stg_p, "dim_clientes": dim,
              "fct_pedidos": fct, "mart_ventas_por_ciudad": mart}
    report = run_checks(models, checks, written).collect()
    enforce(report)

    # 4. snapshot: fold today's customers into their version history.
    snap = Scd2Table(spark, path("snapshots", "clientes_snapshot"), "cliente_id", "_inserted_at")
    snap.apply(stg_c.select(*SNAPSHOT_COLUMNS))
    return PipelineRun(tables, report, snap)


def run_pipeline(spark: SparkSession, sf_dir: str, base: str, env: str = "dev", as_of_date=None, checks=None) -> PipelineRun:
    """The job once per batch found in the data, in order; returns the last run."""
    clientes, pedidos = raw_clientes(spark, sf_dir), raw_pedidos(spark, sf_dir)
    run = None
    for b in batches_of(clientes.select("_batch_id").unionByName(pedidos.select("_batch_id"))):
        mine = F.col("_batch_id").eqNullSafe(F.lit(b))
        run = run_batch(spark, clientes.where(mine), pedidos.where(mine), base, env, as_of_date, checks)
    return run
