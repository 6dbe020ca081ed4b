"""The job: checks gate the snapshot (error stops it, warn does not)."""

import pytest
from pyspark.sql import functions as F

from tierflow.operators.checks import Check, CheckFailed
from tierflow.plans.data_tests import model_checks
from tests.conftest import rows
from tierflow.plans.pipeline import run_batch, run_pipeline
from tierflow.session import work_dir
from tierflow.sources.fixtures import raw_clientes, raw_pedidos
from tierflow.sources.storage import KeyedTable, Table
from tierflow.sources.tables import layer_path

AS_OF = "2025-01-01"


def test_pipeline_builds_checks_and_snapshots(spark, sf):
    base = work_dir(spark, "wh")
    run = run_pipeline(spark, sf, base, "dev", AS_OF)
    status = {r["check_name"]: r["status"] for r in run.report}
    assert len(status) == 13 and status["relationships_stg_pedidos_cliente_id"] == "warn"
    assert all(v == "pass" for k, v in status.items() if k != "relationships_stg_pedidos_cliente_id")
    assert run.snapshot.history().where("valid_to is null").count() >= run.read("stg_clientes").count()
    assert run.tables["raw_pedidos"].batches() == run.tables["bronze_pedidos"].batches() == [1, 2, 3, 4]
    assert run.read("raw_pedidos").count() == raw_pedidos(spark, sf).count()
    assert run.read("mart_ventas_por_ciudad").count() > 0
    assert run.flatten_view().count() > 0
    # the last batch again: nothing changes
    before = {n: rows(run.read(n)) for n in ("raw_pedidos", "bronze_pedidos", "pedidos_incremental", "mart_ventas_por_ciudad")}
    history = rows(run.snapshot.history())
    again = run_batch(spark, raw_clientes(spark, sf).where("_batch_id = 4"), raw_pedidos(spark, sf).where("_batch_id = 4"), base, "dev", AS_OF)
    assert {n: rows(again.read(n)) for n in before} == before and rows(again.snapshot.history()) == history


def test_error_check_stops_before_snapshot(spark, sf):
    base = work_dir(spark, "wh")
    failing = model_checks(AS_OF) + [Check("too_few_rows", "mart_ventas_por_ciudad", "row_count",
                                           args={"max_rows": 1})]
    with pytest.raises(CheckFailed, match="too_few_rows"):
        run_pipeline(spark, sf, base, "dev", AS_OF, checks=failing)
    assert Table(spark, layer_path(base, "dev", "gold", "mart_ventas_por_ciudad")).exists()
    assert not KeyedTable(spark, layer_path(base, "dev", "snapshots", "clientes_snapshot") + "/open", "cliente_id").exists()


@pytest.mark.parametrize("mixed", [True, False])
def test_rows_without_a_batch_are_not_lost(spark, sf, mixed):
    base = work_dir(spark, "wh")
    people, orders = (f(spark, sf).where("_batch_id = 2") for f in (raw_clientes, raw_pedidos))
    some = F.col("id") % 2 == 0 if mixed else F.lit(True)
    people, orders = (df.withColumn("_batch_id", F.when(~some, F.col("_batch_id"))) for df in (people, orders))
    run = run_batch(spark, people, orders, base, "dev", AS_OF)
    assert run.read("raw_pedidos").count() == run.read("bronze_pedidos").count() == orders.count() > 0
    assert run.read("bronze_clientes").count() == people.count()
