"""Model semantics that the oracle fixtures only touch indirectly."""

import datetime as dt

from tests.conftest import rows
from tierflow.plans import models as M

T = [dt.datetime(2024, 1, d) for d in range(1, 5)]


def test_flatten_null_empty_and_json_null(spark):
    bronze = spark.createDataFrame([
        (1, 10, '{"color":"rojo","promocion":null}'), (2, 10, "{}"), (3, 10, None), (4, 10, "oops"),
    ], "pedido_id long, cliente_id long, atributos_extra string")
    out = M.flatten_attributes(bronze)
    assert rows(out, "pedido_id", "atributo_nombre", "atributo_valor") == [
        (1, "color", "rojo"), (1, "promocion", None)]


def test_customer_dedup_runs_before_the_date_filter(spark):
    # the newest row of an email has a bad date: the email disappears entirely
    bronze = spark.createDataFrame([
        (1, "Ana", "a@x.com", "Lima", dt.date(2022, 1, 1), 1, T[0]),
        (2, "Ana", " A@x.com ", "Lima", None, 2, T[1]),
        (3, "Bea", "b@x.com", "Quito", dt.date(2023, 5, 1), 1, T[0]),
        (4, "Cid", "sinarroba", "Quito", dt.date(2023, 5, 1), 1, T[0]),
    ], "cliente_id long, nombre string, email string, ciudad string, fecha_registro date, "
       "_batch_id int, _inserted_at timestamp_ntz")
    assert rows(M.stg_clientes(bronze, "2025-01-01"), "cliente_id", "email") == [(3, "b@x.com")]


def test_order_flags_and_dedup_before_null_date_filter(spark):
    bronze = spark.createDataFrame([
        (1, 5, "p", 2, "10.00", dt.date(2024, 1, 1), "F", 1, "{}", T[0]),
        (1, 5, "p", 0, "10.00", None, "F", 2, "{}", T[1]),            # newest copy has no date: order dropped
        (2, 5, " q ", -1, None, dt.date(2026, 1, 1), "O", 1, '{"color":"azul"}', T[0]),
    ], "pedido_id long, cliente_id long, producto string, cantidad int, precio_unitario string, "
       "fecha_pedido date, estado string, _batch_id int, atributos_extra string, _inserted_at timestamp_ntz")
    bronze = bronze.withColumn("precio_unitario", bronze["precio_unitario"].cast("decimal(10,2)"))
    out = M.stg_pedidos(bronze, "2025-01-01")
    assert rows(out, "pedido_id", "producto", "color", "flag_cantidad_invalida", "flag_precio_invalido",
                "flag_fecha_futura") == [(2, "q", "azul", True, True, True)]
