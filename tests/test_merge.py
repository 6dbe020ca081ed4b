"""Stored tables, keyed merge, high-water mark, repair, time travel, diff."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_text, rows
from tierflow.operators.diff import deleted_rows, state_as_of, table_diff
from tierflow.operators.dedup import latest_per_key
from tierflow.operators.merge import (DuplicateKeyError, above_mark, high_water_mark, incremental_run,
                                      merge_rows, merge_upsert, replace_with_dedup)
from tierflow.plans import models as M
from tierflow.session import stage, work_dir
from tierflow.sources.storage import BUCKET, BatchTable, KeyedTable, LayoutMismatch, Table

SCHEMA = "id long, v string, ts timestamp_ntz"
D = [dt.datetime(2024, 1, d) for d in range(1, 6)]


def _t(spark, buckets=4):
    return KeyedTable(spark, work_dir(spark, "t"), "id", buckets)


def _files(t):
    return set(t.spark.read.parquet(t.current()).inputFiles())


def test_merge_updates_inserts_and_is_idempotent(spark):
    t = _t(spark)
    merge_upsert(t, spark.createDataFrame([(1, "a", D[0]), (2, "b", D[0])], SCHEMA))
    batch = spark.createDataFrame([(2, "B", D[1]), (3, "c", D[1])], SCHEMA)
    merge_upsert(t, batch)
    first = rows(t.read(), "id", "v")
    merge_upsert(t, batch)  # replay
    assert first == rows(t.read(), "id", "v") == [(1, "a"), (2, "B"), (3, "c")]


def test_merge_rejects_duplicate_batch_keys(spark):
    t = _t(spark)
    merge_upsert(t, spark.createDataFrame([(1, "a", D[0])], SCHEMA))
    before = _files(t)
    with pytest.raises(DuplicateKeyError):
        merge_upsert(t, spark.createDataFrame([(5, "x", D[1]), (5, "y", D[1])], SCHEMA))
    assert _files(t) == before  # nothing written


def test_merge_rewrites_only_touched_buckets(spark):
    t = _t(spark, buckets=8)
    merge_upsert(t, spark.range(200).select(F.col("id"), F.lit("a").alias("v"), F.lit(D[0]).alias("ts")))
    before = _files(t)
    merge_upsert(t, spark.createDataFrame([(7, "z", D[1])], SCHEMA))
    gone, new = before - _files(t), _files(t) - before
    assert len({f.split(f"{BUCKET}=")[1].split("/")[0] for f in gone | new}) == 1
    assert t.read().count() == 200 and t.read().filter("id = 7").first()["v"] == "z"


def test_a_reopened_table_keeps_its_layout(spark):
    t = _t(spark, buckets=16)
    merge_upsert(t, spark.range(200).select(F.col("id"), F.lit("a").alias("v"), F.lit(D[0]).alias("ts")))
    with pytest.raises(LayoutMismatch):
        KeyedTable(spark, t.root, "id", 4)
    with pytest.raises(LayoutMismatch):
        KeyedTable(spark, t.root, "v")
    again = KeyedTable(spark, t.root, "id")
    assert again.buckets == 16
    merge_upsert(again, spark.range(50).select(F.col("id"), F.lit("b").alias("v"), F.lit(D[1]).alias("ts")))
    assert again.read().count() == again.read().select("id").distinct().count() == 200


def test_stored_row_takes_part_in_the_order(spark):
    changes = [(1, "old", D[0]), (1, "new", D[2]), (2, "x", D[1]), (2, "w", D[0])]
    one, many = _t(spark), _t(spark)
    merge_upsert(one, latest_per_key(spark.createDataFrame(changes, SCHEMA), "id", ["-ts"]), ["-ts"])
    for c in reversed(changes):  # the newest first, then older ones late
        merge_upsert(many, spark.createDataFrame([c], SCHEMA), ["-ts"])
    assert rows(one.read()) == rows(many.read()) == sorted([changes[1], changes[2]], key=repr)


def test_null_key_is_one_key(spark):
    a = spark.createDataFrame([(None, "a", D[0]), (1, "b", D[0])], SCHEMA)
    assert rows(merge_rows(a, spark.createDataFrame([(None, "c", D[1])], SCHEMA), "id"), "id", "v") == [(1, "b"), (None, "c")]


def test_ties_inside_one_load_are_decided_by_the_values(spark):
    load = [(7, 1, p, 1, None, None, "F", 1, None, D[0]) for p in ("x", "y", "w")]
    cols = "pedido_id long, cliente_id long, producto string, cantidad int, precio_unitario decimal(10,2), fecha_pedido date, estado string, _batch_id int, atributos_extra string, _inserted_at timestamp_ntz"
    for order in (load, load[::-1], load[1:] + load[:1]):
        df = spark.createDataFrame(order, cols)
        assert rows(latest_per_key(df, "pedido_id", M.BRONZE_PEDIDOS_ORDER), "producto") == [("w",)]


def test_high_water_mark_is_strict_and_lookback_rereads(spark):
    t = _t(spark)
    src = spark.createDataFrame([(1, "a", D[1]), (2, "b", D[2])], SCHEMA)
    incremental_run(t, src, "ts", ["-ts"])
    late = spark.createDataFrame([(1, "a", D[1]), (2, "b", D[2]), (3, "late", D[0]), (4, "new", D[3])], SCHEMA)
    incremental_run(t, late, "ts", ["-ts"])
    assert rows(t.read(), "id") == [(1,), (2,), (4,)]          # strict: late row lost
    incremental_run(t, late, "ts", ["-ts"], lookback=dt.timedelta(days=5))
    assert rows(t.read(), "id") == [(1,), (2,), (3,), (4,)]    # lookback re-reads and merges it
    assert high_water_mark(t.read(), "ts") == D[3]


def test_mark_is_pushed_to_the_scan(spark, tmp_path):
    p = str(tmp_path / "src")
    spark.createDataFrame([(1, "a", D[1])], SCHEMA).write.parquet(p)
    plan = plan_text(above_mark(spark.read.parquet(p), "ts", D[0]))
    assert "PushedFilters" in plan and "GreaterThan(ts" in plan


def test_refreshes_keep_the_one_before(spark):
    t = Table(spark, work_dir(spark, "t"))
    assert not t.exists()
    t.overwrite(spark.createDataFrame([(1, "a", D[0]), (1, "b", D[1]), (2, "c", D[0])], SCHEMA))
    old = t.read()
    replace_with_dedup(t, "id", ["-ts"])
    assert rows(t.read(), "id", "v") == [(1, "b"), (2, "c")] and old.count() == 3
    t.overwrite(t.read().where("id = 2"))
    assert rows(t.read(), "id") == [(2,)] and len(t._refreshes()) == 2


def test_a_failed_refresh_leaves_the_table(spark):
    t = Table(spark, work_dir(spark, "t"))
    t.overwrite(spark.range(3))
    bad = spark.range(5).select(F.when(F.col("id") < 9, F.raise_error(F.lit("stop"))).cast("long").alias("id"))
    with pytest.raises(Exception, match="stop"):
        t.overwrite(bad)
    assert t.read().count() == 3
    t.overwrite(spark.range(4))
    assert t.read().count() == 4


def test_a_repeated_batch_replaces_itself(spark):
    t = BatchTable(spark, work_dir(spark, "t"))
    for b, n in ((1, 3), (2, 5), (2, 4), (10, 1)):
        t.write(spark.range(n).withColumn("_batch_id", F.lit(b)))
    assert t.batches() == [1, 2, 10] and t.read().count() == 8


def test_hot_key_is_collapsed_before_the_shuffle(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("id"),
                                  F.col("id").cast("string").alias("v"), F.lit(D[0]).alias("ts"))
    t = Table(spark, work_dir(spark, "t"))
    t.overwrite(df)
    plan = plan_text(latest_per_key(t.read(), "id", ["-v"]))
    assert plan.index("Exchange") > plan.index("WindowGroupLimit") and plan.count("WindowGroupLimit") >= 2
    replace_with_dedup(t, "id", ["-v"])
    assert t.read().count() == t.read().select("id").distinct().count()


def test_recover_deleted_and_diff(spark):
    t = _t(spark)
    merge_upsert(t, spark.createDataFrame([(1, "a", D[0]), (2, None, D[0]), (3, "c", D[0])], SCHEMA))
    first = stage(t.read())
    t.overwrite(spark.createDataFrame([(1, "a", D[0]), (2, None, D[0]), (4, "d", D[1])], SCHEMA))
    assert rows(deleted_rows(first, t.read(), "id"), "id") == [(3,)]
    t.overwrite(spark.createDataFrame([(1, "A", D[0]), (2, None, D[0]), (4, "d", D[1])], SCHEMA))
    d = table_diff(first, t.read(), "id")
    assert rows(d, "id", "_change_type") == [(1, "update"), (3, "delete"), (4, "insert")]  # NULL = NULL: no change
    assert "FullOuter" not in plan_text(d)


def test_diff_sees_a_value_move_between_columns(spark):
    a = spark.createDataFrame([(1, "x", None), (2, None, None)], "id long, p string, q string")
    b = spark.createDataFrame([(1, None, "x"), (2, None, None)], "id long, p string, q string")
    assert rows(table_diff(a, b, "id"), "id", "p_before", "q_after") == [(1, "x", "x")]


def test_state_as_of(spark):
    h = spark.createDataFrame([(1, "a", D[0]), (1, "b", D[2]), (2, "c", D[3])], SCHEMA)
    assert rows(state_as_of(h, "id", "ts", D[1], ["-ts"]), "id", "v") == [(1, "a")]


def test_time_literals_do_not_depend_on_the_session_zone(spark):
    src = spark.createDataFrame([(1, "a", D[1]), (2, "b", D[2])], SCHEMA)
    out = {}
    for zone in ("UTC", "America/Lima", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            out[zone] = (rows(above_mark(src, "ts", D[1]), "id"), rows(state_as_of(src, "id", "ts", D[1], ["-ts"]), "id"))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert out["UTC"] == out["America/Lima"] == out["Asia/Tokyo"] == ([(2,)], [(1,)])
