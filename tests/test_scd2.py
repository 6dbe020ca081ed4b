"""SCD2 history: interval invariants, fold = one-shot rebuild, reruns change nothing, as-of join."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from tests.conftest import plan_text, rows
from tierflow.operators.joins import asof_join
from tierflow.operators.merge import DuplicateKeyError
from tierflow.operators.scd2 import Scd2Table, as_versions, history_from_changes, version_changes
from tierflow.plans.history_queries import fold
from tierflow.session import work_dir

D = [dt.datetime(2024, m, 1) for m in range(1, 6)]
SCHEMA = "cliente_id long, ciudad string, _inserted_at timestamp_ntz"
CHANGES = [(1, "A", D[0]), (1, "B", D[1]), (1, "C", D[3]), (2, "X", D[0]), (3, "Y", D[2])]
COLS = ["cliente_id", "ciudad", "valid_from", "valid_to", "version_hash"]


def _table(spark, **how):
    return Scd2Table(spark, work_dir(spark, "hist"), "cliente_id", **how)


def test_fold_equals_rebuild_and_intervals_are_disjoint(spark):
    ch = spark.createDataFrame(CHANGES, SCHEMA)
    h = fold(_table(spark), ch).history()
    assert rows(h, *COLS) == rows(history_from_changes(ch, "cliente_id", "_inserted_at"), *COLS)
    # one open row per key
    assert rows(h.filter(F.col("valid_to").isNull()).groupBy("cliente_id").count(), "count") == [(1,), (1,), (1,)]
    # each version ends where the next one starts
    w = Window.partitionBy("cliente_id").orderBy("valid_from")
    gaps = h.withColumn("nxt", F.lead("valid_from").over(w)).filter(
        ~F.col("valid_to").eqNullSafe(F.col("nxt")))
    assert gaps.count() == 0


def test_rerun_same_snapshot_changes_nothing(spark):
    ch = spark.createDataFrame(CHANGES, SCHEMA)
    t = fold(_table(spark), ch)
    before = rows(t.history())
    t.apply(spark.createDataFrame([(1, "C", D[3]), (2, "X", D[0]), (3, "Y", D[2])], SCHEMA))
    assert rows(t.history()) == before
    t.apply(spark.createDataFrame([(2, "Z", D[4])], SCHEMA))
    assert rows(t.history().filter("valid_to is null and cliente_id = 2"), "ciudad") == [("Z",)]


def test_a_run_that_failed_between_its_two_writes_is_repeated(spark, monkeypatch):
    import tierflow.operators.scd2 as scd2
    t = _table(spark)
    t.apply(spark.createDataFrame([(1, "A", D[0]), (2, "X", D[0])], SCHEMA))
    snap = spark.createDataFrame([(1, "B", D[1]), (2, "Y", D[1])], SCHEMA)

    def stop(*a, **k):
        raise RuntimeError("lost")

    monkeypatch.setattr(scd2, "merge_upsert", stop)
    with pytest.raises(RuntimeError):
        t.apply(snap)
    monkeypatch.undo()
    t.apply(snap)
    assert rows(t.history(), "cliente_id", "ciudad", "valid_to") == [(1, "A", D[1]), (1, "B", None), (2, "X", D[1]), (2, "Y", None)]


def test_duplicate_keys_raise_and_null_keys_have_no_history(spark):
    t = _table(spark)
    with pytest.raises(DuplicateKeyError):
        t.apply(spark.createDataFrame([(1, "A", D[0]), (1, "B", D[0])], SCHEMA))
    for d in D[:2]:
        t.apply(spark.createDataFrame([(1, "A", D[0]), (None, "N", d)], SCHEMA))
    assert rows(t.history(), "cliente_id") == [(1,)]
    with pytest.raises(DuplicateKeyError):
        t.apply(spark.createDataFrame([(1, "B", D[1]), (1, "C", D[1])], SCHEMA))


def test_run_is_a_left_join_from_the_snapshot(spark):
    new = as_versions(spark.createDataFrame(CHANGES[:1], SCHEMA), "cliente_id", "_inserted_at")
    plan = plan_text(version_changes(new, new, "cliente_id"))
    assert "FullOuter" not in plan and "LeftOuter" in plan


def test_asof_join_uses_an_equi_join(spark):
    ch = spark.createDataFrame(CHANGES, SCHEMA)
    hist = history_from_changes(ch, "cliente_id", "_inserted_at")
    probes = spark.createDataFrame([(1, dt.datetime(2024, 2, 15)), (1, dt.datetime(2023, 1, 1)), (3, D[4])],
                                   "cliente_id long, t timestamp_ntz")
    out = asof_join(probes, hist.select("cliente_id", "ciudad", "valid_from", "valid_to"), "cliente_id", "t")
    assert set(rows(out, "cliente_id", "ciudad")) == {(1, None), (1, "B"), (3, "Y")}
    plan = plan_text(out)
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_a_run_writes_only_the_buckets_of_changed_keys(spark):
    t = _table(spark, buckets=4)

    def files():
        return set(spark.read.parquet(t.open.current()).inputFiles())

    t.apply(spark.range(40).select(F.col("id").alias("cliente_id"), F.lit("A").alias("ciudad"), F.lit(D[0]).alias("_inserted_at")))
    before = files()
    t.apply(spark.range(40).select(F.col("id").alias("cliente_id"),
                                   F.when(F.col("id") == 5, "B").otherwise("A").alias("ciudad"),
                                   F.when(F.col("id") == 5, F.lit(D[1])).otherwise(F.lit(D[0])).alias("_inserted_at")))
    assert len({f.split("_bucket=")[1][0] for f in before ^ files()}) == 1
    h = t.history()
    assert h.count() == 41 and h.filter("valid_to is null").count() == 40


def test_check_strategy_ignores_reloads_of_unchanged_values(spark):
    ch = spark.createDataFrame([(1, "A", D[0]), (1, "A", D[1]), (1, "B", D[2]), (2, None, D[0]), (2, None, D[1])],
                               SCHEMA)
    by_ts, by_check = fold(_table(spark), ch), fold(_table(spark, check_cols=["ciudad"]), ch)
    assert by_ts.history().count() == 5
    assert set(rows(by_check.history(), "cliente_id", "ciudad", "valid_from", "valid_to")) == {
        (1, "A", D[0], D[2]), (1, "B", D[2], None), (2, None, D[0], None)}
