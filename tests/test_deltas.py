"""Change rows out of the merge, the mart by deltas, layouts that grow, scans over ranges."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_text, rows
from tierflow.operators import merge as merging
from tierflow.operators.diff import table_diff
from tierflow.operators.joins import asof_join
from tierflow.operators.merge import ChangeLog, image, merge_upsert
from tierflow.operators.ranges import ordered_ranges
from tierflow.operators.scd2 import VALID_FROM, history_from_changes
from tierflow.plans import models as M
from tierflow.plans.incremental import in_batches
from tierflow.plans.incremental_mart import IncrementalMart
from tierflow.session import stage, work_dir
from tierflow.sources import storage
from tierflow.sources.storage import KeyedTable

DAY = dt.datetime(2024, 1, 1)


def batch(spark, *values):
    return spark.createDataFrame([(k, v, DAY + dt.timedelta(days=d)) for k, v, d in values], "k long, v string, at timestamp_ntz")


def test_change_rows_equal_the_diff_of_states(spark):
    base = work_dir(spark, "changes")
    table, log = KeyedTable(spark, f"{base}/t", "k"), ChangeLog(spark, f"{base}/log")
    steps = [batch(spark, (1, "a", 0), (2, None, 0), (None, "n", 0)), batch(spark, (1, "b", 1), (3, "c", 1), (2, None, 1)),
             batch(spark, (1, "late", 0), (3, "c", 1), (None, None, 2))]
    states = [None]
    for run, b in enumerate(steps):
        merge_upsert(table, b, ["-at"], log=log, run=run)
        states.append(stage(table.read(), "state"))
    got = log.read()
    assert {(r["_run"], r["k"], r["_change_type"]) for r in got.collect()} == {
        (0, 1, "insert"), (0, 2, "insert"), (0, None, "insert"), (1, 1, "update"), (1, 2, "update"), (1, 3, "insert"), (2, None, "update")}
    for run in (1, 2):  # table_diff takes keys that are not NULL
        diff = table_diff(*[s.where("k IS NOT NULL") for s in states[run : run + 2]], "k")
        assert rows(log.of(run).where("k IS NOT NULL"), *diff.columns) == rows(diff)
    assert rows(image(log.of(1), ["k"], ["k", "v", "at"], "after")) == rows(steps[1])


def test_a_repeated_run_merges_what_it_recorded(spark):
    base = work_dir(spark, "changes")
    table, log = KeyedTable(spark, f"{base}/t", "k"), ChangeLog(spark, f"{base}/log")
    merge_upsert(table, batch(spark, (1, "a", 0), (2, "b", 0)), ["-at"], log=log, run=0)
    change = batch(spark, (1, "c", 1), (9, "d", 1))
    kept = KeyedTable.replace_buckets
    try:  # the process dies after the log was written, before the table was
        KeyedTable.replace_buckets = lambda self, df, staged=False: (_ for _ in ()).throw(OSError("lost"))
        with pytest.raises(OSError):
            merge_upsert(table, change, ["-at"], log=log, run=1)
    finally:
        KeyedTable.replace_buckets = kept
    seen = rows(log.of(1))
    for _ in range(2):
        merge_upsert(table, change, ["-at"], log=log, run=1)
        assert rows(log.of(1)) == seen and len(seen) == 2
        assert rows(table.read(), "k", "v") == [(1, "c"), (2, "b"), (9, "d")]


def test_a_merge_with_a_log_reads_touched_buckets_only(spark):
    base = work_dir(spark, "changes")
    table = KeyedTable(spark, f"{base}/t", "k", 16)
    table.overwrite(batch(spark, *[(k, "x", 0) for k in range(200)]))
    plan = plan_text(merging.changed_rows(merging.merge_with_before(table.read([3]), batch(spark, (1, "y", 1)), "k", ["-at"]), "k"))
    assert "PartitionFilters" in plan and "_bucket" in plan and "3" in plan.split("PartitionFilters")[1][:120]


def test_layout_grows_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(storage, "BUCKET_ROWS", 10)
    monkeypatch.setattr(storage, "LEAST_BUCKETS", 2)
    table = KeyedTable(spark, work_dir(spark, "grown"), "k")
    merge_upsert(table, batch(spark, *[(k, "a", 0) for k in range(10)]))
    assert table.buckets == 2
    merge_upsert(table, batch(spark, *[(k, "b", 1) for k in range(5, 300)]))
    assert table.buckets == 30 and KeyedTable(spark, table.root, "k").buckets == 30
    assert rows(table.read(), "k", "v") == sorted([*[(k, "a") for k in range(5)], *[(k, "b") for k in range(5, 300)]], key=repr)
    table.overwrite(table.read().where("k < 15"))
    assert table.buckets == 2 and table.read().count() == 15
    with pytest.raises(storage.LayoutMismatch):
        KeyedTable(spark, table.root, "k", 7)


# --- the mart ----------------------------------------------------------------------

def customers(spark, *values):
    return spark.createDataFrame([(i, f"n{i}", mail, city, dt.date.fromisoformat(day), b, DAY + dt.timedelta(days=b)) for i, mail, city, day, b in values],
                                 "cliente_id long, nombre string, email string, ciudad string, fecha_registro date, _batch_id int, _inserted_at timestamp_ntz")


def orders(spark, *values):
    return spark.createDataFrame([(o, c, p, q, 2.5, dt.date.fromisoformat(day), "P", b, "{}", DAY + dt.timedelta(days=b)) for o, c, p, q, day, b in values],
                                 "pedido_id long, cliente_id long, producto string, cantidad int, precio_unitario double, fecha_pedido date, estado string, "
                                 "_batch_id int, atributos_extra string, _inserted_at timestamp_ntz").withColumn("precio_unitario", F.col("precio_unitario").cast("decimal(10,2)"))


def rebuilt(people, sold, today):
    dim = M.dim_clientes(M.stg_clientes(people, today), today)
    return M.mart_ventas_por_ciudad(M.fct_pedidos(M.stg_pedidos(sold, today), dim))


def test_mart_equals_the_rebuilt_one_after_every_batch(spark):
    steps = [
        (customers(spark, (1, "a@x", "Lima", "2023-01-01", 1), (2, "b@x", "Cusco", "2023-01-01", 1), (3, "no mail", "Puno", "2023-01-01", 1)),
         orders(spark, (10, 1, "pen", 2, "2024-01-01", 1), (11, 2, "pen", 1, "2024-01-01", 1), (12, 3, "pen", 1, "2024-01-01", 1),
                (13, 1, "ink", 0, "2024-01-01", 1), (14, 2, " ink ", 4, "2024-06-05", 1)), "2024-06-01"),
        # a customer moves, a new one takes another's email, an order is corrected, one loses its customer
        (customers(spark, (1, "A@x ", "Arequipa", "2023-01-01", 2), (4, "b@x", "Tacna", "2023-01-01", 2), (5, "e@x", None, "2024-06-03", 2)),
         orders(spark, (11, 4, "pen", 1, "2024-01-01", 2), (13, 1, "ink", 3, "2024-01-01", 2), (15, 5, "pen", 9, "2024-01-01", 2)), "2024-06-02"),
        # nothing arrives, but days pass: order 14 has no customer by now, customer 5 comes of age
        (customers(spark, (6, "f@x", "Lima", "2023-01-01", 3)).where("false"), orders(spark, (16, 1, "x", 1, "2024-01-01", 3)).where("false"), "2024-06-10"),
        (customers(spark, (2, "h@x", "Cusco", "2023-01-01", 4)), orders(spark, (10, 1, "pen", -1, "2024-01-01", 4)), "2024-06-10"),
    ]
    mart = IncrementalMart(spark, work_dir(spark, "mart"))
    people = sold = before = None
    for run, (c, o, today) in enumerate(steps):
        people, sold = (c, o) if people is None else (people.unionByName(c), sold.unionByName(o))
        for _ in range(2 if run in (1, 3) else 1):  # a repeated run changes nothing
            mart.run(run, c, o, today, before)
            assert rows(mart.read()) == rows(rebuilt(people, sold, today))
        before = today
    assert rows(mart.read(0)) == rows(rebuilt(steps[0][0], steps[0][1], steps[0][2]))


# --- scans over ranges ---------------------------------------------------------------

@pytest.fixture
def many_ranges(spark):
    """Small data stays in one range unless Spark is told to leave its partitions as they are."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    kept = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, kept)


def test_asof_scan_equals_the_interval_join(spark, many_ranges):
    rng = random.Random(4)
    moves = [(k, DAY + dt.timedelta(hours=h)) for k in (1, 1, 1, 2, 3, None) for h in rng.sample(range(3000), 30)] + [
        (7, DAY + dt.timedelta(hours=h)) for h in range(1500)]  # a key with most of the rows
    hist = history_from_changes(spark.createDataFrame(sorted(set(moves), key=repr), "k long, at timestamp_ntz").withColumn("city", F.hash("k", "at")), "k", "at")
    probes = [(i, rng.choice([1, 2, 3, 4, 7, 7, 7, None]), rng.choice([None, DAY + dt.timedelta(minutes=rng.randint(-500, 200_000))])) for i in range(2000)]
    probe = spark.createDataFrame(probes, "id long, k long, t timestamp_ntz")
    got = asof_join(probe, hist, "k", "t")
    h = hist.withColumnRenamed("k", "hk")
    want = probe.join(h, (F.col("k") == F.col("hk")) & (F.col("t") >= F.col("valid_from"))
                      & (F.col("valid_to").isNull() | (F.col("t") < F.col("valid_to"))), "left").drop("hk")
    assert got.columns == want.columns and rows(got) == rows(want)
    assert rows(asof_join(probe, hist, "k", "t", how="inner")) == rows(want.where("valid_from IS NOT NULL"))
    assert asof_join(probe.where("false"), hist, "k", "t").count() == 0
    assert rows(asof_join(probe, hist.where("false"), "k", "t"), "id") == rows(probe, "id")


def test_rebuild_spreads_a_hot_key_over_tasks(spark, many_ranges):
    n = 4000
    log = spark.range(n).select(F.when(F.col("id") % 10 < 9, 1).otherwise(F.col("id")).cast("long").alias("k"), "id",
                                F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("at"))
    got = history_from_changes(log, "k", "at")
    want = {}
    for r in log.collect():
        want.setdefault(r["k"], []).append(r["at"])
    pairs = {(k, a, b) for k, v in want.items() for a, b in zip(sorted(v), [*sorted(v)[1:], None])}
    assert {(r["k"], r[VALID_FROM], r["valid_to"]) for r in got.collect()} == pairs
    sizes = [r["count"] for r in ordered_ranges(log, ["k", "at"]).groupBy("_part").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 0.5 * n


def test_null_is_a_batch(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 6)], "id long, _batch_id int")
    assert rows(df.where(in_batches([None, 5])), "id") == [(1,), (2,)]
    assert rows(df.where(in_batches([6])), "id") == [(3,)]
    assert rows(df.where(in_batches([None])), "id") == [(1,)]
    assert df.where(in_batches([])).count() == 0
