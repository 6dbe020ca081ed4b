"""Latest-row-per-key, rank, distinct: ties, NULL order keys and the planned shape."""

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import plan_text, rows
from tierflow.functions.scalar import norm_key
from tierflow.operators.dedup import distinct_rows, latest_per_expr_key, latest_per_key, rank_top1

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
SCHEMA = "k long, ts timestamp_ntz, b int, v string"


def test_newest_wins_nulls_last_and_ties_broken(spark):
    df = spark.createDataFrame([
        (1, T1, 1, "old"), (1, T2, 1, "new"), (1, None, 9, "null-ts"),
        (2, T1, 1, "b1"), (2, T1, 2, "b2"),          # tie on ts: higher batch wins
        (3, None, 1, "only"),
    ], SCHEMA)
    out = latest_per_key(df, "k", ["-ts", "-b"])
    assert rows(out, "k", "v") == [(1, "new"), (2, "b2"), (3, "only")]


def test_partition_by_expression(spark):
    df = spark.createDataFrame([(1, "A@x.com ", T1), (2, " a@x.com", T2), (3, "b@x.com", T1)],
                               "id long, email string, ts timestamp_ntz")
    out = latest_per_expr_key(df, norm_key("email"), ["-ts", "-id"])
    assert rows(out, "id") == [(2,), (3,)]
    assert "_dedup_key" not in out.columns


def test_rank_keeps_ties(spark):
    df = spark.createDataFrame([(1, "a", 10), (1, "a", 11), (1, "b", 12), (2, "c", 13)], "k int, p string, id int")
    assert rows(rank_top1(df, "k", ["p"]), "id") == [(10,), (11,), (13,)]


def test_distinct_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None)], "k int, v string")
    assert distinct_rows(df).count() == 2


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("ts"))
    plan = plan_text(latest_per_key(df, "k", ["-ts"]))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_rank_top1_mixed_nulls_and_desc(spark):
    df = spark.createDataFrame([(1, None, 1), (1, "a", 2), (2, "b", 3), (2, "c", 4), (None, "z", 5)],
                               "k int, p string, id int")
    assert rows(rank_top1(df, "k", ["p"]), "id") == [(1,), (3,), (5,)]      # NULL sorts first ascending
    assert rows(rank_top1(df, "k", ["-p"]), "id") == [(2,), (4,), (5,)]     # and last descending
    assert rows(rank_top1(df, "k", ["p", "-id"]), "id") == [(1,), (3,), (5,)]  # mixed: window path


def test_rank_top1_keeps_all_ties_without_a_window_over_them(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
                                  F.lit("same").alias("p"), "id")
    out = rank_top1(df, "k", ["p"])
    assert out.count() == 3000
    plan = plan_text(out)
    assert "rank(" not in plan and plan.count("WindowGroupLimit") >= 2   # one row per key before the shuffle
    assert rows(rank_top1(df.limit(10), "k", ["-id", "p"]), "k") == rows(df.limit(10).select("k").distinct())
