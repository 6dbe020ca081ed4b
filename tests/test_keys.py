"""Batch ids and distributed surrogate keys."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tierflow.operators.keys import assign_surrogate_keys, continue_from, next_batch_id, next_batch_value
from tierflow.sources.tables import layer_path


def test_next_batch_id(spark):
    empty = spark.createDataFrame([], "_batch_id int")
    assert next_batch_value(empty) == 1
    df = spark.createDataFrame([(1,), (4,), (None,)], "_batch_id int")
    assert next_batch_id(df).collect()[0]["next_batch_id"] == 5


def test_keys_unique_gap_free_in_order_under_skew(spark):
    # a third of the rows share one leading key: the range split uses the tie-breaker
    n = 3000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
                               F.col("id").alias("tie"))
    out = assign_surrogate_keys(df, ["k", "tie"], start=20000, name="sk", partitions=6)
    got = out.agg(F.min("sk"), F.max("sk"), F.count_distinct("sk"), F.count("*")).collect()[0]
    assert tuple(got) == (20000, 20000 + n - 1, n, n)
    expected = df.withColumn("rk", F.row_number().over(Window.orderBy("k", "tie")) + 19999)
    assert out.join(expected, ["k", "tie"]).filter(F.col("sk") != F.col("rk")).count() == 0


def test_ids_continue_across_batches(spark):
    first = assign_surrogate_keys(spark.range(5).withColumnRenamed("id", "n"), ["n"], start=20000, name="sk")
    nxt = continue_from(first, "sk", 20000)
    second = assign_surrogate_keys(spark.range(5, 8).withColumnRenamed("id", "n"), ["n"], start=nxt, name="sk")
    ids = sorted(r[0] for r in first.unionByName(second).select("sk").collect())
    assert ids == list(range(20000, 20008))
    assert continue_from(spark.createDataFrame([], "sk long"), "sk", 300000) == 300000


def test_layer_namespace():
    assert layer_path("s3://b/wh/", "prod", " silver ", "stg") == "s3://b/wh/prod/silver/stg"
    assert layer_path("/wh", "dev", "", "t") == "/wh/dev/default/t"


def test_a_cluster_without_a_shared_folder_is_refused(monkeypatch):
    import pytest
    from tierflow import session

    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())
