"""Data tests: NULL handling, the fused suite and the stop-on-error rule."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tierflow.functions.scalar import EMAIL_REGEX
from tierflow.operators import checks as C


def _df(spark):
    return spark.createDataFrame(
        [(1, "a@b.com", 5), (2, None, -1), (2, "bad", None), (3, "c@d.org", 0)], "id long, email string, x int")


def test_row_checks_null_rules(spark):
    df = _df(spark)
    assert C.not_null(df, "email").count() == 1
    assert rows(C.not_matching(df, "email", EMAIL_REGEX), "id") == [(2,)]  # NULL passes
    assert rows(C.below_min(df, "x", 0), "id") == [(2,)]                  # NULL passes, 0 inclusive
    assert rows(C.not_between(df, "x", F.lit(0), F.lit(4)), "id") == [(1,), (2,)]
    assert rows(C.duplicate_keys(df, "id")) == [(2, 2)]


def test_suite_one_row_per_check_and_enforce(spark):
    df = _df(spark)
    parent = spark.createDataFrame([(1,), (2,)], "id long")
    checks = [
        C.Check("nn", "t", "not_null", "email"),
        C.Check("uq", "t", "unique", "id"),
        C.Check("rel", "t", "relationships", "id", severity="warn", args={"to": "p", "field": "id"}),
        C.Check("min", "t", "min", "x", args={"min_value": 0}),
        C.Check("rc", "t", "row_count", args={"min_rows": 1}),
    ]
    rep = {r["check_name"]: (r["failures"], r["status"]) for r in C.run_checks({"t": df, "p": parent}, checks).collect()}
    assert rep == {"nn": (1, "fail"), "uq": (1, "fail"), "rel": (1, "warn"), "min": (1, "fail"), "rc": (0, "pass")}
    with pytest.raises(C.CheckFailed):
        C.enforce(C.run_checks({"t": df, "p": parent}, checks).collect())
    C.enforce(C.run_checks({"t": df, "p": parent}, [checks[2], checks[4]]).collect())  # warn only: no raise


def test_quality_profile_counts_classes(spark):
    raw = spark.createDataFrame([
        (1, " x ", "N/A", None, "15/03/2024", 1), (2, "y", "-3", "-1.00", "2030-01-01", 1), (3, "z", "2", "5.00", "2024-01-01", 2),
    ], "id long, producto string, cantidad string, precio_unitario string, fecha_pedido string, _batch_id int")
    p = {r["_batch_id"]: r.asDict() for r in C.batch_quality_profile(raw, "2025-01-01").collect()}
    assert p[1]["corrupt_quantity"] == 1 and p[1]["null_price"] == 1 and p[1]["future_date"] == 1
    assert p[1]["bad_date_format"] == 1 and p[1]["untrimmed_product"] == 1 and p[1]["non_positive_price"] == 1
    assert p[2]["total_rows"] == 1 and p[2]["corrupt_quantity"] == 0
    assert p[1]["copies_new_id"] == 0


def test_quality_profile_copies_and_orphans(spark):
    cols = "id long, cliente_id long, producto string, cantidad string, precio_unitario string, " \
           "fecha_pedido string, _batch_id int"
    raw = spark.createDataFrame([
        (1, 7, "x", "2", None, "2024-01-01", 1), (2, 7, "x", "2", None, "2024-01-01", 1),
        (3, 7, "x", "2", None, "2024-01-01", 1), (4, 99, "y", "1", "1.00", "2024-01-01", 1),
        (5, None, "y", "1", "1.00", "2024-01-01", 2),
    ], cols)
    customers = spark.createDataFrame([(7,)], "id long")
    p = {r["_batch_id"]: r.asDict() for r in
         C.batch_quality_profile(raw, "2025-01-01", customers=customers).collect()}
    assert (p[1]["copies_new_id"], p[1]["orphan_customer"]) == (2, 1)   # NULL key is not an orphan
    assert (p[2]["copies_new_id"], p[2]["orphan_customer"]) == (0, 0)


def test_no_checks_give_no_rows(spark):
    report = C.run_checks({"m": spark.range(3)}, [])
    assert report.count() == 0 and report.columns == ["check_name", "model", "severity", "failures", "status"]
