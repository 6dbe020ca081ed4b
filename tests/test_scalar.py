"""Safe casts, text normalisation and JSON paths on the dirt literals of the raw layer."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tierflow.functions.scalar import (as_of, clean_text, days_between, json_field, norm_key,
                                       parse_json_safe, safe_date, safe_decimal, safe_int)


def _one(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn("x")).collect()]


def test_bad_dates_become_null(spark):
    bad = ["15/03/2024", "2024.07.22", "marzo 2024", "32/13/2023", "99/99/9999"]
    assert _one(spark, bad, safe_date) == [None] * len(bad)
    assert _one(spark, ["1800-03-15", "2024-02-29"], safe_date) == [dt.date(1800, 3, 15), dt.date(2024, 2, 29)]


def test_bad_integers_become_null(spark):
    bad = ["N/A", "#ERROR!", "null_val", "ABCD$$", "???", ""]
    assert _one(spark, bad, safe_int) == [None] * len(bad)
    assert _one(spark, [" 7 ", "-3", "0"], safe_int) == [7, -3, 0]


def test_decimal_rounding_and_overflow(spark):
    out = _one(spark, ["123456789.12", "1.005", "-1.005", "-12.50"], safe_decimal)
    assert out == [None, Decimal("1.01"), Decimal("-1.01"), Decimal("-12.50")]


def test_text_normalisation(spark):
    assert _one(spark, ["  Ana  ", None], clean_text) == ["Ana", None]
    assert _one(spark, [" USER.1@Empresa.com "], norm_key) == ["user.1@empresa.com"]


def test_days_between_and_as_of(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 31),)], "d date")
    r = df.select(days_between("d", as_of("2025-01-01")).alias("n")).collect()[0]
    assert r["n"] == 1 and df.select(days_between("d", as_of("2025-01-01"))).schema[0].dataType.typeName() == "long"


def test_json_paths(spark):
    docs = ['{"color":"rojo","garantia_meses":12}', '{"promocion":null,"descuento_pct":"x"}', "not json", None]
    df = spark.createDataFrame([(d,) for d in docs], "j string").withColumn("v", parse_json_safe("j"))
    out = df.select(json_field("v", "color").alias("color"),
                    json_field("v", "garantia_meses", "int").alias("g"),
                    json_field("v", "promocion").alias("p"),
                    json_field("v", "descuento_pct", "int").alias("d")).collect()
    assert [tuple(r) for r in out] == [("rojo", 12, None, None), (None, None, None, None),
                                       (None, None, None, None), (None, None, None, None)]
    # malformed text parses to NULL instead of failing the query
    assert df.filter(F.col("v").isNull()).count() == 2
