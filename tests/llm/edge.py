"""Rows every operator must survive: nulls, empty and long texts, ties, repeats, clashing columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LONG = " ".join(f"w{i % 977}" for i in range(60_000))
SAME = "the same words stand here twice and then some more of them follow"
ROWS = [
    (1, SAME, "en", "a"), (1, SAME, "en", "a"), (2, SAME, "en", "b"), (None, SAME, None, None), (None, None, None, None),
    (3, None, "en", "a"), (4, "", "de", "a"), (5, " \t\n", "de", "c"), (6, LONG, "en", "c"), (7, LONG + " end", "en", "b"),
    (8, "mail jo.doe@mail.example.com or +1 (212) 555-0199 now", "en", "b"), (9, "ünï côdé 😀 10.0.0.1 😀", "fr", "ñ"),
    (8, "another text under an id that is taken", "en", None),
]
SCHEMA = "doc_id long, text string, lang string, source string"
#: Names that operators give to their results or might use inside.
CLASHING = ("score", "size", "shard", "slot", "kept", "target", "taken", "keep_id", "t", "u", "v", "n", "key", "root", "words", "spans",
            "secrets", "pii", "label", "item_id", "predicted", "held_out", "class_id", "weight", "text_sha256", "m", "count")


def documents(spark: SparkSession) -> DataFrame:
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASHING})


def labels(spark: SparkSession) -> DataFrame:
    rows = [(i, q, t) for i, q, t in ((1, 1, 0), (2, 1, 0), (3, 0, 1), (4, 0, 1), (6, 1, None), (None, 1, 1), (7, None, 0), (7, 1, 0), (8, 1, 1))]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def benchmark(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(1, SAME), (2, None), (3, ""), (4, SAME), (None, "alpha beta gamma delta epsilon zeta")], "item_id long, text string")
