"""Corrupt lines, quarantine of failing rows and the ledger of processed batches."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tierflow.operators.merge import Ledger, ledger_run
from tierflow.session import work_dir
from tierflow.sources.storage import KeyedTable
from tierflow.sources.tables import PEDIDOS_CSV_SCHEMA
from tierflow.streaming.changes import ATTEMPT, REASON, ChangeStream, Quarantine, StaleCheckpoint, consumer_table
from tierflow.streaming.lines import CheckedPipe
from tierflow.streaming.pipe import landing_folder

HEADER = ",".join(PEDIDOS_CSV_SCHEMA.fieldNames())


def _deliver(spark, landing, seq, lines):
    text = spark.createDataFrame([(line,) for line in [HEADER, *lines]], "value string").coalesce(1)
    text.write.text(landing_folder(landing, seq))


def test_corrupt_lines_are_kept_with_a_reason(spark):
    root = work_dir(spark, "lines-test")
    pipe = CheckedPipe(spark, f"{root}/landing", f"{root}/loaded", f"{root}/ck")
    _deliver(spark, pipe.landing_root, 1, ['1,2,"a, ""b""",3,4.0,2024-01-01,F', "2,2,short", "3,2,p,3,4.0,2024-01-01,F,more",
                                           '4,2,"open,3,4.0,2024-01-01,F', "x,2,p,3,4.0,2024-01-01,F", "5,2,,,,,"])
    assert pipe.run() == 1 and pipe.run() == 0
    assert rows(pipe.table(), "id", "producto") == [(1, 'a, "b"'), (5, None)]
    assert rows(pipe.bad.read(), "_line", "_reason") == [
        ("2,2,short", "short"), ("3,2,p,3,4.0,2024-01-01,F,more", "long"), ('4,2,"open,3,4.0,2024-01-01,F', "unbalanced quote"),
        ("x,2,p,3,4.0,2024-01-01,F", "value")]
    _deliver(spark, pipe.landing_root, 2, ["7,2,p,3,4.0,2024-01-01,F"])
    assert pipe.run() == 1 and pipe.bad.read().count() == 4
    got = rows(pipe.report(), "_delivery", "lines", "short", "long", "unbalanced_quote", "value")
    assert got == [(1, 6, 1, 1, 1, 1), (2, 1, 0, 0, 0, 0)]


def _convert(accept):
    def convert(df):
        n = F.col("v").try_cast("int")
        return df.withColumn("v", n).withColumn(REASON, F.when(~F.coalesce(n >= accept, F.lit(False)), "value"))
    return convert


def _checked(spark, name="orders"):
    root = work_dir(spark, "quarantine-test")
    schema = spark.createDataFrame([], "id long, v string").schema
    stream = ChangeStream(spark, f"{root}/source", schema, f"{root}/ck", name=name)
    return root, stream, consumer_table(spark, f"{root}/target"), Quarantine(spark, f"{root}/aside", schema)


def _land(spark, root, values):
    spark.createDataFrame(values, "id long, v string").coalesce(1).write.mode("append").parquet(f"{root}/source")


def test_failing_rows_wait_and_a_retry_takes_them_up_once(spark):
    root, stream, target, aside = _checked(spark, "orders:eu")
    _land(spark, root, [(1, "5"), (2, "x"), (3, "1"), (4, None)])
    assert stream.consume_checked(target, aside, _convert(3)) == 1
    assert rows(target.read(), "id", "v") == [(1, 5)]
    assert rows(aside.open(), "id", "v", REASON, ATTEMPT) == [(2, "x", "value", 1), (3, "1", "value", 1), (4, None, "value", 1)]
    assert not stream.has_data(target) and stream.consume_checked(target, aside, _convert(3)) == 0
    stream.retry(target, aside, _convert(1))
    stream.retry(target, aside, _convert(9))  # attempt 3: nothing is accepted, nothing is lost
    assert rows(target.read(), "id", "v", ATTEMPT) == [(1, 5, 1), (3, 1, 2)]
    assert rows(aside.open(), "id", "v", ATTEMPT) == [(2, "x", 3), (4, None, 3)]
    _land(spark, root, [(5, "0"), (6, "8")])
    stream.consume_checked(target, aside, _convert(3))
    assert rows(aside.open(), "id", ATTEMPT) == [(2, 3), (4, 3), (5, 1)]
    stream.retry(target, aside, _convert(0))
    assert rows(target.read(), "id") == [(1,), (3,), (5,), (6,)]
    assert rows(aside.open(), "id", ATTEMPT) == [(2, 4), (4, 4)]


def test_an_interrupted_retry_is_repeated(spark):
    root, stream, target, aside = _checked(spark)
    _land(spark, root, [(1, "5"), (2, "1"), (3, "x")])
    stream.consume_checked(target, aside, _convert(3))
    # the repeat doesn't take the half-written attempt 2 for one that waits
    real, aside.taken.write = aside.taken.write, lambda df: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        stream.retry(target, aside, _convert(1))  # both tables are written, the entry is not
    aside.taken.write = real
    stream.retry(target, aside, _convert(1))
    assert rows(target.read(), "id") == [(1,), (2,)]
    assert rows(aside.open(), "id", ATTEMPT) == [(3, 2)]


def test_all_good_and_nothing_good(spark):
    root, stream, target, aside = _checked(spark)
    _land(spark, root, [(1, "x")])
    stream.consume_checked(target, aside, _convert(0))
    assert aside.open().count() == 1 and not target.exists()
    root, stream, target, aside = _checked(spark)
    _land(spark, root, [(1, "1")])
    stream.consume_checked(target, aside, _convert(0))
    stream.retry(target, aside, _convert(0))
    assert aside.open().count() == 0 and target.read().count() == 1
    with pytest.raises(StaleCheckpoint):
        ChangeStream(spark, stream.source_path, stream.schema, f"{root}/fresh", name=stream.name).consume_checked(target, aside, _convert(0))


def test_ledger_takes_batches_of_any_age_once(spark):
    root = work_dir(spark, "ledger-test")
    table, ledger = KeyedTable(spark, f"{root}/t", "k"), Ledger(spark, f"{root}/ledger")
    source = spark.createDataFrame([(1, "new", 9, 3), (2, "b", 2, None), (1, "old", 1, 1), (3, "c", 1, 1)],
                                   "k int, v string, at int, _batch_id int")
    order = ["-at"]
    assert ledger_run(table, source.where("_batch_id = 3"), ledger, order) == 1
    assert ledger_run(table, source.where("_batch_id = 3 or _batch_id is null"), ledger, order) == 1
    assert ledger_run(table, source, ledger, order) == 1 and ledger_run(table, source, ledger, order) == 0
    assert rows(table.read(), "k", "v") == [(1, "new"), (2, "b"), (3, "c")]
