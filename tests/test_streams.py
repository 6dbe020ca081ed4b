"""CSV landing, the exactly-once pipe and change-stream consumers."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tierflow.session import work_dir
from tierflow.sources.tables import PEDIDOS_CSV_SCHEMA
from tierflow.sources.storage import KeyedTable
from tierflow.streaming import changes as changes_module
from tierflow.streaming.changes import ChangeStream, StaleCheckpoint, consumer_table
from tierflow.streaming.pipe import DELIVERY, FilePipe, pipe_schema, read_csv, write_landing

COLS = PEDIDOS_CSV_SCHEMA.fieldNames()


def _rows(spark, ids, producto="Laptop"):
    return spark.createDataFrame(
        [(i, 1, producto, "2", "10.00", "2024-01-01", "enviado") for i in ids], PEDIDOS_CSV_SCHEMA)


def _setup(spark):
    root = work_dir(spark, "pipe-test")
    pipe = FilePipe(spark, f"{root}/landing", f"{root}/table", f"{root}/ck/pipe")
    changes = ChangeStream(spark, pipe.target, pipe_schema(), f"{root}/ck/changes")
    return root, pipe, changes


def test_csv_quotes_commas_padding_and_gzip(spark):
    root = work_dir(spark, "csv")
    src = spark.createDataFrame([(1, 2, 'Monitor Samsung 27"', "  7 ", None, "15/03/2024", "a, b")], PEDIDOS_CSV_SCHEMA)
    path = write_landing(src, root, 1)
    back = read_csv(spark, path)
    assert rows(back) == rows(src)
    assert all(f.endswith(".csv.gz") for f in back.inputFiles())


def test_pipe_loads_each_file_once(spark):
    root, pipe, _ = _setup(spark)
    write_landing(_rows(spark, [1, 2]), pipe.landing_root, 1)
    assert pipe.run() == 2
    assert pipe.run() == 0                      # nothing new: no micro-batch
    write_landing(_rows(spark, [3]), pipe.landing_root, 2)
    assert pipe.run() == 1
    assert rows(pipe.table(), "id") == [(1,), (2,), (3,)]


def test_peek_does_not_consume(spark):
    root, pipe, changes = _setup(spark)
    target = consumer_table(spark, f"{root}/consumer")
    assert not changes.has_data(target)          # nothing loaded yet
    write_landing(_rows(spark, [1, 2]), pipe.landing_root, 1)
    pipe.run()
    changes.consume_into(target)
    write_landing(_rows(spark, [3, 4]), pipe.landing_root, 2)
    pipe.run()
    assert rows(changes.pending(target), "id") == [(3,), (4,)]
    assert rows(changes.pending(target), "id") == [(3,), (4,)]   # peeking twice: still waiting
    assert changes.has_data(target)
    assert changes.consume_into(target) == 1
    assert not changes.has_data(target)
    assert changes.consume_into(target) == 0
    assert changes.consume_if_waiting(target) == 0
    write_landing(_rows(spark, [5]), pipe.landing_root, 3)
    pipe.run()
    assert changes.consume_if_waiting(target) == 1
    assert rows(target.read(), "id") == [(1,), (2,), (3,), (4,), (5,)]


def test_two_streams_into_one_target(spark):
    root = work_dir(spark, "two-streams")
    target = consumer_table(spark, f"{root}/consumer")
    streams = []
    for name, ids in (("a", range(10)), ("b", range(10, 20))):
        pipe = FilePipe(spark, f"{root}/{name}/landing", f"{root}/{name}/table", f"{root}/{name}/ck")
        write_landing(_rows(spark, ids), pipe.landing_root, 1)
        pipe.run()
        streams.append(ChangeStream(spark, pipe.target, pipe_schema(), f"{root}/{name}/ck-changes", name=name))
    for s in streams:
        s.consume_into(target)
        assert not s.has_data(target)
    assert target.read().count() == target.read().select("id").distinct().count() == 20


def test_a_replaced_checkpoint_is_refused(spark):
    root, pipe, changes = _setup(spark)
    target = consumer_table(spark, f"{root}/consumer")
    write_landing(_rows(spark, range(10)), pipe.landing_root, 1)
    pipe.run()
    changes.consume_into(target)
    fresh = ChangeStream(spark, pipe.target, pipe_schema(), f"{root}/ck/other")
    with pytest.raises(StaleCheckpoint):
        fresh.consume_into(target)
    assert target.read().count() == 10


@pytest.mark.parametrize("when", ["before", "after"])
def test_failed_batch_is_applied_exactly_once(spark, monkeypatch, when):
    root, pipe, changes = _setup(spark)
    target = KeyedTable(spark, f"{root}/current", "id", 4)
    write_landing(_rows(spark, [1, 2]), pipe.landing_root, 1)
    write_landing(_rows(spark, [2], producto="Mouse"), pipe.landing_root, 2)
    pipe.run()
    real = changes_module.merge_upsert

    def fails(*a, **k):
        if when == "after":
            real(*a, **k)
        raise RuntimeError("injected fault")

    monkeypatch.setattr(changes_module, "merge_upsert", fails)
    with pytest.raises(Exception, match="injected fault"):
        changes.upsert_into(target, ["-" + DELIVERY, "producto"])
    monkeypatch.undo()
    changes.upsert_into(target, ["-" + DELIVERY, "producto"])
    assert rows(target.read(), "id", "producto") == [(1, "Laptop"), (2, "Mouse")]
    assert rows(target.read().groupBy("id").count().filter(F.col("count") > 1)) == []


def test_a_replayed_append_replaces_itself(spark):
    root, pipe, changes = _setup(spark)
    target = consumer_table(spark, f"{root}/consumer")
    write_landing(_rows(spark, [1, 2]), pipe.landing_root, 1)
    pipe.run()
    real = target.write

    def fails(df):
        real(df)
        raise RuntimeError("injected fault")

    target.write = fails
    with pytest.raises(Exception, match="injected fault"):
        changes.consume_into(target)
    target.write = real
    assert changes.consume_into(target) == 1
    assert rows(target.read(), "id") == [(1,), (2,)]


def test_deliveries_are_ordered_by_number(spark):
    root, pipe, changes = _setup(spark)
    target = KeyedTable(spark, f"{root}/current", "id", 4)
    for seq, producto in ((1_000_000, "newest"), (999_999, "older")):
        write_landing(_rows(spark, [1], producto=producto), pipe.landing_root, seq)
    pipe.run()
    changes.upsert_into(target, ["-" + DELIVERY, "producto"])
    assert rows(target.read(), "producto") == [("newest",)]


def test_result_does_not_depend_on_the_cut_into_micro_batches(spark):
    root, pipe, _ = _setup(spark)
    for seq, producto in ((2, "new"), (1, "old"), (3, "newest"), (4, "last")):
        write_landing(_rows(spark, [1, seq + 10], producto=producto), pipe.landing_root, seq)
        pipe.run()
    got = []
    for n in (1, 1000):
        target = KeyedTable(spark, f"{root}/current-{n}", "id", 4)
        s = ChangeStream(spark, pipe.target, pipe_schema(), f"{root}/ck/cut-{n}", max_files_per_trigger=n)
        s.upsert_into(target, ["-" + DELIVERY, "producto"])
        got.append(rows(target.read(), "id", "producto"))
    assert got[0] == got[1] and (1, "last") in got[0]


def test_many_micro_batches_are_merged_once(spark, monkeypatch):
    root, pipe, _ = _setup(spark)
    for seq in range(1, 5):
        write_landing(_rows(spark, [0, seq], producto=f"p{seq}").coalesce(1), pipe.landing_root, seq)
        pipe.run()
    target = KeyedTable(spark, f"{root}/current", "id", 4)
    merges, real = [], changes_module.merge_upsert
    monkeypatch.setattr(changes_module, "merge_upsert", lambda *a, **k: (merges.append(1), real(*a, **k)))
    want = [(0, "p4"), (1, "p1"), (2, "p2"), (3, "p3"), (4, "p4")]
    for ck in ("first", "replay"):
        s = ChangeStream(spark, pipe.target, pipe_schema(), f"{root}/ck/{ck}", max_files_per_trigger=1)
        assert s.upsert_into(target, ["-" + DELIVERY, "producto"]) >= 4
        assert rows(target.read(), "id", "producto") == want
    assert s.upsert_into(target, ["-" + DELIVERY, "producto"]) == 0
    assert len(merges) == 2


def test_rows_of_a_failed_merge_are_merged_by_the_next_run(spark, monkeypatch):
    root, pipe, _ = _setup(spark)
    changes = ChangeStream(spark, pipe.target, pipe_schema(), f"{root}/ck/changes", max_files_per_trigger=1)
    target = KeyedTable(spark, f"{root}/current", "id", 4)
    for seq in (1, 2):
        write_landing(_rows(spark, [1, seq + 1], producto=f"p{seq}"), pipe.landing_root, seq)
        pipe.run()

    def fails(*a, **k):
        raise RuntimeError("injected fault")

    with monkeypatch.context() as m:
        m.setattr(changes_module, "merge_upsert", fails)
        with pytest.raises(RuntimeError, match="injected fault"):
            changes.upsert_into(target, ["-" + DELIVERY, "producto"])
    assert changes.upsert_into(target, ["-" + DELIVERY, "producto"]) == 0
    assert rows(target.read(), "id", "producto") == [(1, "p2"), (2, "p1"), (3, "p2")]


def test_upsert_of_files_without_rows(spark):
    root, pipe, changes = _setup(spark)
    _rows(spark, [1]).where("false").selectExpr("*", "'' as _source_file", "1L as _delivery").write.parquet(pipe.target)
    target = KeyedTable(spark, f"{root}/current", "id", 4)
    assert changes.upsert_into(target, ["-" + DELIVERY, "producto"]) == 1
    assert target.read().count() == 0


def test_pipe_can_archive_loaded_files(spark):
    root = work_dir(spark, "pipe-archive")
    pipe = FilePipe(spark, f"{root}/landing", f"{root}/table", f"{root}/ck", archive_dir=f"{root}/archive")
    write_landing(_rows(spark, [1, 2]), pipe.landing_root, 1)
    assert pipe.run() == 2
    write_landing(_rows(spark, [3]), pipe.landing_root, 2)
    assert pipe.run() == 1
    assert rows(pipe.table(), "id") == [(1,), (2,), (3,)]
    # the first delivery was moved away (kept under the archive with its original path)
    archived = spark.read.schema(PEDIDOS_CSV_SCHEMA).option("header", True) \
        .option("recursiveFileLookup", True).csv(f"{root}/archive")
    assert rows(archived, "id") == [(1,), (2,)]


@pytest.mark.parametrize("name", ["orders:eu", "a/b", "x=1 %#", "007", "2024-01-01"])
def test_any_name_of_a_stream(spark, name):
    root, pipe, _ = _setup(spark)
    target = consumer_table(spark, f"{root}/consumer")
    stream = ChangeStream(spark, pipe.target, pipe_schema(), f"{root}/ck/named", name=name)
    other = ChangeStream(spark, pipe.target, pipe_schema(), f"{root}/ck/other", name="7")
    write_landing(_rows(spark, [1, 2]), pipe.landing_root, 1)
    pipe.run()
    stream.consume_into(target)
    assert not stream.has_data(target) and other.has_data(target)
    write_landing(_rows(spark, [3]), pipe.landing_root, 2)
    pipe.run()
    assert rows(stream.pending(target), "id") == [(3,)]
    with pytest.raises(StaleCheckpoint):
        ChangeStream(spark, pipe.target, pipe_schema(), f"{root}/ck/fresh", name=name).consume_into(target)
    stream.consume_into(target)
    assert rows(target.read(), "id") == [(1,), (2,), (3,)]


def test_peeking_reads_one_row_per_consumed_file(spark):
    root, pipe, changes = _setup(spark)
    target = consumer_table(spark, f"{root}/consumer")
    write_landing(_rows(spark, range(500)), pipe.landing_root, 1)
    pipe.run()
    changes.consume_into(target)
    files = changes_module.consumed_files(target).read()
    assert files.count() == files.select("_change_file").distinct().count() < 500 and target.read().count() == 500
    with pytest.raises(ValueError, match="name"):
        ChangeStream(spark, pipe.target, pipe_schema(), f"{root}/ck/none", name="")
