"""States at a run or a time from change rows over bases; checks counted while writing."""

import datetime as dt
import random

import pytest

from tests.conftest import plan_text, rows
from tierflow.operators import checks as C
from tierflow.operators.diff import table_diff
from tierflow.operators.merge import merge_upsert
from tierflow.operators.versions import NoSuchState, Versions
from tierflow.session import stage, work_dir
from tierflow.sources.storage import KeyedTable, Table

DAY = dt.datetime(2024, 1, 1)
SCHEMA = "k long, v string, at timestamp_ntz"


def day(n, hours=0):
    return DAY + dt.timedelta(days=n, hours=hours)


def batch(spark, values):
    return spark.createDataFrame([(k, v, day(d)) for k, v, d in values], SCHEMA)


def versions(spark, **kw):
    base = work_dir(spark, "versions")
    return Versions(spark, f"{base}/past", KeyedTable(spark, f"{base}/t", "k", 4), **kw)


@pytest.mark.parametrize("slack,based", [(1.0, True), (1000.0, False)])
def test_every_state_is_that_of_its_run(spark, slack, based):
    rng = random.Random(3)
    past, states = versions(spark, slack=slack), []
    for run in range(7):
        keys = rng.sample([None, *range(12)], 9) if run != 4 else []  # run 4 brings nothing
        merge_upsert(past.table, batch(spark, [(k, rng.choice(["a", "b", None]), run) for k in keys]), ["-at"], log=past.log, run=run)
        past.enter(run, day(run))
        states.append(rows(past.table.read()))
    assert bool(past.bases.batches()) == based
    for run, want in enumerate(states):
        assert rows(past.at_run(run)) == want
        assert rows(past.at_time(day(run, 5))) == want
        assert rows(past.before_run(run)) == (states[run - 1] if run else [])
    assert past.at_run(3).schema == past.table.read().schema


def test_a_state_reads_the_runs_since_its_base_only(spark):
    past = versions(spark, slack=0.0)
    for run in range(3):
        merge_upsert(past.table, batch(spark, [(k, f"{run}", run) for k in range(5)]), ["-at"], log=past.log, run=run)
        past.enter(run, day(run))
    assert past.bases.batches() == [1, 2]
    plan = plan_text(past.at_run(2))  # run 2 has a base: no change row is looked at
    assert "/bases]" in plan and "/changes]" not in plan and "_base" in plan.split("PartitionFilters")[1].split("]")[0]
    since = plan_text(past._changes(1, 2)).split("PartitionFilters")[1].split("]")[0]
    assert "> 1" in since and "<= 2" in since


def test_a_table_that_only_grows_needs_no_base(spark):
    past = versions(spark)
    for run in range(4):
        merge_upsert(past.table, batch(spark, [(k, "x", run) for k in range(run * 5, run * 5 + 5)]), ["-at"], log=past.log, run=run)
        past.enter(run, day(run))
    assert past.bases.batches() == [] and past.at_run(3).count() == 20 and past.at_run(0).count() == 5


def test_deleted_keys_are_gone_and_may_come_back(spark):
    past = versions(spark)
    merge_upsert(past.table, batch(spark, [(1, "a", 0), (2, "b", 0)]), ["-at"], log=past.log, run=0)
    past.enter(0, day(0))
    before = stage(past.table.read(), "before")
    past.table.overwrite(past.table.read().where("k <> 1"))
    past.log.record(1, table_diff(before, past.table.read(), "k"))
    past.enter(1, day(1))
    merge_upsert(past.table, batch(spark, [(1, "again", 2)]), ["-at"], log=past.log, run=2)
    past.enter(2, day(2))
    assert [rows(past.at_run(r), "k", "v") for r in range(3)] == [[(1, "a"), (2, "b")], [(2, "b")], [(1, "again"), (2, "b")]]


def test_a_run_that_was_not_entered_is_no_state(spark):
    past = versions(spark)
    merge_upsert(past.table, batch(spark, [(1, "a", 0)]), ["-at"], log=past.log, run=0)
    for ask in (lambda: past.at_run(0), lambda: past.at_time(day(9))):
        with pytest.raises(NoSuchState):
            ask()
    for _ in range(2):  # a repeated entry is one run
        past.enter(0, day(0))
    assert past.runs.read().count() == 1 and rows(past.at_time(day(0)), "v") == [("a",)]
    with pytest.raises(NoSuchState):
        past.at_time(day(-1))


def test_a_diff_knows_null_keys_and_compares_values(spark):
    a = spark.createDataFrame([(None, "x"), (1, None), (2, "p")], "k long, v string")
    b = spark.createDataFrame([(None, "y"), (1, None), (3, "q")], "k long, v string")
    assert rows(table_diff(a, b, "k")) == sorted([(None, "x", "y", "update"), (2, "p", None, "delete"), (3, None, "q", "insert")], key=repr)
    # a table of the key alone
    assert rows(table_diff(a.select("k"), b.select("k"), "k")) == [(2, "delete"), (3, "insert")]


# --- checks while writing ---------------------------------------------------------------

CHECKS = [C.Check("nn", "t", "not_null", "email"), C.Check("uq", "t", "unique", "id"),
          C.Check("min", "t", "min", "x", args={"min_value": 0}), C.Check("rc", "t", "row_count", args={"min_rows": 1, "max_rows": 3}),
          C.Check("other", "u", "not_null", "id", severity="warn")]


@pytest.mark.parametrize("keep", ["true", "id < 3", "false"])
def test_counts_of_a_write_equal_those_of_a_scan(spark, keep):
    df = spark.createDataFrame([(1, "a", 5), (2, None, -1), (2, "b", None), (3, None, 0)], "id long, email string, x int").where(keep)
    other = spark.createDataFrame([(None,), (1,)], "id long")
    written, t = C.WriteChecks(CHECKS), Table(spark, work_dir(spark, "checked"))
    t.overwrite(written.on("t", df))
    assert {c.name for c, _ in written.counted()} == {"nn", "min", "rc"}
    models = {"t": t.read(), "u": other}
    assert rows(C.run_checks(models, CHECKS, written)) == rows(C.run_checks(models, CHECKS))


def test_row_checks_of_a_write_read_no_table(spark):
    written, t = C.WriteChecks(CHECKS[:1]), Table(spark, work_dir(spark, "checked"))
    t.overwrite(written.on("t", spark.createDataFrame([(1, None)], "id long, email string")))
    report = C.run_checks({"t": t.read()}, CHECKS[:1], written)
    assert "parquet" not in plan_text(report).lower() and rows(report, "failures", "status") == [(1, "fail")]
