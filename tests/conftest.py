import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tierflow.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL


def rows(df, *cols):
    """Collected rows as sorted tuples (of ``cols`` if given)."""
    if cols:
        df = df.select(*cols)
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan_text(df) -> str:
    """The formatted physical plan, as ``EXPLAIN FORMATTED`` prints it."""
    df.createOrReplaceTempView("_plan_probe")
    return df.sparkSession.sql("explain formatted select * from _plan_probe").collect()[0][0]
