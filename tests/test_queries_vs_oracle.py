"""Every registered query against its DuckDB oracle SQL at sf0.001 (rows, columns, values)."""

import duckdb
import pytest

from __spark_entry__ import entry, queries
from tests.conftest import SF_SMALL, plan_text
from tierflow.plans import catalog
from tools.check_oracle import TABLES, digest

QUERIES = catalog.QUERIES
ORACLE = catalog.ORACLE


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(queries())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["ciudad", "producto", "total_pedidos", "unidades_vendidas", "ingresos_totales",
                          "ticket_promedio"]
    assert df.count() > 0


# Plan nodes no registered query may contain: all-pairs joins and row-at-a-time / Arrow Python.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "MapInPandas", "FlatMapGroupsInPandas")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = plan_text(df)
    assert not [n for n in FORBIDDEN if n in plan], plan
    cols = df.columns
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    srows = [tuple(r[i] for i in order) for r in df.collect()]
    rel = duck.sql(ORACLE[name])
    dcols = rel.columns
    dorder = sorted(range(len(dcols)), key=lambda i: dcols[i])
    drows = [tuple(r[i] for i in dorder) for r in rel.fetchall()]
    assert sorted(cols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(srows)[0] == digest(drows)[0]
