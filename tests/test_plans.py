"""Plan shapes the design relies on, checked on the flagship and model queries."""

import re

from tests.conftest import SF_SMALL, plan_text
from tierflow.plans import catalog
from tierflow.plans import core_queries as Q


def test_sales_mart_plan(spark):
    plan = plan_text(catalog.QUERIES["sales_mart"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan            # dedup limited before the shuffle
    assert "BroadcastHashJoin" in plan                                  # small by its statistics in bytes
    assert plan.count("HashAggregate") >= 2                             # partial + final aggregation
    assert "SortMergeJoin" not in plan


def test_scans_read_only_needed_columns(spark):
    flat = plan_text(catalog.QUERIES["flatten_attributes"](spark, SF_SMALL))
    orders = re.findall(r"ReadSchema: struct<([^>]*)>", flat)
    assert orders and all(s == "o_orderkey:bigint,o_custkey:bigint" for s in orders)   # ids + keys only
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan_text(Q.fct(spark, SF_SMALL)))
    customers = [s for s in schemas if "c_custkey" in s]
    assert customers and all("c_acctbal" not in s and "c_mktsegment" not in s for s in customers)


def test_fact_join_counts_nothing_in_one_task(spark):
    plan = plan_text(Q.fct(spark, SF_SMALL))
    assert "SinglePartition" not in plan


def test_silver_customers_shuffle_once(spark):
    plan = plan_text(Q.stg_c(spark, SF_SMALL))
    assert plan.count("hashpartitioning") <= 2      # the nation join, if shuffled, and the window
