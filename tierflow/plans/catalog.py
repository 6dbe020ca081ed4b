"""Imports every query module so that the registry is complete."""

from tierflow.plans import (check_queries, core_queries, delivery_queries, history_queries, ingest_queries,  # noqa: F401
                            stream_queries, table_queries, views)
from tierflow.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
