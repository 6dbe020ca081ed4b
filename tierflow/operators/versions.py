"""States of a merged table at any of its runs, from change rows over a base now and then.

A run's change rows come out of its merge (``ChangeLog``), so keeping the past
costs what changed, not the table.  The state after run r is the newest change of
each key among the runs up to r, over the newest base before r.  A base is
written when a state would read more than ``1 + SLACK`` times its own rows; a
table that only grows needs none.  Runs carry the time of their commit, so that a
time finds its run; only runs that were entered are states.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.functions.scalar import ntz_literal
from tierflow.operators.dedup import latest_per_key
from tierflow.operators.merge import ChangeLog, change_schema
from tierflow.session import empty_frame
from tierflow.sources.storage import BatchTable, KeyedTable

#: A state reads at most this share of its rows beyond the rows themselves.
SLACK = 1.0

RUN_SCHEMA = T.StructType([T.StructField("committed_at", T.TimestampNTZType()), T.StructField("_run", T.IntegerType())])


class NoSuchState(LookupError):
    """No run was entered under that number, or by that time."""


class Versions:
    """The past of one keyed table: its change log, its runs and their bases.

    Merge with ``log=versions.log, run=n`` and call ``enter(n, at)`` after it.  A run
    that is repeated replaces its own entry; its base, if any, is the same again.
    Change rows of type delete, as ``table_diff`` makes them, take the key away.
    """

    def __init__(self, spark: SparkSession, root: str, table: KeyedTable, slack: float = SLACK):
        self.spark = spark
        self.table = table
        self.slack = slack
        self.log = ChangeLog(spark, f"{root}/changes")
        self.runs = BatchTable(spark, f"{root}/runs", by=("_run",))
        self.bases = BatchTable(spark, f"{root}/bases", by=("_base",))

    # --- keeping ----------------------------------------------------------------------

    def enter(self, run: int, at: _dt.datetime) -> None:
        """Run ``run`` is done, committed at ``at``; writes a base when states have grown dear to read.

        Both counts come from the Parquet footers; no column is read.
        """
        rows = self.table.read().count() if self.table.exists() else 0
        base = self._base(run)
        kept = 0 if base is None else self.bases.read().where(F.col("_base") == base).count()
        if kept + self._changes(base, run).count() > (1 + self.slack) * rows:
            self.bases.write(self._state(base, run).withColumn("_base", F.lit(run)))
        self.runs.write(self.spark.range(1).select(ntz_literal(at).alias("committed_at"), F.lit(run).alias("_run")))

    # --- the past -----------------------------------------------------------------------

    def at_run(self, run: int) -> DataFrame:
        """The table as it stood after run ``run``; a run that changed nothing is a state too."""
        if run not in self.runs.batches():
            raise NoSuchState(f"run {run} of {self.table.root} was never entered")
        base = run if run in self.bases.batches() else self._base(run)
        return self._state(base, run)

    def at_time(self, at: _dt.datetime) -> DataFrame:
        """The table as it stood at ``at``: after the newest run committed by then."""
        run = None
        if self.runs.exists():
            done = self.runs.read(RUN_SCHEMA).where(F.col("committed_at") <= ntz_literal(at))
            run = done.agg(F.max_by("_run", F.struct("committed_at", "_run"))).first()[0]
        if run is None:
            raise NoSuchState(f"no run of {self.table.root} was committed by {at}")
        return self.at_run(run)

    def before_run(self, run: int) -> DataFrame:
        """The table as it was just before run ``run``; before the first run it was empty."""
        earlier = [r for r in self.runs.batches() if r < run]
        return self.at_run(earlier[-1]) if earlier else empty_frame(self.spark, self.table.schema())

    # --- replay -------------------------------------------------------------------------

    def _base(self, run: int) -> int | None:
        """The newest base of a run before ``run``."""
        return max((b for b in self.bases.batches() if b < run), default=None)

    def _changes(self, base: int | None, run: int) -> DataFrame:
        """The change rows after ``base`` up to ``run``; the run numbers prune the partitions."""
        schema = change_schema(self.table.schema(), self.table.keys)
        schema = T.StructType([*schema.fields, T.StructField("_run", T.IntegerType())])
        if not self.log.exists():
            return empty_frame(self.spark, schema)
        rows = self.log.read(schema).where(F.col("_run") <= run)
        return rows if base is None else rows.where(F.col("_run") > base)

    def _state(self, base: int | None, run: int) -> DataFrame:
        """One row per key before the shuffle from either side, as ``latest_per_key`` limits it."""
        schema, keys = self.table.schema(), self.table.keys
        after = [F.col(c) if c in keys else F.col(f"{c}_after").alias(c) for c in schema.fieldNames()]
        rows = self._changes(base, run).select(*after, "_change_type", "_run")
        if base is not None:
            stored = self.bases.read(T.StructType([*schema.fields, T.StructField("_base", T.IntegerType())]))
            rows = rows.unionByName(stored.where(F.col("_base") == base).withColumnRenamed("_base", "_run")
                                    .withColumn("_change_type", F.lit("insert")))
        return latest_per_key(rows, keys, ["-_run"]).where("_change_type <> 'delete'").select(*schema.fieldNames())
