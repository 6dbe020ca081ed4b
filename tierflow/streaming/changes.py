"""Change streams over a loaded table: consume, peek, upsert, run-if-data.

A change stream is a Structured Streaming Parquet source over a table written
by a file sink; its *offset* is the stream checkpoint.  Consuming means
running the stream: rows reach the consumer's target and the checkpoint
commits.  Reading the table with a plain batch query never moves the offset.

A micro-batch that is replayed (the process died after the write but before
the checkpoint commit) changes nothing: an append replaces its own partition
(stream name, micro-batch number) of the target, and an upsert merges rows that
the target already holds, by key and order.

The micro-batches of an upsert wait beside the checkpoint until the stream has
run; one merge then takes them up, so the table is rewritten once a run and not
once a micro-batch.  What a failed merge leaves there the next run merges.

Appends are numbered by the checkpoint, so a stream's name stands for one
checkpoint: a fresh checkpoint that meets a target already holding rows of that
name raises.  Several streams of different names may feed one target.

Beside its rows a consumer keeps one row per consumed file, so looking for
waiting data reads file names, not rows.  Streams are told apart by the stored
name, read as text, whatever characters it has.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.operators.dedup import latest_per_key
from tierflow.operators.merge import merge_upsert
from tierflow.session import empty_frame, stage
from tierflow.sources.storage import BatchTable, KeyedTable, exists, remove

CHANGE_FILE = "_change_file"
STREAM, CONSUMED_BATCH = "_stream", "_consumed_batch"
REASON, ATTEMPT, RAW = "_reason", "_attempt", "_raw"
MICRO_BATCH = "_micro_batch"


class StaleCheckpoint(RuntimeError):
    """A stream starts from a fresh checkpoint although its rows are in the target already."""


#: Read as written: Spark would make numbers or dates of names that look like them.
FILE_SCHEMA = T.StructType([T.StructField(CHANGE_FILE, T.StringType()), T.StructField(STREAM, T.StringType()),
                            T.StructField(CONSUMED_BATCH, T.LongType())])


def consumed_files(target: BatchTable) -> BatchTable:
    """One row per consumed file, beside the rows of a consumer's table (readers of that pass over the folder)."""
    return BatchTable(target.spark, f"{target.root}/_files", by=(STREAM, CONSUMED_BATCH))


def consumer_table(spark: SparkSession, root: str) -> BatchTable:
    """A target for ``consume_into``: one partition per stream and micro-batch."""
    return BatchTable(spark, root, by=(STREAM, CONSUMED_BATCH))


class Quarantine(BatchTable):
    """Rows that a consumption could not convert, one partition per stream, attempt and micro-batch.

    Rows have the source's columns, ``_reason`` and the attempt that failed.  The
    micro-batches of an attempt that a retry has worked off are kept beside them.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType):
        super().__init__(spark, root, by=(STREAM, ATTEMPT, CONSUMED_BATCH))
        self.marks = T.StructType([T.StructField(STREAM, T.StringType()), T.StructField(ATTEMPT, T.IntegerType()),
                                   T.StructField(CONSUMED_BATCH, T.LongType())])
        self.schema = T.StructType([*schema.fields, T.StructField(REASON, T.StringType()), *self.marks.fields])
        self.taken = BatchTable(spark, f"{self.root}/_taken", by=self.by)

    def rows(self) -> DataFrame:
        """Every row of every attempt, also those that a retry has taken up."""
        return self.read(self.schema) if self.exists() else empty_frame(self.spark, self.schema)

    def open(self) -> DataFrame:
        """The rows that still wait: the first attempt of their micro-batch that no retry has worked off.

        A later one beside it is what an interrupted retry left.
        """
        parts = self.rows().groupBy(*self.by).agg(F.count(F.lit(1)).alias("_rows"))
        if self.taken.exists():
            done = self.taken.read(T.StructType([T.StructField("_rows", T.LongType()), *self.marks.fields]))
            parts = parts.join(done.select(*self.by), list(self.by), "left_anti")
        first = parts.groupBy(STREAM, CONSUMED_BATCH).agg(F.min(ATTEMPT).alias(ATTEMPT))
        return self.rows().join(first, list(self.by), "left_semi").select(*self.schema.fieldNames())


class ChangeStream:
    """G1: the rows of ``source_path`` not yet consumed by this stream's checkpoint."""

    def __init__(self, spark: SparkSession, source_path: str, schema: T.StructType, checkpoint: str,
                 name: str = "changes", max_files_per_trigger: int = 1000):
        self.spark = spark
        self.source_path = source_path
        self.schema = schema
        self.checkpoint = checkpoint
        self.name = name
        self.max_files_per_trigger = max_files_per_trigger
        if not name:
            raise ValueError("a stream needs a name")

    def stream(self) -> DataFrame:
        return (self.spark.readStream.schema(self.schema)
                .option("maxFilesPerTrigger", self.max_files_per_trigger)
                .parquet(self.source_path)
                .select("*", F.col("_metadata.file_path").alias(CHANGE_FILE)))

    def table(self) -> DataFrame:
        """The whole source table with each row's file (batch read)."""
        if not exists(self.spark, self.source_path):
            return empty_frame(self.spark, T.StructType([*self.schema.fields, T.StructField(CHANGE_FILE, T.StringType())]))
        return (self.spark.read.schema(self.schema).parquet(self.source_path)
                .select("*", F.col("_metadata.file_path").alias(CHANGE_FILE)))

    # --- consumption ------------------------------------------------------------------

    def _run(self, body: Callable[[DataFrame, int], None]) -> int:
        ran = 0

        def counted(batch: DataFrame, batch_id: int) -> None:
            nonlocal ran
            body(batch, batch_id)
            ran += 1

        (self.stream().writeStream.foreachBatch(counted)
         .option("checkpointLocation", self.checkpoint)
         .trigger(availableNow=True).start().awaitTermination())
        return ran

    def consume_into(self, target: BatchTable) -> int:
        """G1/G3 (``INSERT ... SELECT``): append every waiting row to ``target``.

        Returns the number of micro-batches (0 when nothing was waiting: G4).
        """
        self._refuse_stale(target)

        def body(batch: DataFrame, batch_id: int) -> None:
            marks = {STREAM: F.lit(self.name), CONSUMED_BATCH: F.lit(batch_id).cast("long")}
            target.write(batch.withColumns(marks))
            consumed_files(target).write(batch.select(CHANGE_FILE).distinct().withColumns(marks))
        return self._run(body)

    def _refuse_stale(self, target: BatchTable) -> None:
        if not exists(self.spark, f"{self.checkpoint}/offsets") and not self._consumed(target).isEmpty():
            raise StaleCheckpoint(f"{target.root} holds rows of stream {self.name}, {self.checkpoint} is fresh")

    def consume_checked(self, target: BatchTable, quarantine: Quarantine, convert: Callable[[DataFrame], DataFrame]) -> int:
        """Append the waiting rows that ``convert`` accepts; the others go to the quarantine as attempt 1.

        ``convert`` adds ``_reason`` (NULL: accepted) and may change any column but
        ``_raw``, which holds the row as it came.  A failing row never stops its
        micro-batch.  Returns the number of micro-batches.
        """
        self._refuse_stale(target)

        def body(batch: DataFrame, batch_id: int) -> None:
            marks = {STREAM: F.lit(self.name), CONSUMED_BATCH: F.lit(batch_id).cast("long")}
            rows = stage(batch, "checked")
            self._split(rows.withColumns(marks), target, quarantine, convert, 1)
            consumed_files(target).write(rows.select(CHANGE_FILE).distinct().withColumns(marks))
        return self._run(body)

    def retry(self, target: BatchTable, quarantine: Quarantine, convert: Callable[[DataFrame], DataFrame]) -> None:
        """The second (third, ...) attempt at this stream's quarantined rows, with a mended ``convert``.

        Accepted rows reach ``target``; the others stay as the next attempt.  A
        retry that failed half-way is repeated with the same ``convert`` and replaces
        what it had written.
        """
        waiting = stage(quarantine.open().where(F.col(STREAM) == self.name), "retry")
        last = waiting.agg(F.max(ATTEMPT)).first()[0] or 0
        for attempt in range(1, last + 1):  # attempts, not rows
            rows = waiting.where(F.col(ATTEMPT) == attempt)
            self._split(rows.drop(ATTEMPT, REASON), target, quarantine, convert, attempt + 1)
            quarantine.taken.write(rows.groupBy(*quarantine.by).agg(F.count(F.lit(1)).alias("_rows")))

    def _split(self, rows: DataFrame, target: BatchTable, quarantine: Quarantine, convert, attempt: int) -> None:
        kept = F.struct(*[F.col(c) for c in self.schema.fieldNames()])
        marked = stage(convert(rows.withColumn(RAW, kept)).withColumn(ATTEMPT, F.lit(attempt)), "converted")
        good = marked.where(F.col(REASON).isNull()).drop(RAW, REASON)
        if attempt > 1:  # a partition of its own: the first attempt's stays
            good = good.withColumn(STREAM, F.lit(f"{self.name} attempt {attempt}"))
        target.write(good)
        quarantine.write(marked.where(F.col(REASON).isNotNull()).select(f"{RAW}.*", REASON, STREAM, ATTEMPT, CONSUMED_BATCH))

    def _consumed(self, target: BatchTable) -> DataFrame:
        """The files that this stream has consumed into ``target``."""
        files = consumed_files(target)
        if not files.exists():
            return empty_frame(self.spark, T.StructType(FILE_SCHEMA.fields[:1]))
        return files.read(FILE_SCHEMA).where(F.col(STREAM) == self.name).select(CHANGE_FILE)

    def upsert_into(self, target: KeyedTable, order_by) -> int:
        """G3 (``MERGE``): upsert every waiting row into a keyed ``target``.

        The first row of a key under ``order_by`` stays, whether it is waiting
        or stored, so the result does not depend on the cut into micro-batches.
        Each micro-batch stores its first row of each key; they are merged once,
        also when the run ends by an error.
        """
        kept = BatchTable(self.spark, f"{self.checkpoint}/waiting", by=(MICRO_BATCH,))

        def body(batch: DataFrame, batch_id: int) -> None:
            # written by folder, so that a micro-batch without rows has one too
            latest_per_key(batch, target.keys, order_by).write.mode("overwrite").parquet(f"{kept.root}/{MICRO_BATCH}={batch_id}")
        try:
            return self._run(body)
        finally:
            self._merge(kept, target, order_by)

    def _merge(self, kept: BatchTable, target: KeyedTable, order_by) -> None:
        """Merge the stored micro-batches, of equal rows the later one's, then remove them."""
        numbers = kept.batches()
        if not numbers:
            return
        marks = [T.StructField(CHANGE_FILE, T.StringType()), T.StructField(MICRO_BATCH, T.LongType())]
        rows = kept.read(T.StructType([*self.schema.fields, *marks]))
        if len(numbers) > 1:
            rows = latest_per_key(rows, target.keys, [*order_by, "-" + MICRO_BATCH])
        merge_upsert(target, rows.drop(MICRO_BATCH), order_by, check_unique=False, staged=len(numbers) == 1)
        remove(self.spark, kept.root)

    def consume_if_waiting(self, target: BatchTable) -> int:
        """A task body gated on waiting data: no streaming query starts when nothing is waiting."""
        return self.consume_into(target) if self.has_data(target) else 0

    # --- looking without consuming ----------------------------------------------------

    def pending(self, consumer: BatchTable) -> DataFrame:
        """Rows waiting for ``consumer``; a plain read, the offset does not move.

        The rows of files that this stream has not consumed.  Spark joins the
        file names; none is held by the driver.
        """
        return self.table().join(self._consumed(consumer), CHANGE_FILE, "left_anti").select(*self.schema.fieldNames(), CHANGE_FILE)

    def has_data(self, consumer: BatchTable) -> bool:
        """G4, the run-only-if-data gate: is anything waiting?"""
        return not self.pending(consumer).isEmpty()
