"""Corrupt lines of a delivery (A3, A4): kept with a reason, never read as half a row.

A line that has too few or too many fields, an unbalanced quote or a value that
doesn't fit its declared type is kept whole in a table of bad lines; the other lines
of its file load as usual.  Both tables have one partition per micro-batch, so a
load that is repeated after a failure replaces what it had written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.session import stage
from tierflow.sources.storage import BatchTable
from tierflow.streaming.pipe import _CSV_OPTIONS, DELIVERY, SOURCE_FILE, FilePipe, _landing_glob, with_origin

LINE, REASON, LOAD = "_line", "_reason", "_load"


def line_reason(line: Column, fields: int) -> Column:
    """Why a line of ``fields`` declared fields can't be a row."""
    outside = F.regexp_replace(line, '"([^"]|"")*"', "")
    commas = F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit("")))
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    return (F.when(quotes % 2 == 1, "unbalanced quote").when(commas + 1 < fields, "short")
            .when(commas + 1 > fields, "long").otherwise("value"))


class CheckedPipe(FilePipe):
    """A4 with corrupt-line capture: good rows in ``good``, the other lines in ``bad``."""

    def __init__(self, *args, **kwargs):
        super().__init__(*args, **kwargs)
        self.good = BatchTable(self.spark, f"{self.target}/good", by=(LOAD,))
        self.bad = BatchTable(self.spark, f"{self.target}/bad", by=(LOAD,))

    def source(self) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(LINE, T.StringType())])
        reader = (self.spark.readStream.schema(schema).options(**_CSV_OPTIONS).option("columnNameOfCorruptRecord", LINE)
                  .option("maxFilesPerTrigger", self.max_files_per_trigger))
        if self.archive_dir:
            reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", self.archive_dir)
        return with_origin(reader.csv(_landing_glob(self.landing_root)))

    def run(self) -> int:
        """Load everything waiting, then stop; returns the number of micro-batches."""
        ran = 0

        def body(batch: DataFrame, batch_id: int) -> None:
            nonlocal ran
            lines = stage(batch, "lines").withColumn(LOAD, F.lit(batch_id).cast("long"))  # the files are read once
            self.good.write(lines.where(F.col(LINE).isNull()).drop(LINE))
            self.bad.write(lines.where(F.col(LINE).isNotNull()).select(
                LINE, line_reason(F.col(LINE), len(self.schema)).alias(REASON), SOURCE_FILE, DELIVERY, LOAD))
            ran += 1

        (self.source().writeStream.foreachBatch(body).option("checkpointLocation", self.checkpoint)
         .trigger(availableNow=True).start().awaitTermination())
        return ran

    def table(self) -> DataFrame:
        return self.good.read().drop(LOAD)

    def report(self) -> DataFrame:
        """Lines per file: all, and the bad ones by reason."""
        kinds = ("short", "long", "unbalanced quote", "value")
        rows = self.good.read().select(SOURCE_FILE, DELIVERY, F.lit(None).cast("string").alias(REASON)) if self.good.exists() else None
        if self.bad.exists():
            bad = self.bad.read().select(SOURCE_FILE, DELIVERY, REASON)
            rows = bad if rows is None else rows.unionByName(bad)
        if rows is None:
            raise FileNotFoundError(f"nothing loaded at {self.target}")
        return rows.groupBy(SOURCE_FILE, DELIVERY).agg(
            F.count(F.lit(1)).alias("lines"), *[F.count_if(F.col(REASON) == k).alias(k.replace(" ", "_")) for k in kinds])
