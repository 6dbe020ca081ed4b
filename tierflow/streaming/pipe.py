"""File landing and continuous file load (A3, A4).

Files land in a landing folder, one sub-folder per delivery, named by the
delivery's number (``b000001``, ``b000002``, ...).  Loaded rows carry that number
as ``_delivery``: later deliveries are told by number, never by name.  The pipe is a Structured
Streaming file source over that folder with a checkpoint: each file is read
exactly once, whenever the pipe runs, and appended to a Parquet table through
the file sink (whose commit log makes the append exactly-once as well).
``trigger(availableNow=True)`` loads everything waiting and stops, so a run
with nothing new is a no-op with zero micro-batches.

At scale the backlog is split into micro-batches of at most
``max_files_per_trigger`` files, so one run never turns a large backlog into
one giant batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.sources.storage import exists
from tierflow.sources.tables import PEDIDOS_CSV_SCHEMA

SOURCE_FILE, DELIVERY = "_source_file", "_delivery"

# Text is written and read as is: no trimming, doubled quotes inside quoted text.
_CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def landing_folder(landing_root: str, seq: int) -> str:
    """The folder of delivery number ``seq``."""
    return f"{landing_root.rstrip('/')}/b{seq:06d}"


def write_landing(df: DataFrame, landing_root: str, seq: int, compression: str = "gzip") -> str:
    """Deliver ``df`` as header CSV files (gzip by default) into a new folder.

    Each Spark task writes its own file, so a large delivery is written in
    parallel and read back in parallel: a gzip file cannot be split, so a
    delivery should be many moderate files, never one huge ``.csv.gz``.  ``errorifexists``: a delivery folder is never rewritten (a
    rewritten file would not be re-read by the pipe anyway).
    """
    path = landing_folder(landing_root, seq)
    (df.write.mode("errorifexists").options(**_CSV_OPTIONS)
       .option("compression", compression).csv(path))
    return path


def _landing_glob(landing_root: str) -> str:
    # Delivery folders only; in-progress task output under _temporary does not match.
    return f"{landing_root.rstrip('/')}/b*/part-*"


def with_origin(df: DataFrame) -> DataFrame:
    """Adds each row's file and the number of the delivery it came in."""
    path = F.col("_metadata.file_path")
    return df.select("*", path.alias(SOURCE_FILE), F.regexp_extract(path, r"/b(\d+)/[^/]*$", 1).cast("long").alias(DELIVERY))


def read_csv(spark: SparkSession, path: str, schema: T.StructType = PEDIDOS_CSV_SCHEMA) -> DataFrame:
    """A3: batch read of delimited files with a declared schema (no inference).

    Compressed files are decoded by extension; quoted text keeps embedded
    commas and doubled quotes.
    """
    return spark.read.schema(schema).options(**_CSV_OPTIONS).csv(path)


def read_landing(spark: SparkSession, landing_root: str,
                 schema: T.StructType = PEDIDOS_CSV_SCHEMA) -> DataFrame:
    """All delivered files as one batch DataFrame, with each row's origin."""
    return with_origin(read_csv(spark, _landing_glob(landing_root), schema))


def pipe_schema(schema: T.StructType = PEDIDOS_CSV_SCHEMA) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(SOURCE_FILE, T.StringType()), T.StructField(DELIVERY, T.LongType())])


class FilePipe:
    """A4: continuous load of landed CSV files into a Parquet table, each file once."""

    def __init__(self, spark: SparkSession, landing_root: str, target: str, checkpoint: str,
                 schema: T.StructType = PEDIDOS_CSV_SCHEMA, max_files_per_trigger: int = 1000,
                 archive_dir: str | None = None):
        """``archive_dir``: move each loaded file there (Spark's ``cleanSource``), so
        the landing folder the source lists every trigger holds only new files."""
        self.spark = spark
        self.landing_root = landing_root
        self.target = target
        self.checkpoint = checkpoint
        self.schema = schema
        self.max_files_per_trigger = max_files_per_trigger
        self.archive_dir = archive_dir

    def source(self) -> DataFrame:
        reader = (self.spark.readStream.schema(self.schema).options(**_CSV_OPTIONS)
                  .option("maxFilesPerTrigger", self.max_files_per_trigger))
        if self.archive_dir:
            reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", self.archive_dir)
        return with_origin(reader.csv(_landing_glob(self.landing_root)))

    def run(self) -> int:
        """Load everything waiting, then stop; returns the rows that the table gained.

        Counted in the committed table before and after (Parquet footers only),
        since a query's progress list keeps just its last updates.
        """
        before = self._rows()
        (self.source().writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", self.checkpoint)
         .trigger(availableNow=True).start(self.target).awaitTermination())
        return self._rows() - before

    def _rows(self) -> int:
        return self.table().count() if exists(self.spark, self.target) else 0

    def table(self) -> DataFrame:
        """The loaded table (batch read; only committed files are visible)."""
        return self.spark.read.schema(pipe_schema(self.schema)).parquet(self.target)
