"""Parquet tables: full refresh, stamped batches, and keyed tables in buckets.

Plain folders of Parquet, written and read by Spark; there is no log and no
list of files.

* ``Table``: each full refresh writes a new folder; the newest finished one is
  the table, the one before it stays until the next refresh (its readers may
  still be running).
* ``BatchTable``: one partition folder per batch.  Writing a batch replaces
  that batch's partition only (dynamic partition overwrite), so a load that is
  run again after a failure leaves one copy.
* ``KeyedTable``: rows are stored by ``pmod(xxhash64(key), buckets)``.  An
  upsert reads, merges and replaces the buckets that the batch touches.  Each
  full refresh chooses the bucket count from the row count and keeps it with the
  table; a merge that finds the buckets outgrown refreshes the table.  Opening it
  with another key, or another chosen count, raises.

Two writers of one table need a lock of the storage system or scheduler;
nothing here pretends to be one.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.session import stage

BUCKET = "_bucket"
#: Rows per bucket that the first write of a keyed table aims at.
BUCKET_ROWS = 1_000_000
LEAST_BUCKETS = 16


class LayoutMismatch(ValueError):
    """A keyed table was opened with another key or bucket count than it was written with."""


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path`` (one per refresh or batch)."""
    fs, p = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def bucket_of(key_cols, buckets: int) -> Column:
    cols = [F.col(k) for k in ([key_cols] if isinstance(key_cols, str) else key_cols)]
    return F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int")


class Table:
    """A10: a table that is replaced as a whole."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _refreshes(self) -> list[int]:
        names = (re.fullmatch(r"refresh-(\d+)", n) for n in folders(self.spark, self.root))
        return sorted(n for m in names if m and exists(self.spark, f"{self._folder(n := int(m[1]))}/_SUCCESS"))

    def _folder(self, n: int) -> str:
        return f"{self.root}/refresh-{n}"

    def current(self) -> str | None:
        done = self._refreshes()
        return self._folder(done[-1]) if done else None

    def exists(self) -> bool:
        return bool(self._refreshes())

    def read(self) -> DataFrame:
        folder = self.current()
        if folder is None:
            raise FileNotFoundError(f"no table at {self.root}")
        return self.spark.read.parquet(folder)

    def overwrite(self, df: DataFrame) -> None:
        """The table is exactly ``df``, which may read the table itself."""
        done = self._refreshes()
        n = done[-1] + 1 if done else 0
        # an unfinished folder of that number is what a failed refresh left
        df.write.mode("overwrite").parquet(self._folder(n))
        for old in done[:-1]:
            remove(self.spark, self._folder(old))


class BatchTable:
    """A5: append-only batches, one partition folder each."""

    def __init__(self, spark: SparkSession, root: str, by: tuple[str, ...] = ("_batch_id",)):
        self.spark = spark
        self.root = root.rstrip("/")
        self.by = by

    def batches(self) -> list[int]:
        """The numbers of the stored batches, from the folder names."""
        marks = (re.fullmatch(rf"{self.by[0]}=(\d+)", n) for n in folders(self.spark, self.root))
        return sorted(int(m[1]) for m in marks if m)

    def exists(self) -> bool:
        return any(n.startswith(f"{self.by[0]}=") for n in folders(self.spark, self.root))

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        """All batches; ``schema``, if given, keeps Spark from guessing the batch columns' types from folder names."""
        if schema is None:
            return self.spark.read.parquet(self.root)
        return self.spark.read.schema(schema).parquet(self.root).select(*schema.fieldNames())

    def write(self, df: DataFrame) -> None:
        """Store the batches that ``df`` holds; a batch stored before is replaced.  NULL is a batch of its own."""
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*self.by).parquet(self.root)


class KeyedTable(Table):
    """One row per key, in buckets by key."""

    def __init__(self, spark: SparkSession, root: str, key, buckets: int | None = None):
        super().__init__(spark, root)
        self.keys = [key] if isinstance(key, str) else list(key)
        self._wanted = buckets
        self._layout: tuple[str, dict] | None = None
        self.layout()

    def _refreshes(self) -> list[int]:
        return [n for n in super()._refreshes() if exists(self.spark, f"{self._folder(n)}/_layout/_SUCCESS")]

    def layout(self) -> dict | None:
        """Key, bucket count and schema, as the refresh that wrote the table recorded them."""
        folder = self.current()
        if folder is None:
            return None
        if self._layout is None or self._layout[0] != folder:
            kept = json.loads("".join(r["value"] for r in self.spark.read.text(f"{folder}/_layout").collect()))
            if kept["key"] != self.keys or self._wanted not in (None, kept["buckets"]):
                raise LayoutMismatch(f"{self.root} has key {kept['key']} in {kept['buckets']} buckets, "
                                     f"not {self.keys} in {self._wanted}")
            self._layout = (folder, kept)
        return self._layout[1]

    @property
    def buckets(self) -> int:
        return self.layout()["buckets"]

    def schema(self) -> T.StructType:
        return T.StructType.fromJson(self.layout()["schema"])

    def _write(self, df: DataFrame, folder: str, partitions: str, buckets: int) -> None:
        # rebalance: Spark splits a bucket that is larger than a task should write, and joins small ones
        (df.withColumn(BUCKET, bucket_of(self.keys, buckets)).hint("rebalance", BUCKET)
           .sortWithinPartitions(BUCKET, *self.keys)
           .write.mode("overwrite").option("partitionOverwriteMode", partitions).partitionBy(BUCKET).parquet(folder))

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        folder = self.current()
        if folder is None:
            raise FileNotFoundError(f"no table at {self.root}")
        fields = [*self.schema().fields, T.StructField(BUCKET, T.IntegerType())]
        df = self.spark.read.schema(T.StructType(fields)).parquet(folder)
        if buckets is not None:
            df = df.where(F.col(BUCKET).isin(buckets))
        return df.drop(BUCKET)

    def overwrite(self, df: DataFrame) -> None:
        """The table is exactly ``df``, in as many buckets as its rows ask for."""
        done = self._refreshes()
        folder = self._folder(done[-1] + 1 if done else 0)
        if done:
            df = df.select(*self.schema().fieldNames())
        buckets = self._wanted or max(LEAST_BUCKETS, -(-df.count() // BUCKET_ROWS))
        self._write(df, folder, "static", buckets)
        # the refresh counts once its layout is there
        text = json.dumps({"key": self.keys, "buckets": buckets, "schema": json.loads(df.schema.json())})
        line = self.spark.range(1).select(F.lit(text).alias("value"))
        line.coalesce(1).write.mode("overwrite").text(f"{folder}/_layout")
        for old in done[:-1]:
            remove(self.spark, self._folder(old))

    def regrow(self, rows: float) -> None:
        """Lays the table out anew when its buckets hold over twice the rows they aim at; a chosen count stays."""
        if not self._wanted and rows > 2 * BUCKET_ROWS:
            self.overwrite(self.read())

    def replace_buckets(self, df: DataFrame, staged: bool = False) -> None:
        """Replace exactly the buckets that ``df`` has rows of; ``df`` may read the table unless it is staged."""
        df = df.select(*self.schema().fieldNames())
        self._write(df if staged else stage(df, "buckets"), self.current(), "dynamic", self.buckets)
