"""Session settings and the shared work folder.

Settings that matter at scale:
* AQE on: runtime partition coalescing, skew-join splitting and runtime
  broadcast conversion based on *measured* shuffle sizes.
* UTC session zone; all timestamps in the data model are ``timestamp_ntz``.
* ``spark.sql.files.maxPartitionBytes`` left at a size that keeps a scan task
  well inside executor memory (128 MB default).

Work folders (tables, CSV landing zones, stream checkpoints) live under the
shared folder named by ``spark.checkpoint.dir``.  A cluster must set it; only a
local session gets a temporary one.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

_DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tierflow", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(_DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and work tables, from ``spark.checkpoint.dir``.

    Only a session on this machine may go without: it gets a temporary folder
    that is removed when Python ends.  On a cluster, executors would write to
    their own disks, so a missing setting raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tierflow-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark)
    return f"{root}/tierflow/{name}-{uuid.uuid4().hex[:12]}"


def stage(df, name: str = "stage"):
    """Cut lineage: write ``df`` once as Parquet in the shared work folder, read it back.

    Unlike ``DataFrame.checkpoint`` (which runs the plan for the job and again
    to save it unless cached), the plan runs exactly once; a lost executor
    afterwards re-reads files instead of recomputing upstream stages.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def empty_frame(spark: SparkSession, schema):
    """An empty DataFrame of ``schema``, planned on the JVM (no Python rows)."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
