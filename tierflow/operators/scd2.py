"""Version history (SCD type 2) and its rebuild from a change log.

``version_changes`` is one run as a function of two frames: the source snapshot,
left-joined to the open rows, gives the versions that open and those they
close.  ``Scd2Table`` applies it to storage: the open rows are a ``KeyedTable``
(one row per key, ``valid_to`` NULL) of which a run rewrites the buckets that
hold a changed key, and each run's closed versions are a partition of their
own that no later run reads.

Timestamp strategy (default): a source row opens a version when its key has no
open row, or when its ``updated_at`` is later than the open row's ``valid_from``;
the old row is closed at ``updated_at``.  Check strategy (``check_cols``): a later
row opens a version only when a tracked column differs (NULL-safe).  Keys
missing from the snapshot stay open.  Rows with a NULL key have no history and
are left out; a key that comes twice in one snapshot raises.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.operators.merge import assert_unique_keys, merge_upsert
from tierflow.operators.ranges import PART, following, inside, ordered_ranges
from tierflow.session import stage
from tierflow.sources.storage import BatchTable, KeyedTable

VALID_FROM, VALID_TO, HASH = "valid_from", "valid_to", "version_hash"
RUN = "_run"


def version_hash(key: str, ts: str):
    """Stable id of a version: sha256 of ``key|updated_at`` as text."""
    return F.sha2(F.concat_ws("|", F.col(key).cast("string"), F.col(ts).cast("string")), 256)


def as_versions(src: DataFrame, key: str, updated_at: str) -> DataFrame:
    cols = [c for c in src.columns if c != updated_at]
    return src.select(*cols, F.col(updated_at).alias(VALID_FROM),
                      F.lit(None).cast(src.schema[updated_at].dataType).alias(VALID_TO),
                      version_hash(key, updated_at).alias(HASH))


def version_changes(open_rows: DataFrame, incoming: DataFrame, key: str, check_cols: list[str] | None = None) -> DataFrame:
    """Rows (new, old): each version that opens, with the open row it closes (NULL for a new key).

    A left join from the snapshot: open rows without a snapshot row are not
    part of the result and need not be shuffled when Spark broadcasts the
    snapshot or filters by its keys at run time.
    """
    new = incoming.select(F.col(key).alias("_key"), F.struct(*incoming.columns).alias("new"))
    old = open_rows.select(F.col(key).alias("_key"), F.struct(*incoming.columns).alias("old"))
    newer = F.col(f"new.{VALID_FROM}") > F.col(f"old.{VALID_FROM}")
    if check_cols:
        same = [F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}")) for c in check_cols]
        newer = newer & ~reduce(lambda a, b: a & b, same)
    return new.join(old, "_key", "left").where(F.col("old").isNull() | newer).select("new", "old")


class Scd2Table:
    """History in two parts: ``open`` (keyed buckets) and ``closed`` (one partition per run)."""

    def __init__(self, spark: SparkSession, root: str, key: str, updated_at: str = "_inserted_at",
                 check_cols: list[str] | None = None, buckets: int | None = None):
        self.spark = spark
        self.key = key
        self.updated_at = updated_at
        self.check_cols = list(check_cols) if check_cols else None
        self.open = KeyedTable(spark, f"{root}/open", key, buckets)
        self.closed = BatchTable(spark, f"{root}/closed", by=(RUN,))

    def exists(self) -> bool:
        return self.open.exists()

    def apply(self, snapshot: DataFrame) -> None:
        """Fold one source snapshot (at most one row per key) into the history.

        The closed versions go to a partition named by their content before
        the open rows change.  A run that failed in between is repeated with
        the same snapshot: it closes the same versions into the same
        partition.
        """
        incoming = stage(as_versions(snapshot.where(F.col(self.key).isNotNull()), self.key, self.updated_at), "scd2-snapshot")
        assert_unique_keys(incoming, self.key)
        if not self.open.exists():
            self.open.overwrite(incoming)
            return
        changes = stage(version_changes(self.open.read(), incoming, self.key, self.check_cols), "scd2-changes")
        closing = changes.where(F.col("old").isNotNull())
        run = closing.agg(F.sum(F.xxhash64(f"old.{HASH}", f"new.{HASH}").cast("decimal(38,0)")).alias("s")).first()["s"]
        if run is not None:
            cols = [F.col(f"new.{VALID_FROM}").alias(c) if c == VALID_TO else F.col(f"old.{c}").alias(c) for c in incoming.columns]
            # a partition per run: the sum of its version hashes, shifted above zero
            self.closed.write(closing.select(*cols, F.lit(str(int(run) + 10**30)).alias(RUN)))
        merge_upsert(self.open, changes.select("new.*"), ["-" + VALID_FROM], check_unique=False)

    def history(self) -> DataFrame:
        now = self.open.read()
        if not self.closed.exists():
            return now
        return self.closed.read().select(*now.columns).unionByName(now)


def history_from_changes(changes: DataFrame, key: str, updated_at: str) -> DataFrame:
    """One-shot history from a full change log: ``valid_to = lead(updated_at)``.

    The batch equivalent of folding every snapshot through ``Scd2Table``.  The
    lead runs over ranges of (key, time); each range's last row takes the first
    row of the next, so no key's history is one task's work.
    """
    order = ["_k", VALID_FROM, HASH]
    rows = as_versions(changes, key, updated_at).withColumn("_k", F.col(key))
    ranges = ordered_ranges(rows, order, "scd2-rebuild")
    after = F.struct(F.col("_k").alias("k"), F.col(VALID_FROM).alias("t"))
    out = ranges.withColumn("_lead", F.lead(after).over(inside(order))).join(following(ranges, after, order), PART, "left")
    later = F.coalesce("_lead", "_next")
    same = later["k"].eqNullSafe(F.col("_k"))
    return out.withColumn(VALID_TO, F.when(same, later["t"])).select(*[c for c in rows.columns if c != "_k"])
