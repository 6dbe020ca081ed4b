"""Span arrays: their type and the digest columns that queries derive from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN_TYPE = "array<struct<kind:string,start:int,end:int,base:boolean>>"


def joined(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined in the array's order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(spans: Column, base_kinds: tuple) -> list[Column]:
    """Counts of base spans by kind, their sha256, and all spans as text."""
    base = F.filter(spans, lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in base_kinds]
    return [*counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(spans).alias("spans")]
