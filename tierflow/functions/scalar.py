"""Scalar expressions: safe casts, text normalisation, JSON paths.

All of them are built-in Catalyst expressions, so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- C7 / B2: safe casts: a value that does not parse becomes NULL -----------

def safe_int(c) -> Column:
    return col_of(c).try_cast("int")


def safe_decimal(c, precision: int = 10, scale: int = 2) -> Column:
    return col_of(c).try_cast(f"decimal({precision},{scale})")


def safe_date(c) -> Column:
    return col_of(c).try_cast("date")


# --- C1 / C2: text normalisation ---------------------------------------------

def clean_text(c) -> Column:
    return F.trim(col_of(c))


def norm_key(c) -> Column:
    """Case- and blank-insensitive business key (``lower(trim(x))``)."""
    return F.lower(F.trim(col_of(c)))


# --- C4 / C5: dates ------------------------------------------------------------

def as_of(as_of_date=None) -> Column:
    """The run's "today": a pinned literal when given, else ``current_date()``."""
    if as_of_date is None:
        return F.current_date()
    if isinstance(as_of_date, str):
        as_of_date = _dt.date.fromisoformat(as_of_date)
    return F.lit(as_of_date)


def ntz_literal(value) -> Column:
    """A ``timestamp_ntz`` literal from a naive ``datetime``, built from text.

    ``F.lit(datetime)`` makes a *zoned* timestamp from the Python process's
    zone, which is then shifted by the session zone when compared with a
    ``timestamp_ntz`` column; text has no zone, so the value is exact under
    any session or system time zone.
    """
    if isinstance(value, _dt.datetime):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)


def days_between(start, end) -> Column:
    """Whole days from ``start`` to ``end`` as bigint."""
    return F.datediff(col_of(end), col_of(start)).cast("bigint")


# --- C8-C11: semi-structured attributes ---------------------------------------

def parse_json_safe(c) -> Column:
    """C11: JSON text -> VARIANT; malformed text becomes NULL."""
    return F.try_parse_json(col_of(c))


def json_field(variant, key: str, type_name: str = "string") -> Column:
    """``v:key::type``; missing key, JSON null or wrong type -> NULL."""
    return F.try_variant_get(col_of(variant), f"$.{key}", type_name)


# --- C13: pattern ----------------------------------------------------------------

# Fixed value: the email format rule of the data tests.
EMAIL_REGEX = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"


def matches(c, pattern: str) -> Column:
    return col_of(c).rlike(pattern)
