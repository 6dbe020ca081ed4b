"""Operator 9: secret scan by sliding-window Shannon entropy.

Candidate strings are runs of key characters.  A window slides over each; its
character counts are updated by one character in and one out, so the entropy
of every window costs constant time.  Windows above the threshold of their
character class are joined into a span of kind ``entropy``, unless the
allow-list names the candidate (whole-match patterns or exact strings).  A run of
letters is a class of its own, and words joined by signs are judged word by
word.  A candidate shorter than the window is one window, if it has letters and
digits and no signs, judged by the share of the most bits that its length allows.
Fixed-form secrets (assignments, access keys, long hexadecimal runs) are found
by pattern and always stay; an entropy span inside one of them is not repeated.

Defined results: NULL and empty texts have no spans; offsets are code points,
ends exclusive; long texts are read whole; repeated rows give repeated results and
an empty table an empty one; other columns are kept by
``find_secrets``, except that a column named ``secrets`` is replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import BATCH_ROWS
from tierflow.llm.spans import SPAN_TYPE

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "entropy")

ASSIGN = re.compile(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
# a run fails unless it is this long, and no shorter run of it could pass
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
LONG_RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")

WINDOW = 20
#: Least bits per character over a window, by class; the most possible are 4 and log2(20) = 4.32.
BITS = {"hex": 3.0, "mixed": 3.8, "letters": 3.9}
#: Of the bits that a shorter candidate's length allows.
SHORT = 0.92
#: Whole candidates that are never secrets: numbers, UUIDs, rules.
ALLOW = (r"[0-9]+", r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", r"[/_=+-]+", r"[0-9]+([/_=-][0-9]+)*")
WORDS = re.compile(r"[A-Za-z]+(?:[/_=-]+[A-Za-z]+)*[/_=-]*")
LETTERS = re.compile(r"[A-Za-z]+")


def entropy_spans(text: str, window: int = WINDOW, bits: dict | None = None,
                  allow: re.Pattern | None = None, allowed: frozenset = frozenset()) -> Iterator[tuple[int, int]]:
    bits = bits or BITS
    for m in LONG_RUN.finditer(text):
        s = m.group()
        if s in allowed or (allow and allow.fullmatch(s)):
            continue
        if WORDS.fullmatch(s) and not re.fullmatch(r"[a-fA-F]+", s):
            parts = [(w.start(), w.group(), bits["letters"]) for w in LETTERS.finditer(s) if w.group() not in allowed]
        else:
            parts = [(0, s, bits["hex"] if re.fullmatch(r"[0-9a-fA-F]+", s) else bits["mixed"])]
        for at, part, least in parts:
            size = min(window, len(part))
            if size < window:
                if not (part.isalnum() and re.search("[0-9]", part) and re.search("[A-Za-z]", part)):
                    continue
                least = SHORT * math.log2(size)
            yield from ((m.start() + at + a, m.start() + at + b) for a, b in hot_windows(part, size, least))


def hot_windows(s: str, window: int, least: float) -> Iterator[tuple[int, int]]:
    """Unions of the windows of ``s`` whose entropy reaches ``least`` bits."""
    clog = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    count: dict[str, int] = {}
    total, begin, end = 0.0, -1, -1  # total = sum of c log2 c over the window's characters
    for i, new in enumerate(s):
        c = count.get(new, 0)
        total += clog[c + 1] - clog[c] if c < window else 0.0
        count[new] = c + 1
        if i >= window:
            old = s[i - window]
            c = count[old]
            total += clog[c - 1] - clog[min(c, window)]
            count[old] = c - 1
        if i >= window - 1 and math.log2(window) - total / window >= least - 1e-9:
            start = i - window + 1
            if begin < 0 or start > end:
                if begin >= 0:
                    yield begin, end
                begin = start
            end = i + 1
    if begin >= 0:
        yield begin, end


def secrets_of(text: str | None, allow: re.Pattern, allowed: frozenset) -> list[dict]:
    if not text:
        return []
    found = []
    if ":" in text or "=" in text:
        found += [("assign", m.start(), m.end(), True) for m in ASSIGN.finditer(text) if len(m.group(1)) >= 12]
    if max(map(len, text.split()), default=0) >= 16 or found:
        found += [("access", m.start(), m.end(), True) for m in ACCESS.finditer(text)] if "AKIA" in text else []
        found += [("hex", m.start(), m.end(), True) for m in HEX.finditer(text)]
        base = [(s, e) for _, s, e, _ in found]
        found += [("entropy", s, e, False) for s, e in entropy_spans(text, allow=allow, allowed=allowed)
                  if not any(a <= s and e <= b for a, b in base)]
    found.sort(key=lambda f: (f[1], KINDS.index(f[0])))
    return [{"kind": k, "start": s, "end": e, "base": b} for k, s, e, b in found]


def find_secrets(documents: DataFrame, allow: tuple = ALLOW, allowed: frozenset = frozenset()) -> DataFrame:
    """``documents`` with ``secrets``: array of (kind, start, end, base), by start and kind."""
    allow_all = re.compile("|".join(f"(?:{p})" for p in allow), re.A) if allow else re.compile(r"(?!)")
    documents.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    @F.pandas_udf(SPAN_TYPE)
    def scan(texts: pd.Series) -> pd.Series:
        return pd.Series([secrets_of(t, allow_all, allowed) for t in texts])

    return documents.withColumn("secrets", scan(F.col("text").cast("string")))
