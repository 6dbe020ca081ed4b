"""Operator 6: personal data by weak-supervision aggregation.

Candidate spans come from patterns.  Six labelers vote on each (+1 personal,
-1 not, 0 abstains): the pattern's own validity, gazetteers, cue words before
it, counter-cues before it, its borders, and the variety of its characters.
Expectation-maximisation over the counts of vote patterns estimates how
reliable each labeler is; its posteriors are the soft labels on which a
logistic span classifier (kind, votes, length) is trained.  Spans of fixed form
always stay; the classifier decides about all other candidates.

Everything that touches rows is a DataFrame expression.  Only the counts of
vote patterns reach the driver: at most kinds x 3^6 x 3 narrow rows.

Spans are placed without a regular-expression position function: the pieces
between matches and the matches themselves give each start as a running sum of
lengths, in code points.

Defined results: a NULL text counts as empty and has no spans; repeated rows
give repeated results; an empty table gives an empty result; other columns are
kept by ``find_pii``, except that a column named ``pii`` is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import text_or_empty
from tierflow.session import stage

BASE_KINDS = ("email", "ip", "card", "phone")
EXTRA_KINDS = ("localphone", "idnumber", "iban", "person")
KINDS = BASE_KINDS + EXTRA_KINDS
LABELERS = ("form", "gazetteer", "cue", "counter", "border", "variety")

# Possessive forms of the contract's patterns, which cannot backtrack or nest deeply.
# A card chain of under 12 digits fails in any case, so shorter ones need not match.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9]){11,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "localphone": r"(?<![0-9+(])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "idnumber": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}+(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "person": r"(?<!\p{L})(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Señor|Señora)\.? \p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)?",
}
#: What a text must contain for a pattern to be tried; all but ``person`` need a digit or an @.
HINTS = {"email": "@", "phone": "+"}

CUES = r"(?i)(e-?mail|mail|contact|call|phone|tel|mobile|fax|card|visa|iban|account|konto|ssn|social security|address|ip|host|write to|from)\W*$"
COUNTERS = r"(?i)(version|v\.|page|p\.|order|invoice|isbn|issn|chapter|section|figure|fig\.|model|part|serial|lot|build|§|no\.|nr\.)\W*$"
#: Common mail ends, country codes, card issuers' first digits, country letters of account numbers.
GAZETTEER = {
    "email": r"(?i)\.(com|org|net|edu|gov|io|de|fr|es|it|nl|uk|us|ca|eu|info|biz)$",
    "ip": r"^(?!0|10\.|127\.|169\.254\.|192\.168\.|22[4-9]\.|2[3-5][0-9]\.)",
    "card": r"^(4|5[1-5]|2[2-7]|3[47]|6011|65)",
    "phone": r"^\+(1|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])",
    "localphone": r"^\(?[2-9]",
    "idnumber": r"^(?!000|666|9)",
    "iban": r"^(AT|BE|CH|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)",
    "person": r" ",
}
NEAR = 40


def valid(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(digits)
    if kind == "ip":
        return m.rlike(r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$")
    if kind == "card":
        def add(total: Column, i: Column) -> Column:
            d = F.substring(digits, n - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
            return total + F.when(d > 9, d - 9).otherwise(d)

        luhn = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0
        return F.when(n.between(12, 19), luhn).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def sign(good: Column, bad: Column | None = None) -> Column:
    """+1 where good, -1 where bad (default: where not good), else 0."""
    bad = ~good if bad is None else bad
    return F.when(good, 1).when(bad, -1).otherwise(0).cast("byte")


def candidates(text: Column, matches: Column, kind: str) -> Column:
    """Array of (start, kind, end, ok, votes, size) for one kind, in text order."""
    pieces = F.split(text, PATTERNS[kind], -1)
    k = F.size(matches)

    def place(acc: Column, i: Column) -> Column:
        start = acc["at"] + F.length(F.get(pieces, i))
        return F.struct((start + F.length(F.get(matches, i))).alias("at"), F.concat(acc["starts"], F.array(start)).alias("starts"))

    starts = F.aggregate(F.sequence(F.lit(0), k - 1), F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
                         place, lambda a: a["starts"])
    zipped = F.arrays_zip(matches.alias("m"), starts.alias("s"), pieces.alias("before"), F.slice(pieces, F.lit(2), k).alias("after"))

    def judge(c: Column) -> Column:
        m, before, after = c["m"], F.substring(c["before"], -NEAR, NEAR), F.substring(c["after"], 1, 1)
        ok = valid(kind, m)
        glued = before.rlike(r"[\p{L}0-9_]$") | after.rlike(r"^[\p{L}0-9_]")
        kinds = F.size(F.array_distinct(F.split(F.regexp_replace(m, "[^A-Za-z0-9]", ""), "")))
        votes = F.array(sign(ok), sign(m.rlike(GAZETTEER[kind])), sign(before.rlike(CUES), F.lit(False)),
                        sign(F.lit(False), before.rlike(COUNTERS)), sign(~glued), sign(kinds >= 4))
        size = F.when(F.length(m) < 12, 0).when(F.length(m) < 18, 1).otherwise(2)
        return F.struct(c["s"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (c["s"] + F.length(m)).alias("end"),
                        ok.alias("ok"), votes.alias("votes"), size.alias("size"))

    # arrays_zip pads to the longest; pieces has one more than matches
    return F.when(k > 0, F.transform(F.slice(zipped, F.lit(1), k), judge))


def extract(documents: DataFrame) -> DataFrame:
    """Adds ``_w_cands``: all candidate spans of a row that no base span overlaps, and the base spans."""
    doc = documents.withColumn("_w_text", text_or_empty())
    for kind in KINDS:
        text = F.col("_w_text")
        found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
        if kind in HINTS:
            found = F.when(F.contains(text, F.lit(HINTS[kind])), found).otherwise(F.array().cast("array<string>"))
        doc = doc.withColumn(f"_w_m_{kind}", found)
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,ok:boolean,votes:array<tinyint>,size:int>>")
    for kind in KINDS:
        doc = doc.withColumn(f"_w_c_{kind}", F.coalesce(candidates(F.col("_w_text"), F.col(f"_w_m_{kind}"), kind), empty))
    every = F.concat(*[F.col(f"_w_c_{kind}") for kind in KINDS])
    doc = doc.withColumn("_w_all", every)
    base = F.filter("_w_all", is_base)
    free = F.filter("_w_all", lambda c: ~is_base(c) & ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    return (doc.withColumn("_w_cands", F.when(F.size("_w_all") > 0, F.array_sort(F.concat(base, free))).otherwise(empty))
            .drop("_w_text", "_w_all", *[f"_w_m_{k}" for k in KINDS], *[f"_w_c_{k}" for k in KINDS]))


def is_base(c: Column) -> Column:
    return (c["kind"] < len(BASE_KINDS)) & c["ok"]


def reliabilities(cells: list[tuple[int, tuple, int, int]], rounds: int = 30) -> tuple[float, list[list[list[float]]]]:
    """EM over (kind, votes, size, count) cells: the prior and P(vote of labeler | class).

    The start trusts every labeler a little; votes are smoothed by one count.
    """
    prior = 0.5
    rates = [[[0.5, 0.3, 0.2], [0.2, 0.3, 0.5]] for _ in LABELERS]  # [class 0, class 1] x vote -1, 0, 1
    for _ in range(rounds):
        sums = [[[1.0] * 3 for _ in range(2)] for _ in LABELERS]
        ones, total = 1.0, 2.0
        for _, votes, _, n in cells:
            p = posterior(votes, prior, rates)
            ones, total = ones + n * p, total + n
            for j, v in enumerate(votes):
                sums[j][0][v + 1] += n * (1 - p)
                sums[j][1][v + 1] += n * p
        prior = ones / total
        rates = [[[x / sum(row) for x in row] for row in s] for s in sums]
    return prior, rates


def posterior(votes: tuple, prior: float, rates: list) -> float:
    odds = math.log(prior / (1 - prior)) + sum(math.log(r[1][v + 1] / r[0][v + 1]) for v, r in zip(votes, rates, strict=True))
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, odds))))


def span_features(kind: int, votes: tuple, size: int) -> list[tuple[str, int]]:
    return [("kind", kind), ("size", size), *((name, v) for name, v in zip(LABELERS, votes, strict=True) if v)]


def span_classifier(cells: list, prior: float, rates: list, steps: int = 200, l2: float = 0.01) -> tuple[float, dict]:
    """Logistic weights per (feature, value), fitted to the posteriors of the cells."""
    total = sum(n for *_, n in cells) or 1
    rows = [(span_features(k, v, s), posterior(v, prior, rates), n / total) for k, v, s, n in cells]
    bias, w = 0.0, {}
    for _ in range(steps):
        g0, g = 0.0, {f: l2 * x for f, x in w.items()}
        for feats, p, share in rows:
            out = bias + sum(w.get(f, 0.0) for f in feats)
            d = share * (1 / (1 + math.exp(-max(-30.0, min(30.0, out)))) - p)
            g0 += d
            for f in feats:
                g[f] = g.get(f, 0.0) + d
        bias -= 2 * g0
        for f, x in g.items():
            w[f] = w.get(f, 0.0) - 2 * x
    return bias, w


def find_pii(documents: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``documents`` (or its columns ``keep``) with ``pii``: array of (kind, start, end, base)."""
    keep = [c for c in (keep or documents.columns) if c != "pii"]
    found = stage(extract(documents).select(*keep, "_w_cands"), "pii-candidates")
    one = found.select(F.explode("_w_cands").alias("c"))
    cells = sorted((r["kind"], tuple(r["votes"]), r["size"], r["n"]) for r in one.groupBy(
        F.col("c.kind").alias("kind"), F.col("c.votes").alias("votes"), F.col("c.size").alias("size")).agg(F.count(F.lit(1)).alias("n")).collect())
    prior, rates = reliabilities(cells)
    bias, w = span_classifier(cells, prior, rates)

    def logit(c: Column) -> Column:
        parts = {"kind": c["kind"], "size": c["size"], **{name: F.get(c["votes"], F.lit(j)) for j, name in enumerate(LABELERS)}}
        out = F.lit(bias)
        for (name, value), x in sorted(w.items()):
            out = out + F.when(parts[name] == value, F.lit(x)).otherwise(F.lit(0.0))
        return out

    name = F.array(*[F.lit(k) for k in KINDS])
    kept = F.filter("_w_cands", lambda c: is_base(c) | (logit(c) >= 0))
    spans = F.transform(kept, lambda c: F.struct(F.get(name, c["kind"]).alias("kind"), c["start"].alias("start"),
                                                 c["end"].alias("end"), is_base(c).alias("base")))
    return found.select(*keep, spans.alias("pii"))
