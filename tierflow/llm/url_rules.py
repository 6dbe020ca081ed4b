"""Operator 1: URL filter by association rules.

Stated rules (host and path, longest wins) judge a url first.  Their verdicts
are the labels of a market basket: every labelled url is the set of its tokens
plus its verdict, Spark's FP-growth mines the frequent sets, and those rules
``tokens -> verdict`` that have enough support and confidence, and more
confidence than every rule over fewer of the same tokens, judge the urls that no
stated rule fits.  An inverted index (token -> rules whose rarest token it is)
finds a url's rules; of the matching ones the most confident wins, then the
better supported, then the longer, then block.

A url has at most one token per field of ``tokens``, so a url has under 2^10
token sets and the number of mined sets is at most 2^10 / MIN_SUPPORT whatever
the size of the table; the mined rules are a constant of the plan.

Defined results: a NULL url or one without ``://`` has an empty host and path,
no rule and the default verdict; repeated rows give repeated results; without
labelled urls every other url gets the default verdict ("allow").
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.8
DEFAULT = "allow"
VERDICTS = ("allow", "block")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str


#: The stated rules of the query.
RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
         Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def stated(rules: tuple, host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting stated rule, else NULLs."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.host + r.path), r.host + r.path)):  # the longest is asked first
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        name, verdict = F.when(fits, r.host + r.path).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def tokens(url: Column, host: Column, path: Column) -> Column:
    """At most ten tokens of a url, one per field."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    last = F.coalesce(F.get(parts, F.size(parts) - 1), F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)

    def token(name: str, value: Column, there: Column) -> Column:
        return F.when(there, F.concat(F.lit(name + "="), value))

    found = F.array(
        token("top", F.get(labels, n - 1), host != ""),
        token("site", F.concat_ws(".", F.get(labels, n - 2), F.get(labels, n - 1)), n > 1),
        token("name", F.get(labels, n - 3), n > 2),
        token("sub", F.get(labels, F.lit(0)), n > 3),
        token("first", F.get(parts, F.lit(0)), F.size(parts) > 0),
        token("second", F.get(parts, F.lit(1)), (F.size(parts) > 2) & ~F.get(parts, F.lit(1)).rlike("[0-9]")),
        token("end", F.regexp_extract(last, r"(\.[A-Za-z0-9]+)$", 1), last.rlike(r"\.[A-Za-z0-9]+$")),
        token("key", F.regexp_extract(query, r"^([^=&]+)", 1), query != ""),
        token("words", F.array_join(F.slice(F.split(F.get(labels, n - 3), "-"), 1, 2), "-"), (n > 2) & F.contains(host, F.lit("-"))),
        token("scheme", F.lower(F.substring_index(url, "://", 1)), host != ""))
    return F.array_distinct(F.filter(found, lambda t: t.isNotNull()))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> list[dict]:
    """Pruned rules from rows (tokens, verdict): dicts of tokens, verdict, confidence, support."""
    items = labelled.select(F.concat("tokens", F.array(F.concat(F.lit("verdict="), F.col("verdict")))).alias("items"))
    total = items.count()
    if not total:
        return []
    sets = FPGrowth(itemsCol="items", minSupport=min_support).fit(items).freqItemsets
    count = {frozenset(r["items"]): r["freq"] for r in sets.collect()}
    rules: dict[tuple, dict] = {}
    for s, n in count.items():
        for v in VERDICTS:
            body = s - {f"verdict={v}"}
            if len(body) == len(s) or not body or any(t.startswith("verdict=") for t in body):
                continue
            if n / count[body] >= min_confidence:
                rules[body, v] = {"tokens": sorted(body), "verdict": v, "confidence": n / count[body], "support": n / total}
    # a longer rule stays only if it is surer than every rule over fewer of its tokens
    kept = []
    for (body, v), rule in sorted(rules.items(), key=lambda r: (len(r[0][0]), r[1]["tokens"], r[0][1])):
        shorter = (rules.get((body - {t}, v)) for t in body)
        if all(s is None or rule["confidence"] > max(s["confidence"], s.get("best", 0)) + 1e-9 for s in shorter):
            kept.append(rule)
        rule["best"] = max([rule["confidence"], *(s.get("best", 0) for t in body if (s := rules.get((body - {t}, v))))])
    for rule in kept:
        rule["rarest"] = min(rule["tokens"], key=lambda t: (count[frozenset([t])], t))
        rule.pop("best")
    return kept


def best_rule(found: Column, rules: list[dict]) -> Column:
    """The verdict of the best mined rule that matches the token array, else NULL."""
    index: dict[str, list] = {}
    for r in rules:
        index.setdefault(r["rarest"], []).append({"c": r["confidence"], "s": r["support"], "n": len(r["tokens"]), "v": r["verdict"], "t": r["tokens"]})
    if not index:
        return F.lit(None).cast("string")
    lists = F.from_json(F.lit(json.dumps(index)), "map<string,array<struct<c:double,s:double,n:int,v:string,t:array<string>>>>")
    posting = F.flatten(F.transform(found, lambda t: F.coalesce(lists[t], F.array().cast("array<struct<c:double,s:double,n:int,v:string,t:array<string>>>"))))
    matching = F.filter(posting, lambda r: F.size(F.array_except(r["t"], found)) == 0)
    return F.array_max(F.transform(matching, lambda r: F.struct(r["c"], r["s"], r["n"], r["v"])))["v"]


def judge(pages: DataFrame, rules: tuple = RULES, default: str = DEFAULT, **how) -> DataFrame:
    """page_id, host, path, rule and verdict of every page, and what decided it."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), url.alias("_w_url"))
    name, verdict = stated(rules, F.col("host"), F.col("path"))
    rows = rows.select("page_id", "host", "path", name.alias("rule"), verdict.alias("_w_verdict"),
                       tokens(F.col("_w_url"), F.col("host"), F.col("path")).alias("tokens"))
    rows = stage(rows, "url-tokens")
    mined = mine(rows.where("_w_verdict IS NOT NULL").select("tokens", F.col("_w_verdict").alias("verdict")), **how)
    own = best_rule(F.col("tokens"), mined)
    return rows.withColumn("_w_own", own).select(
        "page_id", "host", "path", "rule", F.coalesce("_w_verdict", "_w_own", F.lit(default)).alias("verdict"),
        F.when(F.col("rule").isNotNull(), "stated").when(F.col("_w_own").isNotNull(), "mined").otherwise("default").alias("by"))
