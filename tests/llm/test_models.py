"""The trained operators: held-out accuracy, identities and rules by counting."""

from __future__ import annotations

import itertools
import math
import random
import zlib

import numpy as np
import pytest

from tierflow.llm import factor, toxicity, url_rules
from tierflow.llm.common import table
from tierflow.llm.features import bucket

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize(("run", "label", "folds", "fold", "least"), [
    (factor.quality, "quality", 4, 2, 0.95), (toxicity.toxicity, "toxic", 5, 0, 0.93)])
def test_held_out_accuracy(spark, run, label, folds, fold, least):
    got = run(table(spark, SF, "documents"), table(spark, SF, "labels"))
    out = {r["doc_id"]: r for r in got.collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % folds == fold) and 0 <= r["score"] <= 1 for i, r in out.items())
    seen = [(out[r["doc_id"]]["predicted"], r[label]) for r in table(spark, SF, "labels").collect() if out[r["doc_id"]]["held_out"]]
    assert len(seen) > 50 and sum(p == y for p, y in seen) / len(seen) >= least


def test_labels_of_the_held_out_fold_are_not_used(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    turned = labels.selectExpr("doc_id", "CASE WHEN pmod(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)), 4) = 2 THEN 1 - quality ELSE quality END AS quality", "toxic")
    a, b = ({r["doc_id"]: r["score"] for r in factor.quality(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_sum_of_squares_identity():
    rng = np.random.default_rng(1)
    size = factor.STATS + factor.DIMS
    m = factor.Machine(0.1, rng.normal(size=size), rng.normal(size=(size, 3)) * 0.1, np.zeros(factor.STATS), np.ones(factor.STATS))
    idx = np.concatenate([np.arange(factor.STATS), [20, 40, 700]])
    val = rng.normal(size=len(idx))
    y = m.w0 + sum(m.w[i] * x for i, x in zip(idx, val, strict=True))
    y += sum(m.v[i] @ m.v[j] * x * z for (i, x), (j, z) in itertools.combinations(list(zip(idx, val, strict=True)), 2))
    assert abs(m.score(idx, val) - 1 / (1 + math.exp(-y))) < 1e-9


def test_counterfactual_penalty_closes_the_gap():
    """Toxic rows often name one group; the penalty makes its neutral mention score like another's."""
    rng = random.Random(2)
    words = [f"w{i}" for i in range(40)]
    rows, pairs = [], []
    for _ in range(600):
        toxic = rng.random() < 0.4
        group = "women" if rng.random() < (0.9 if toxic else 0.1) else "men"
        said = [rng.choice(words) for _ in range(8)] + [group] + (["scum"] if toxic and rng.random() < 0.7 else [])
        rows.append((sorted({i for w in said for i in toxicity.ids_of(w)}), int(toxic)))
        pairs += toxicity.counterfactuals(" ".join(said), toxicity.IDENTITY)

    def gap(model):
        a, b = (model.score({i for w in ("w1", "w2", g) for i in toxicity.ids_of(w)}) for g in ("women", "men"))
        return abs(a - b)

    plain, fair = toxicity.fit(rows, pairs, mu=0.0), toxicity.fit(rows, pairs, mu=5.0)
    assert gap(plain) > 0.3 and gap(fair) < 0.1
    assert fair.score({i for w in ("w1", "scum") for i in toxicity.ids_of(w)}) > 0.5


def test_swaps():
    text = "Women work here. The sky is blue. Men too"
    pairs = toxicity.counterfactuals(text, toxicity.IDENTITY)
    assert len(pairs) == 2
    assert bucket("women", toxicity.DIMS) in pairs[0][0] and bucket("men", toxicity.DIMS) in pairs[0][1]


def test_mined_rules_equal_counting(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(400):
        t = [rng.choice(("top=com", "top=net")), rng.choice(("name=a", "name=b", "name=c")), rng.choice(("first=en", "first=es"))]
        bad = t[0] == "top=net" and t[2] == "first=es" or t[1] == "name=c" and rng.random() < 0.9
        rows.append((t, "block" if bad else "allow"))
    got = {(tuple(r["tokens"]), r["verdict"]): (r["confidence"], r["support"]) for r in url_rules.mine(spark.createDataFrame(rows, "tokens array<string>, verdict string"))}
    want = {}
    for n in (1, 2, 3):
        for body in itertools.combinations(sorted({t for ts, _ in rows for t in ts}), n):
            fits = [v for ts, v in rows if set(body) <= set(ts)]
            for v in url_rules.VERDICTS:
                hit = sum(x == v for x in fits)
                if hit >= url_rules.MIN_SUPPORT * len(rows) and hit and hit / len(fits) >= url_rules.MIN_CONFIDENCE:
                    want[body, v] = (hit / len(fits), hit / len(rows))
    pruned = {k: c for k, c in want.items() if not any((s, k[1]) in want and want[s, k[1]][0] >= c[0] - 1e-9
                                                      for n in range(1, len(k[0])) for s in itertools.combinations(k[0], n))}
    assert got.keys() == pruned.keys() and all(abs(got[k][0] - pruned[k][0]) < 1e-9 and abs(got[k][1] - pruned[k][1]) < 1e-9 for k in got)


def test_index_finds_the_best_matching_rule(spark):
    from pyspark.sql import functions as F

    rules = [{"tokens": ["a"], "verdict": "allow", "confidence": 0.8, "support": 0.3, "rarest": "a"},
             {"tokens": ["a", "b"], "verdict": "block", "confidence": 0.95, "support": 0.1, "rarest": "b"},
             {"tokens": ["c", "d"], "verdict": "block", "confidence": 0.9, "support": 0.1, "rarest": "d"}]
    rows = [(["a"],), (["a", "b"],), (["b"],), (["d", "c", "a"],), ([],)]
    got = spark.createDataFrame(rows, "t array<string>").select(url_rules.best_rule(F.col("t"), rules).alias("v")).collect()
    assert [r["v"] for r in got] == ["allow", "block", None, "block", None]


def test_stated_rules(spark):
    urls = ["https://example.com/en/1", "http://WWW.Example.com/en/x?y", "http://a.www.example.com/en/", "http://notexample.com/en/", "ftp://x.net/es/1#a/b",
            "http://net/fr/", "http://x.org/en/", "http://x.com?/en/", "http://é.COM/a://b", "a://b://c.com/"]
    want = [("example.com", "/en/1", "example.com/en/", "block"), ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
            ("a.www.example.com", "/en/", "www.example.com/en/", "allow"), ("notexample.com", "/en/", "com/", "allow"), ("x.net", "/es/1", "net/es/", "block"),
            ("net", "/fr/", "net/fr/", "block"), ("x.org", "/en/", None, None), ("x.com", "", None, None), ("é.com", "/a://b", "com/", "allow"),
            ("b:", "//c.com/", None, None)]
    got = url_rules.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).orderBy("page_id").collect()
    assert [(r["host"], r["path"], r["rule"]) for r in got] == [w[:3] for w in want]
    assert all(w[3] in (None, r["verdict"]) for r, w in zip(got, want, strict=True))


def test_training_rows_hold_one_row_per_id(spark):
    from tierflow.llm.features import training_rows

    texts = [(1, "a b")] * 50 + [(1, "c d")] * 30 + [(2, None), (2, ""), (3, "e")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 1)], "doc_id long, mark int")
    got = [tuple(r) for r in training_rows(docs, labels, "mark", 5, -1, 3).collect()]
    again = [tuple(r) for r in training_rows(docs.repartition(7), labels, "mark", 5, -1, 3).collect()]
    assert len(got) == len({r[0] for r in got}) <= 3 and sorted(got) == sorted(again)
    assert all((i, x or None) in {(1, "a b"), (1, "c d"), (2, None), (3, "e")} for i, x, _ in got)
