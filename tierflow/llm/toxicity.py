"""Operator 2: toxicity by a counterfactual-regularised classifier.

A logistic model over hashed words and word beginnings.  Every labelled
sentence that mentions an identity term is rewritten with another term of the
same group; the model is fitted on

    logistic loss + l2 |w|^2 + mu * mean over rewrites of (score - score')^2

where the squared difference is of the logits, so a neutral mention of a group
scores like the same sentence about any other group.

The fit uses at most ``MAX_TRAIN`` labelled rows (a documented bound); their
feature ids are made on the executors.  Every whole text is scored.

Defined results: NULL and empty texts score as a text without words; rows
without an id are scored and count as held out; without labels of both classes
the score is the smoothed share of the labels seen (0.5 with none).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import BATCH_ROWS, map_batches
from tierflow.llm.features import MEMO, bucket, held_out, training_rows

MAX_TRAIN = 6000
DIMS = 1 << 22
#: Features that the fit keeps, by their association with the label.
FEATURES = 1500
THRESHOLD = 0.5
FOLDS, HELD_OUT = 5, 0
L2, MU = 1e-3, 1.0

#: Groups of interchangeable identity terms.
IDENTITY = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("black", "white", "asian", "latino"),
    ("gay", "straight", "lesbian", "bisexual"), ("immigrants", "refugees", "natives", "foreigners"),
    ("femmes", "hommes"), ("musulmans", "juifs", "athées"), ("frauen", "männer"), ("muslime", "christen", "juden"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"),
)

WORD = re.compile(r"\w+")
SENTENCE = re.compile(r"(?<=[.!?\n])\s+")


def ids_of(word: str) -> tuple[int, ...]:
    """Hashed ids of a word and of its beginnings of four and five letters."""
    return (bucket(word, DIMS), *(bucket("^" + word[:k], DIMS) for k in (4, 5) if len(word) > k))


def swapped(sentence: list[str], groups: tuple) -> list[str] | None:
    """The sentence with each identity term replaced by the next of its group."""
    after = {t: g[(i + 1) % len(g)] for g in groups for i, t in enumerate(g)}
    return [after.get(w, w) for w in sentence] if any(w in after for w in sentence) else None


def counterfactuals(text: str, groups: tuple) -> list[tuple[list[int], list[int]]]:
    """(ids that a rewrite takes away, ids that it adds), one pair per sentence that names a group."""
    out = []
    for sentence in SENTENCE.split(text.lower()):
        words = WORD.findall(sentence)
        other = swapped(words, groups)
        if other:
            a, b = ({i for w in s for i in ids_of(w)} for s in (words, other))
            out.append((sorted(a - b), sorted(b - a)))
    return out


@dataclass
class Model:
    bias: float
    weights: dict[int, float]

    def score(self, ids: set[int]) -> float:
        y = self.bias + sum(self.weights[i] for i in ids if i in self.weights)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, y))))


def association(total: np.ndarray, hit: np.ndarray, n: int, pos: int) -> np.ndarray:
    """G-square of each feature with the label, from document counts."""
    out = np.zeros(len(total))
    for o, e in ((hit, total * pos / n), (total - hit, total * (n - pos) / n),
                 (pos - hit, (n - total) * pos / n), (n - pos - total + hit, (n - total) * (n - pos) / n)):
        ok = (o > 0) & (e > 0)
        out[ok] += 2 * o[ok] * np.log(o[ok] / e[ok])
    return out


def fit(rows: list[tuple[list[int], int]], pairs: list[tuple[list[int], list[int]]], features: int = FEATURES,
        l2: float = L2, mu: float = MU, steps: int = 400) -> Model:
    n, pos = len(rows), sum(y for _, y in rows)
    if not 0 < pos < n:
        share = (pos + 1) / (n + 2)
        return Model(math.log(share / (1 - share)), {})
    total, hit = Counter(), Counter()
    for ids, y in rows:
        total.update(ids)
        if y:
            hit.update(ids)
    least = 2 if n < 1000 else 3
    known = np.array(sorted(i for i, c in total.items() if c >= least), np.int64)
    g2 = association(np.array([total[i] for i in known], float), np.array([hit[i] for i in known], float), n, pos)
    kept = known[np.lexsort((known, -g2))][:features]
    place = {int(i): k for k, i in enumerate(kept)}
    x = np.zeros((n, len(kept)), np.float32)
    for r, (ids, _) in enumerate(rows):
        x[r, [place[i] for i in ids if i in place]] = 1
    change = np.zeros((len(pairs), len(kept)), np.float32)
    for r, (minus, plus) in enumerate(pairs):
        change[r, [place[i] for i in minus if i in place]] = 1
        change[r, [place[i] for i in plus if i in place]] = -1
    y = np.array([t for _, t in rows], np.float32)
    w, bias = np.zeros(len(kept), np.float32), float(np.log(pos / (n - pos)))
    m, s = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    for step in range(1, steps + 1):
        g = (1 / (1 + np.exp(-np.clip(x @ w + bias, -30, 30))) - y) / n
        grad = x.T @ g + l2 * w
        if len(pairs):
            grad = grad + 2 * mu / len(pairs) * (change.T @ (change @ w))
        full = np.append(grad, g.sum())
        m += 0.1 * (full - m)
        s += 0.001 * (full * full - s)
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
        w, bias = (w - move[:-1]).astype(np.float32), bias - float(move[-1])
    return Model(bias, {int(i): float(v) for i, v in zip(kept, w, strict=True) if abs(v) > 1e-6})


def train(documents: DataFrame, labels: DataFrame, groups: tuple = IDENTITY, most: int = MAX_TRAIN, mu: float = MU) -> Model:
    def sparse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids = [sorted({i for w in set(WORD.findall(t.lower())) for i in ids_of(w)}) for t in b.text]
            pairs = [counterfactuals(t, groups) for t in b.text]
            yield pd.DataFrame({"doc_id": b.doc_id, "ids": ids, "minus": [[p[0] for p in ps] for ps in pairs],
                                "plus": [[p[1] for p in ps] for ps in pairs], "label": b.label})

    rows = training_rows(documents, labels, "toxic", FOLDS, HELD_OUT, most)
    schema = "doc_id long, ids array<int>, minus array<array<int>>, plus array<array<int>>, label int"
    made = sorted((tuple(r) for r in map_batches(rows, sparse, schema).collect()), key=lambda r: (r[0], r[1]))
    pairs = [p for _, _, minus, plus, _ in made for p in zip(minus, plus, strict=True)]
    return fit([(ids, int(y)) for _, ids, _, _, y in made], pairs, mu=mu)


def toxicity(documents: DataFrame, labels: DataFrame, groups: tuple = IDENTITY, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    spark = documents.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    sent = spark.sparkContext.broadcast(train(documents, labels, groups))  # at most FEATURES weights

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, memo = sent.value, {}
        for texts in batches:
            out = []
            for t in texts:
                if len(memo) > MEMO:
                    memo.clear()
                ids: set[int] = set()
                for token in set((t or "").lower().split()):
                    hit = memo.get(token)
                    if hit is None:
                        hit = memo[token] = tuple(i for w in WORD.findall(token) for i in ids_of(w) if i in model.weights)
                    if hit:
                        ids.update(hit)
                out.append(model.score(ids))
            yield pd.Series(out, dtype="float64")

    return (documents.select("doc_id", held_out(FOLDS, HELD_OUT).alias("held_out"), score(F.col("text").cast("string")).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
