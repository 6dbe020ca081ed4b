"""Operator 10: quality classifier, a factorisation machine.

Inputs of a score are hashed words, structure statistics of the text and text
metadata (its lengths).  The score is
``sigmoid(w0 + sum w_i x_i + 1/2 sum_f [(sum v_if x_i)^2 - sum v_if^2 x_i^2])``:
all pairwise interactions, in time linear in the document's features.

The model is fitted on at most ``MAX_TRAIN`` labelled rows (a documented bound);
their sparse features are made on the executors and only they reach the driver.
Every whole text is scored.

Defined results: NULL and empty texts are scored like a text without words;
rows without an id are scored and count as held out; without any label of both
classes the score is the smoothed share of the labels seen (0.5 with none).
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

MAX_TRAIN = 4000
DIMS = 2048
RANK = 6
EPOCHS = 40
THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2
STATS = 16

_CLASS = np.zeros((256, 6))
for _c in range(256):
    _CLASS[_c, 0] = chr(_c).isascii() and chr(_c).islower() or _c >= 128
    _CLASS[_c, 1] = chr(_c).isascii() and chr(_c).isupper()
    _CLASS[_c, 2] = 48 <= _c < 58
    _CLASS[_c, 3] = _c in b" \t\n\r\x0b\x0c"
    _CLASS[_c, 4] = _c in b".,;:'\"?()-"
    _CLASS[_c, 5] = 32 < _c < 127 and not chr(_c).isalnum() and _c not in b".,;:'\"?()-"


def structure(text: str, words: list[str], counts: Counter) -> list[float]:
    """Structure statistics and length metadata, each of order one."""
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    share = (raw @ _CLASS) / max(1, raw.sum())
    n = len(words)
    same = sum(map(str.__eq__, words, words[1:])) if n > 1 else 0
    lines = text.count("\n") + 1
    return [*share.tolist(), math.log1p(len(text)) / 10, math.log1p(n) / 8, len(text) / max(1, n) / 10,
            len(counts) / max(1, n), max(counts.values(), default=0) / max(1, n), same / max(1, n),
            math.log1p(n / lines) / 5, raw[33] / max(1, n), raw[124] / max(1, n), math.log1p(lines) / 5]


class Featurer:
    """Text to (indexes, values): ``STATS`` dense places, then hashed words of unit length."""

    def __init__(self) -> None:
        self.memo: dict[str, int] = {}

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        words = text.split()
        counts = Counter(words)
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        places = set()
        for w in counts:
            p = memo.get(w)
            if p is None:
                p = memo[w] = STATS + bucket(re.sub(r"^\W+|\W+$", "", w.lower()) or w[:1], DIMS)
            places.add(p)
        idx = np.fromiter(places, np.int32, len(places))
        idx.sort()
        val = np.full(len(idx), 1 / math.sqrt(max(1, len(idx))))
        return np.concatenate([np.arange(STATS, dtype=np.int32), idx]), np.concatenate([structure(text, words, counts), val])


@dataclass
class Machine:
    w0: float
    w: np.ndarray
    v: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def score(self, idx: np.ndarray, val: np.ndarray) -> float:
        x = val.copy()
        x[:STATS] = np.clip((x[:STATS] - self.mean) / self.scale, -8, 8)
        v = self.v[idx]
        inner = x @ v
        y = self.w0 + x @ self.w[idx] + 0.5 * float(inner @ inner - (x * x) @ (v * v).sum(axis=1))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, y))))


def fit(rows: list[tuple[list[int], list[float], int]], seed: int = 5, rank: int = RANK, epochs: int = EPOCHS) -> Machine:
    """Adam on the logistic loss of the factorisation machine, with weight decay."""
    size, n = STATS + DIMS, len(rows)
    y = np.array([r[2] for r in rows], np.float32)
    mean, scale = np.zeros(STATS), np.ones(STATS)
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 1) / (n + 2)
        return Machine(float(np.log(share / (1 - share))), np.zeros(size), np.zeros((size, rank)), mean, scale)
    x = np.zeros((n, size), np.float32)
    for i, (idx, val, _) in enumerate(rows):
        x[i, idx] = val
    mean, scale = x[:, :STATS].mean(axis=0), x[:, :STATS].std(axis=0) + 1e-3
    x[:, :STATS] = np.clip((x[:, :STATS] - mean) / scale, -8, 8)
    rng = np.random.default_rng(seed)
    w0, w, v = np.zeros(1, np.float32), np.zeros(size, np.float32), rng.normal(0, 0.02, (size, rank)).astype(np.float32)
    # the rarer class weighs as much as the other at a third, so that one class cannot drown it
    balance = np.where(y == 1, 1.0, min(4.0, max(1.0, y.mean() / (1 - y.mean()) / 3))).astype(np.float32)
    params, first, second, step = [w0, w, v], [np.zeros_like(p) for p in (w0, w, v)], [np.zeros_like(p) for p in (w0, w, v)], 0
    batch = min(128, max(8, n // 8))
    for _ in range(max(epochs, min(400, 60_000 // max(1, n)))):
        order = rng.permutation(n)
        for at in range(0, n, batch):
            rows_at = order[at : at + batch]
            xb, x2 = x[rows_at], x[rows_at] ** 2
            inner = xb @ v
            out = w0 + xb @ w + 0.5 * ((inner**2).sum(axis=1) - x2 @ (v * v).sum(axis=1))
            g = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - y[rows_at]) * balance[rows_at] / len(rows_at)
            grads = [np.array([g.sum()]), xb.T @ g + 1e-4 * w, xb.T @ (g[:, None] * inner) - v * (x2.T @ g)[:, None] + 1e-3 * v]
            step += 1
            for p, gr, m, s in zip(params, grads, first, second, strict=True):
                m += 0.1 * (gr - m)
                s += 0.001 * (gr * gr - s)
                p -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return Machine(float(w0[0]), w.astype(np.float64), v.astype(np.float64), mean.astype(np.float64), scale.astype(np.float64))


def train(documents: DataFrame, labels: DataFrame, most: int = MAX_TRAIN) -> Machine:
    def sparse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        featurer = Featurer()
        for b in batches:
            made = [featurer(t) for t in b.text]
            yield pd.DataFrame({"doc_id": b.doc_id, "idx": [i.tolist() for i, _ in made], "val": [v.tolist() for _, v in made], "label": b.label})

    rows = training_rows(documents, labels, "quality", FOLDS, HELD_OUT, most)
    sample = map_batches(rows, sparse, "doc_id long, idx array<int>, val array<float>, label int").toPandas()
    # rows come in any order; equal samples must give equal models
    made = sorted(zip(sample.doc_id, sample.idx, sample.val, sample.label, strict=True), key=lambda r: (r[0], len(r[1]), list(r[2])))
    return fit([(i, v, int(y)) for _, i, v, y in made])


def scorer(spark, model: Machine):
    """A column function of text: the probability of label 1."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    sent = spark.sparkContext.broadcast(model)  # (STATS + DIMS) * (RANK + 1) numbers

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        featurer, m = Featurer(), sent.value
        for texts in batches:
            yield pd.Series([m.score(*featurer(t or "")) for t in texts], dtype="float64")

    return score


def quality(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    score = scorer(documents.sparkSession, train(documents, labels))
    return (documents.select("doc_id", held_out(FOLDS, HELD_OUT).alias("held_out"), score(F.col("text").cast("string")).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier accepts, with all their columns."""
    score = scorer(documents.sparkSession, train(documents, labels))
    return documents.where(score(F.col("text").cast("string")) >= threshold)
