"""Operator 7: benchmark decontamination by latent semantic retrieval.

Benchmark passages are the rows of a TF-IDF matrix whose document frequencies
are counted over all documents.  A randomised SVD of that matrix (subspace
iteration; the products with it are summed by Spark) gives the latent space.
Every document is read as overlapping windows.  A window is a candidate for a
passage if it holds at least ``MASS`` of the passage's squared TF-IDF weight (the
passages are sorted by it, so a light window is multiplied with few), its latent
vector has a cosine of at least ``COSINE`` with the
passage's, and its part along the passage is at least ``MASS`` of the passage's
length.  Words around a short passage dilute that cosine, and a full block has
more pieces than the space has directions, so the place of any of the passage's
``ANCHORS`` rarest pairs of neighbouring words (of its word, if it has one) is a
candidate too, whatever its cosine: a verbatim copy is always one.  A candidate is contaminated when the longest common word subsequence of the passage and the
window's surroundings covers ``COVER`` of the passage, and that of the
passage's answer (its last quarter, unless a column names it) ``ANSWER`` of the
answer, so reworded copies count and shared vocabulary does not.

The benchmark is worked off in blocks of ``BLOCK`` items, so what a task
holds of it has a fixed bound whatever the number of items; document windows
never leave their task.

Defined results: NULL and empty texts, and items without words, match nothing;
repeated rows give repeated results; items of equal text all match; an empty
benchmark or document table gives an empty result; other columns are kept by
``keep_clean`` and ignored by ``contaminated``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import BATCH_ROWS, map_batches
from tierflow.llm.features import MEMO

BLOCK = 2000
RANK = 192
OVERSAMPLE = 8
POWER = 2
#: Words per window and between windows; a passage is cut into pieces of at most a window.
WINDOW, STRIDE = 32, 8
COSINE = 0.5
MASS = 0.5
COVER, ANSWER = 0.75, 0.5
#: Neighbouring words of a passage whose places in a document are candidates.
ANCHORS = 3
#: Words in more than this share of the documents have no weight in the latent space.
STOP_SHARE = 0.2
MARKS = ".,;:!?\"'()[]"


def norm(word: str) -> str:
    return word.strip(MARKS).lower() or word


def lcs(a: list, b: list) -> int:
    """Longest common subsequence, a machine word of columns at a time."""
    where: dict = {}
    for i, w in enumerate(a):
        where[w] = where.get(w, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        hit = row & where.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


@dataclass
class Block:
    """A block of benchmark items and its latent space."""

    items: list[tuple[int, list[int], list[int]]]  # id, words and answer words as places in the vocabulary
    vocab: dict[str, int]
    weight: np.ndarray  # by word; 0 for words in too many documents
    vectors: np.ndarray  # by word, in the latent space
    pieces: np.ndarray  # unit vectors of the items' pieces
    length: np.ndarray  # of the pieces before that
    mass: np.ndarray  # of the pieces: squared weight, ascending
    piece_item: np.ndarray
    anchors: np.ndarray  # pairs of neighbouring words as numbers, ascending
    anchor_item: np.ndarray
    anchor_at: np.ndarray  # their places in the item


def pieces_of(words: list[str]) -> Iterator[list[str]]:
    """The whole passage if it fits a window, else overlapping pieces of it."""
    if len(words) <= WINDOW:
        yield words
        return
    for at in range(0, len(words) - WINDOW + STRIDE, STRIDE):
        yield words[min(at, len(words) - WINDOW) : min(at, len(words) - WINDOW) + WINDOW]


def pair(first, second, size: int):
    """Neighbouring words as one number; ``second`` is -1 for a word by itself."""
    return first * (size + 1) + second + 1


def anchors_of(items: list[tuple[int, list[int], list[int]]], rare: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, item, place) of the items' rarest neighbouring words, by pair."""
    out = []
    for k, (_, words, _) in enumerate(items):
        pairs = {pair(a, b, len(rare)): (-rare[a] - rare[b], i) for i, (a, b) in reversed([*enumerate(zip(words, words[1:]))])}
        pairs = pairs or {pair(words[0], -1, len(rare)): (0.0, 0)}
        out += [(p, k, i) for p, (_, i) in sorted(pairs.items(), key=lambda x: x[1])[:ANCHORS]]
    return tuple(np.array(x, np.int64) for x in zip(*sorted(out), strict=True))


class Known(dict):
    """Token to its form in a vocabulary, None outside; emptied when it has grown."""

    def __init__(self, vocab: set[str]) -> None:
        super().__init__()
        self.vocab = vocab

    def __missing__(self, token: str) -> str | None:
        word = norm(token)
        word = self[token] = word if word in self.vocab else None
        return word


def document_counts(documents: DataFrame, vocab: set[str]) -> tuple[int, dict[str, int]]:
    """Number of documents, and how many of them have each word of the vocabulary."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = Counter(), 0
        known = Known(vocab)
        for b in batches:
            if len(known) > MEMO:
                known.clear()
            for t in b.text:
                n += 1
                total.update(set(map(known.__getitem__, set(t.split()))))
        total.pop(None, None)
        yield pd.DataFrame({"word": [*total, None], "n": [*total.values(), n]})

    text = documents.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = map_batches(text, count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    counts = dict(zip(*(c.to_pylist() for c in rows.columns), strict=True))
    return int(counts.pop(None, 0)), counts


def svd_space(passages: DataFrame, size: int, rank: int = RANK, seed: int = 3) -> np.ndarray:
    """Right singular vectors (size x rank) of the sparse rows (idx, val) by a randomised SVD.

    Each pass multiplies the current subspace by A'A: tasks make the products
    of their own rows and Spark sums them per word.
    """
    width = min(rank + OVERSAMPLE, size)
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, width)))
    z = q
    for _ in range(POWER + 1):
        sent = passages.sparkSession.sparkContext.broadcast(q)  # words of a block x (RANK + OVERSAMPLE)

        def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total: dict[int, np.ndarray] = {}
            for b in batches:
                for idx, val in zip(b.idx, b.val, strict=True):
                    val = np.asarray(val)
                    y = val @ sent.value[np.asarray(idx)]
                    for i, v in zip(idx, val, strict=True):
                        total[i] = total[i] + v * y if i in total else v * y
            if total:
                yield pd.DataFrame({"word": list(total), "row": [r.tolist() for r in total.values()]})

        rows = map_batches(passages, products, "word int, row array<double>")
        # as Arrow: numbers, not a Python object for each of them
        summed = rows.groupBy("word").agg(*[F.sum(F.col("row")[j]).alias(f"s{j}") for j in range(width)]).toArrow()
        sent.destroy()
        z = np.zeros((size, width))
        z[summed.column("word").to_numpy()] = np.column_stack([c.to_numpy() for c in summed.columns[1:]])
        del summed
        t = q.T @ z  # q' A'A q
        q, _ = np.linalg.qr(z)
    values, turn = np.linalg.eigh((t + t.T) / 2)
    best = np.argsort(-values)[: min(rank, width)]
    base, _ = np.linalg.qr(z @ turn[:, best])
    return base


def build(documents: DataFrame, items: list[tuple[int, str, str | None]], rank: int = RANK) -> Block | None:
    """The latent space of a block of items (id, text, answer), with counts over all documents."""
    known = []
    for i, text, answer in items:
        words = [norm(w) for w in (text or "").split()]
        if words:
            known.append((i, words, [norm(w) for w in (answer or "").split()] or words[-max(1, len(words) // 4) :]))
    if not known:
        return None
    n, counts = document_counts(documents, {w for _, words, _ in known for w in words})
    names = sorted({w for _, words, answer in known for w in (*words, *answer)})
    vocab = {w: i for i, w in enumerate(names)}
    common = {w for w in names if counts.get(w, 0) > STOP_SHARE * n}
    # a passage of common words alone keeps their weight, or nothing could find it
    needed = {w for _, words, _ in known if len(set(words) - common) < 4 for w in words}
    rare = np.array([np.log((n + 1) / (counts.get(w, 0) + 1)) + 0.1 for w in names])
    weight = np.where([w not in common or w in needed for w in names], rare, 0.0)
    rows, owner = [], []
    for k, (_, words, _) in enumerate(known):
        for piece in pieces_of(words):
            tf = Counter(i for w in piece if weight[i := vocab[w]] > 0)
            rows.append((list(tf), [float(c * weight[i]) for i, c in tf.items()]))
            owner.append(k)
    passages = documents.sparkSession.createDataFrame(rows, "idx array<int>, val array<double>")
    base = svd_space(passages, len(vocab), rank)
    made = np.array([np.asarray(v) @ base[np.asarray(i)] for i, v in rows])
    length = np.maximum(np.linalg.norm(made, axis=1), 1e-9)
    mass = np.array([sum(c * weight[i] ** 2 for i, c in zip(idx, tf, strict=True)) for idx, tf in
                     ((idx, [v / weight[i] for i, v in zip(idx, val, strict=True)]) for idx, val in rows)])
    order = np.argsort(mass, kind="stable")
    placed = [(i, [vocab[w] for w in words], [vocab[w] for w in answer]) for i, words, answer in known]
    return Block(placed, vocab, weight, (base * weight[:, None]).astype(np.float32), (made / length[:, None]).astype(np.float32)[order],
                 length.astype(np.float32)[order], mass[order], np.array(owner)[order], *anchors_of(placed, rare))


class Places(dict):
    """Token to its place in a block's vocabulary, -1 outside; emptied when it has grown."""

    def __init__(self, vocab: dict[str, int]) -> None:
        super().__init__()
        self.vocab = vocab

    def __missing__(self, token: str) -> int:
        place = self[token] = self.vocab.get(norm(token), -1)
        return place


def matches(texts: list[str], block: Block, places: Places) -> list[list[tuple[int, float, float, float]]]:
    """Per text the (item_id, cosine, cover, answer) of every contaminating item."""
    words = [t.split() for t in texts]
    size = np.array([len(w) for w in words])
    begin = np.cumsum(size) - size
    at = np.array([p for w in words for p in map(places.__getitem__, w)], np.int32)
    pos = np.flatnonzero((at >= 0) & (block.weight[at] > 0))
    mass = np.concatenate(([0.0], np.cumsum(block.weight[at[pos]] ** 2)))
    # windows of every text, none across two
    count = np.where(size > 0, np.maximum(1, -(-(size - WINDOW + STRIDE) // STRIDE)), 0)
    owner = np.repeat(np.arange(len(texts)), count)
    starts = begin[owner] + STRIDE * (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count))
    stops = np.minimum(starts + WINDOW, (begin + size)[owner])
    lo, hi = np.searchsorted(pos, starts), np.searchsorted(pos, stops)
    # how many of the pieces, lightest first, each window is heavy enough for
    most = np.searchsorted(block.mass, (mass[hi] - mass[lo]) / MASS + 1e-9, side="right")
    step = max(1, len(block.mass) // 8)
    tier = -(-most // step)
    near: list[dict[int, list]] = [{} for _ in texts]
    for t in np.unique(tier[tier > 0]):
        rows = np.flatnonzero(tier == t)
        columns = slice(0, min(len(block.mass), int(t) * step))
        for a in range(0, len(rows), 512):  # bounds the tables of vectors and cosines
            part = rows[a : a + 512]
            held = hi[part] - lo[part]
            first = np.cumsum(held) - held
            events = np.repeat(lo[part] - first, held) + np.arange(int(held.sum()))
            w = np.add.reduceat(block.vectors[at[pos[events]]], first, axis=0)
            along = w @ block.pieces[columns].T
            cos = along / np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-9)
            good = (cos >= COSINE) & (along >= MASS * block.length[columns]) & (np.arange(along.shape[1]) < most[part][:, None])
            for r, c in zip(*np.nonzero(good), strict=True):
                near[owner[part[r]]].setdefault(int(block.piece_item[c]), []).append((int(starts[part[r]]), float(cos[r, c])))
    for i, k, start in anchored(at, begin, size, block):
        held = at[start : min(start + WINDOW, begin[i] + size[i])]
        w = block.vectors[held[held >= 0]].sum(axis=0)
        cos = (block.pieces[block.piece_item == k] @ w).max() / max(np.linalg.norm(w), 1e-9)
        near[i].setdefault(k, []).append((start, float(cos)))
    return [sorted(verified(at[begin[i] : begin[i] + size[i]], int(begin[i]), found, block)) if found else [] for i, found in enumerate(near)]


def anchored(at: np.ndarray, begin: np.ndarray, size: np.ndarray, block: Block) -> list[tuple[int, int, int]]:
    """(text, item, start) of all places where a text has an anchor: start is where the passage would begin."""
    if not len(at):
        return []
    words = at.astype(np.int64)
    after = np.append(words[1:], -1)
    after[(begin + size - 1)[size > 0]] = -1  # no pair across two texts
    out = []
    sought = [(pair(words, after, len(block.vocab)), (words >= 0) & (after >= 0))]
    if (block.anchors % (len(block.vocab) + 1) == 0).any():
        sought.append((pair(words, -1, len(block.vocab)), words >= 0))
    for keys, real in sought:
        spot = np.flatnonzero(real)
        low, high = (np.searchsorted(block.anchors, keys[spot], side) for side in ("left", "right"))
        hits = high - low
        spot, low, hits = spot[hits > 0], low[hits > 0], hits[hits > 0]
        which = np.repeat(low - (np.cumsum(hits) - hits), hits) + np.arange(int(hits.sum()))
        spot = np.repeat(spot, hits)
        text = np.searchsorted(begin + size, spot, side="right")
        start = np.maximum(begin[text], spot - block.anchor_at[which])
        out += zip(text.tolist(), block.anchor_item[which].tolist(), start.tolist(), strict=True)
    return sorted(set(out))


def verified(at: np.ndarray, begin: int, near: dict[int, list], block: Block) -> Iterator[tuple[int, float, float, float]]:
    """The candidates of one text (its words ``at``, its windows by item) that the passages cover."""
    for k, found in near.items():
        item, passage, answer = block.items[k]
        result = None
        for start in sorted({s for s, _ in found}):
            # what surrounds the window may hold the rest of a longer passage
            around = at[max(0, start - begin - len(passage)) : start - begin + WINDOW + len(passage)].tolist()
            cover = lcs(passage, around) / len(passage)
            if cover >= COVER and (a := lcs(answer, around) / len(answer)) >= ANSWER and (result is None or cover > result[2]):
                result = (item, max(c for s, c in found if s == start), cover, a)
                if cover == 1:
                    break
        if result:
            yield result


MATCH = "array<struct<item_id:long,cosine:double,cover:double,answer:double>>"


def blocks(documents: DataFrame, benchmark: DataFrame, answer_col: str | None = None) -> Iterator[Block]:
    """The benchmark as blocks of at most ``BLOCK`` items, each with its latent space."""
    wanted = benchmark.select("item_id", F.col("text").cast("string").alias("text"),
                              (F.col(answer_col).cast("string") if answer_col else F.lit(None).cast("string")).alias("answer"))
    wanted = wanted.orderBy("item_id", "text", "answer")
    part: list = []
    for r in wanted.toLocalIterator():
        part.append((r["item_id"], r["text"], r["answer"]))
        if len(part) == BLOCK:
            if block := build(documents, part):
                yield block
            part = []
    if part and (block := build(documents, part)):
        yield block


def matcher(spark, block: Block):
    """A column function of text: the matches of one block."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    sent = spark.sparkContext.broadcast(block)  # at most BLOCK items, their words and RANK numbers per word

    @F.pandas_udf(MATCH)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        block = sent.value
        places = Places(block.vocab)
        for texts in batches:
            if len(places) > MEMO:
                places.clear()
            found = matches([t or "" for t in texts], block, places)
            yield pd.Series([[{"item_id": i, "cosine": c, "cover": v, "answer": a} for i, c, v, a in m] for m in found])

    return find


def contaminated(documents: DataFrame, benchmark: DataFrame, answer_col: str | None = None) -> DataFrame:
    """One row per contaminated document and benchmark item: doc_id, item_id, cosine, cover, answer."""
    spark = documents.sparkSession
    out = None
    for block in blocks(documents, benchmark, answer_col):
        found = documents.select("doc_id", F.explode(matcher(spark, block)(F.col("text").cast("string"))).alias("m"))
        found = found.select("doc_id", "m.*")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return documents.select("doc_id", F.lit(0).cast("long").alias("item_id"), *[F.lit(0.0).alias(c) for c in ("cosine", "cover", "answer")]).where("false")
    return out


def keep_clean(documents: DataFrame, benchmark: DataFrame, answer_col: str | None = None) -> DataFrame:
    """The documents without any contaminating item, with all their columns."""
    out = documents
    for block in blocks(documents, benchmark, answer_col):
        out = out.where(F.size(matcher(documents.sparkSession, block)(F.col("text").cast("string"))) == 0)
    return out
