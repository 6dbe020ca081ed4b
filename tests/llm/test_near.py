"""Order MinHash, components and the latent search against plain loops."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierflow.llm import latent, order_minhash
from tierflow.llm.components import stars

VOCAB = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in ("", "n", "r", "st", "lk", "mp")]


def text(rng, n):
    return [rng.choice(VOCAB) for _ in range(n)]


def plain_alignment(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], max(row[j + 1], row[j], last + 1 if x == y else 0)
    return row[-1] / (len(a) + len(b) - row[-1])


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        words[at : at + rng.randint(0, 1)] = text(rng, rng.randint(0, 1))
    return words


def test_banded_alignment_equals_the_full_table():
    rng = random.Random(2)
    h = order_minhash.WordHashes()
    seen = set()
    for _ in range(200):
        a = text(rng, rng.randint(1, 60)) * rng.choice((1, 1, 2))
        b = edited(rng, a, rng.randint(0, 4)) or ["x"]
        if rng.random() < 0.2:
            b = b[len(b) // 2 :] + b[: len(b) // 2]
        x, y = (order_minhash.labelled(h.sequence(" ".join(w))) for w in (a, b))
        full, got = plain_alignment(x.tolist(), y.tolist()), order_minhash.alignment(x, y)
        assert (got >= 0.8) == (full >= 0.8) and (got < 0.8 or abs(got - full) < 1e-12)
        seen.add(full >= 0.8)
    assert seen == {True, False}


def test_classes_equal_all_pairs(spark):
    rng = random.Random(3)
    docs = []
    for _ in range(40):
        base = text(rng, rng.randint(30, 300))
        docs.append(base)
        for _ in range(rng.randint(0, 5)):
            docs.append(edited(rng, rng.choice(docs[-2:]), rng.randint(0, max(1, len(base) // 40))))
    hot = text(rng, 200)
    docs += [edited(rng, hot, 2) for _ in range(60)] + [hot] * 40 + [text(rng, 3) for _ in range(5)] + [["a", "b"], ["a", "b"], []]
    rows = [(i, " ".join(w)) for i, w in enumerate(docs)]
    got = {r["doc_id"]: (r["class_id"], r["kept"]) for r in order_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    h = order_minhash.WordHashes()
    kmers = [order_minhash.labelled(h.sequence(t)) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if order_minhash.alignment(kmers[i], kmers[j]) >= 0.8:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    assert {i: g[0] for i, g in got.items()} == {i: find(i) for i in range(len(rows))}
    assert {i for i, g in got.items() if g[1]} == set(map(find, range(len(rows))))


def test_stars_find_the_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(300 + i, 301 + i) for i in range(40)] + [(500, 500 + i) for i in range(50)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r["u"]: r["root"] for r in stars(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in list(parent) if find(x) != x}


def test_lcs_equals_the_table():
    rng = random.Random(5)
    for _ in range(200):
        a, b = ([rng.choice("abcde") for _ in range(rng.randint(1, 90))] for _ in range(2))
        sim = plain_alignment(a, b)
        n = latent.lcs(a, b)
        assert abs(n / (len(a) + len(b) - n) - sim) < 1e-12


def test_randomised_svd_spans_the_leading_space(spark):
    rng = np.random.default_rng(6)
    a = rng.normal(size=(40, 6)) @ rng.normal(size=(6, 50)) + 0.001 * rng.normal(size=(40, 50))
    rows = [(list(range(50)), r.tolist()) for r in a]
    v = latent.svd_space(spark.createDataFrame(rows, "idx array<int>, val array<double>"), 50, rank=6)
    true = np.linalg.svd(a)[2][:6].T
    assert np.linalg.norm(true - v @ (v.T @ true)) < 1e-3


def test_leaks_and_paraphrases_are_found_and_clean_documents_left(spark):
    rng = random.Random(7)
    items = [(k, text(rng, n)) for k, n in enumerate((12, 20, 32, 45, 60, 90))]
    docs, want = [], set()
    for i in range(120):
        words = text(rng, rng.randint(5, 400))
        if i % 2:
            k, passage = items[i % len(items)]
            said = list(passage)
            if i % 3 == 0:  # reworded: one word in eight
                for at in range(0, len(said), 8):
                    said[at] = "reworded"
            at = rng.randrange(len(words) + 1)
            words[at:at] = said
            want.add((i, k))
        docs.append((i, " ".join(words)))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in latent.contaminated(d, b).collect()} == want
    assert {r["doc_id"] for r in latent.keep_clean(d, b).collect()} == {i for i, _ in docs} - {i for i, _ in want}


def test_blocks_of_the_benchmark_add_up(spark, monkeypatch):
    rng = random.Random(8)
    items = [(k, " ".join(text(rng, 20))) for k in range(9)]
    docs = spark.createDataFrame([(i, " ".join(text(rng, 30)) + " " + items[i][1]) for i in range(9)], "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(latent, "BLOCK", 4)
    assert sorted((r["doc_id"], r["item_id"]) for r in latent.contaminated(docs, b).collect()) == [(i, i) for i in range(9)]


def test_bucket_pairs_stay_linear(spark):
    members = spark.range(500).select(F.lit(1).cast("long").alias("key"), F.col("id").cast("string").cast("binary").alias("t"), F.lit(100).alias("n"))
    made = order_minhash.candidate_pairs(members.withColumn("root", F.col("t")), 0).count()
    assert 500 <= made <= 2 * 500
    assert order_minhash.candidate_pairs(members.withColumn("root", F.lit(b"1")), 0).count() == 0
    uneven = members.withColumn("n", F.pow(F.lit(2), F.col("t").cast("string").cast("int") % 30).cast("int")).withColumn("root", F.col("t"))
    assert order_minhash.candidate_pairs(uneven, 0).count() < 2 * 500 / 10


def test_a_chain_of_copies_is_one_class(spark):
    """Neighbours are near copies, the ends are not: every link of the chain must be found."""
    rng = random.Random(9)
    words, docs = text(rng, 300), []
    for _ in range(40):
        for at in rng.sample(range(0, 300), 3):
            words[at] = rng.choice(VOCAB) + "x"
        docs.append(" ".join(words))
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    h = order_minhash.WordHashes()
    assert order_minhash.alignment(*(order_minhash.labelled(h.sequence(docs[i])) for i in (0, -1))) == 0.0
    assert order_minhash.near_duplicates(d).select("class_id").distinct().collect() == [(0,)]


@pytest.mark.parametrize("chunk", [order_minhash.CHUNK, 16])
def test_pairs_of_a_bucket_of_unlike_texts_are_all_compared(spark, monkeypatch, chunk):
    """Many texts share a long passage and so a sketch; only the two of each pair are near copies."""
    monkeypatch.setattr(order_minhash, "CHUNK", chunk)
    rng = random.Random(8)
    passage = text(rng, 180)
    docs = []
    for _ in range(60):
        own = text(rng, 30)
        docs += [passage + own, passage + own[:10] + text(rng, 20)]
    hot = text(rng, 200)
    docs += [edited(rng, hot, 2) for _ in range(60)] + [edited(rng, hot, 6) for _ in range(20)]
    h = order_minhash.WordHashes()
    kmers = [order_minhash.labelled(h.sequence(" ".join(w))) for w in docs]
    keys = [set(order_minhash.sketches(k).tolist()) for k in kmers]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if keys[i] & keys[j] and order_minhash.alignment(kmers[i], kmers[j]) >= 0.8:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(d).collect()}
    assert got == {i: find(i) for i in range(len(docs))}
    assert sum(find(2 * i) == find(2 * i + 1) for i in range(60)) > 50 and len({find(i) for i in range(120)}) > 50


def test_verbatim_passages_of_a_full_space_are_all_found(spark):
    """Short passages whose surroundings are all of the block's words, more of them than directions."""
    rng = random.Random(12)
    docs = [text(rng, 50) for _ in range(150)]
    items = []
    for _ in range(400):
        d, n = rng.choice(docs), rng.randint(1, 20) if rng.random() < 0.2 else rng.randint(6, 12)
        at = rng.randrange(len(d) - n + 1)
        items.append(" ".join(d[at : at + n]))
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string")
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in latent.contaminated(d, b).collect()}
    want = {(i, j) for i, w in enumerate(docs) for j, x in enumerate(items) if f" {x} " in f" {' '.join(w)} "}
    assert want <= got, len(want - got)


def test_the_row_that_stays_does_not_depend_on_the_order(spark):
    rows = [(5, "six rows of one id and one text but of other sources", f"s{i}", None if i % 2 else "en") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    kept = {tuple(order_minhash.keep_one(spark.createDataFrame(some, docs.schema).repartition(n)).collect()[0])
            for n, some in ((1, rows), (3, rows[::-1]), (5, rows[2:] + rows[:2]))}
    assert len(kept) == 1 and kept <= set(rows)


@pytest.mark.parametrize("vocab", [VOCAB, VOCAB[:60]], ids=["all words", "common words"])
def test_recall_of_reworded_passages(spark, vocab):
    """Every fifth word of a passage is another; the search must bring what the subsequence would accept."""
    rng = random.Random(21)
    docs, items, want = [], [], {}
    for k in range(300):
        size = ((6, 12), (20, 32), (40, 80))[k % 3]
        passage = rng.choices(vocab, k=rng.randint(*size))
        said = [rng.choice(vocab) if at % 5 == 2 else w for at, w in enumerate(passage)]
        words = rng.choices(vocab, k=rng.randint(50, 200))
        words[rng.randrange(len(words)) : 0] = said
        items.append((k, " ".join(passage)))
        docs.append((k, " ".join(words)))
        want[k] = size
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"] for r in latent.contaminated(d, b).where("doc_id = item_id").collect()}
    recall = {size: sum(k in got for k in want if want[k] == size) / 100 for size in set(want.values())}
    print("recall", sorted(recall.items()))
    assert min(recall.values()) >= 0.9, recall
