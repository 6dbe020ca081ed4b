"""Content sort, source mixing and Feistel sharding against plain loops."""

from __future__ import annotations

import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm import edge
from tierflow.llm import content_sort, feistel, mixing
from tierflow.llm.common import table


@pytest.mark.parametrize("n", [1, 2, 3, 7, 16, 97, 1000])
def test_permutation_is_one_to_one(spark, n):
    df = spark.range(n).select(feistel.permute(F.col("id"), F.lit(n).cast("long"), 9).alias("p"))
    image = [r["p"] for r in df.collect()]
    assert sorted(image) == list(range(n))
    assert n < 97 or image != list(range(n))


def test_shards(spark, sf):
    docs = table(spark, sf, "documents")
    got = feistel.manifest(docs, 40).collect()
    want = {r["doc_id"]: r["text"].encode() for r in docs.collect()}
    assert len(got) == len(want)
    slots = {}
    for r in got:
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(want[r["doc_id"]]) + 16, zlib.crc32(want[r["doc_id"]]), "rows", None)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(slots) <= set(range(40)) and max(map(len, slots.values())) - min(len(slots.get(s, [])) for s in range(40)) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = feistel.manifest(docs.repartition(7, "source").orderBy(F.desc("text")), 40).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_equal_rows_each_get_a_place(spark):
    docs = spark.range(50_000).select((F.col("id") % 3 - F.lit(1)).alias("doc_id"), F.lit("x").alias("text"))
    got = feistel.manifest(docs, 8).groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("d"), F.max("slot").alias("m")).collect()
    assert all(r["n"] == r["d"] == r["m"] + 1 for r in got) and sorted({r["n"] for r in got}) == [6250]


def test_content_sort(spark):
    docs = edge.documents(spark)
    groups = {}
    for i, text, *_ in edge.ROWS:
        norm = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(norm, []).append((-len(text or ""), i is None, i or 0, i))
    want = []
    for norm, rows in groups.items():
        rows.sort()
        want += [(r[3], rows[0][3], len(rows), k == 0, hashlib.sha256(norm.encode()).hexdigest()) for k, r in enumerate(rows)]
    assert sorted(map(tuple, content_sort.content_sort(docs).collect()), key=repr) == sorted(want, key=repr)


def test_hot_text_is_salted_and_whole(spark):
    docs = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, F.concat(F.lit("h o t"), F.repeat(F.lit(" "), (F.col("id") % 7).cast("int"))))
                                    .otherwise(F.concat(F.lit("cold"), F.col("id").cast("string"))).alias("text")).withColumnRenamed("id", "doc_id")
    got = content_sort.content_sort(docs)
    hot = got.where("group_size > 1")
    assert hot.count() == 2000 and hot.select("keep_id", "group_size").distinct().collect() == [(6, 2000)]
    assert [r["doc_id"] for r in hot.where("kept").collect()] == [6] and got.where("kept").count() == 4001


def filled(sizes: dict, share=1.5, most=2.0) -> dict:
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    out, full = {}, set()
    while True:
        level = (share * sum(sizes.values()) - sum(most * sizes[s] for s in full)) / max(1e-9, sum(weight[s] for s in names if s not in full))
        out = {s: most * sizes[s] if s in full else level * weight[s] for s in names}
        over = {s for s in names if out[s] > most * sizes[s] + 1e-9}
        if not over:
            return out
        full |= over


def test_mix_targets_and_words(spark, sf):
    docs = table(spark, sf, "documents").withColumn("source", F.when(F.col("source") != "src3", F.col("source")))
    got = mixing.mix(docs).collect()
    sizes = {}
    for r in docs.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    want = filled(sizes)
    taken = {}
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert all(abs(taken[s] - want[s]) <= 2 * mixing.BLOCK + 0.01 * want[s] for s in want)
    again = mixing.mix(docs.repartition(5, "text")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)


def test_quotas_are_highest_quotients(spark):
    sources = spark.createDataFrame([("a", 5300.0), ("b", 2410.0), ("c", 1290.0), ("d", 0.0)], "source string, target double")
    rows = mixing.quotas(sources, 4, 100).collect()
    got = {s: sum(r["quota"] for r in rows if r["source"] == s) for s in "abcd"}
    assert all(r["quota"] >= 0 for r in rows)
    house = sum(got.values())
    seats = sorted(((t / (k + 0.5), s) for s, t in (("a", 5300.0), ("b", 2410.0), ("c", 1290.0)) for k in range(200)), reverse=True)[:house]
    assert got == {s: sum(x == s for _, x in seats) for s in "abcd"}


def test_mixed_documents_follow_the_rate(spark, sf):
    docs = table(spark, sf, "documents")
    taken = {r["doc_id"]: (r["taken"], r["size"]) for r in mixing.mix(docs).collect()}
    copies = {r["doc_id"]: r["n"] for r in mixing.mix_documents(docs).groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    for i, (t, z) in taken.items():
        assert t // max(1, z) <= copies.get(i, 0) <= -(-t // max(1, z))


def test_small_sources_reach_their_targets(spark):
    rows = [(f"s{n:03}", 1000 * n + k, " ".join(["w"] * min(25, n - 25 * k))) for n in range(5, 301, 5) for k in range(-(-n // 25))]
    docs = spark.createDataFrame(rows, "source string, doc_id long, text string")
    got = {}
    for r in mixing.mix(docs).collect():
        size, target, taken = got.get(r["source"], (0, r["target"], 0))
        got[r["source"]] = (size + r["size"], target, taken + r["taken"])
    want = filled({s: size for s, (size, _, _) in got.items()})
    assert len(got) == 60 and any(abs(t - 2 * n) < 1e-6 for n, t, _ in got.values())
    for s, (_, target, taken) in got.items():
        assert abs(target - want[s]) < 1e-6 and abs(taken - target) <= 0.5 + 1e-6


def test_copies_of_a_repeated_row_are_dealt_as_one_sum(spark):
    rows = [(1, "five words are in here", "a", k % 2) for k in range(3000)] + [(i, "one two three " * 40, "b", 0) for i in range(2, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, other int")
    taken = {r["source"]: r["w"] for r in mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("w")).collect()}
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns
    words = {r["source"]: r["w"] for r in out.groupBy("source").agg(F.sum(F.size(F.split(F.trim("text"), " "))).alias("w")).collect()}
    assert abs(words["a"] - taken["a"]) <= 2 * 5  # a word per group of equal rows at most, not 3,000 times the same draw
    assert out.where("source = 'a'").groupBy("other").count().count() == 2
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, mixing.mix_documents(docs.repartition(7)).collect()))


def test_house_is_the_highest_quotients_for_every_shard(spark):
    aims = {k: (0.37 * (k * 37 % 101) + 0.01 * k, 10**6) for k in range(41)} | {41: (0.0, 5), 42: (900.5, 900), 43: (7.0, 7), 44: (7.0, 7)}
    df = spark.createDataFrame([(p, x, limit) for p, (x, limit) in aims.items()], "place long, blocks double, limit long")
    got = {r["place"]: r["seats"] for r in mixing.house(df, 7).collect()}
    order = sorted(((k - 0.5) / x, p) for p, (x, limit) in aims.items() for k in range(1, min(limit, int(x + 0.5)) + 1))
    for j in range(1, 8):
        seats = [p for _, p in order[:len(order) * j // 7]]
        assert {p: has[j - 1] for p, has in got.items()} == {p: seats.count(p) for p in aims}


def test_pieces_fill_the_quotas_of_every_shard(spark):
    rows = [(s, 10_000 * s + k, "w " * (20 + k % 90)) for s, n in ((1, 900), (2, 300), (3, 60)) for k in range(n)]
    docs = spark.createDataFrame(rows, "source int, doc_id long, text string").withColumn("source", F.concat(F.lit("s"), "source"))
    got = mixing.mix(docs, shards=5)
    words = {}
    for r in got.collect():
        assert sum(p["words"] for p in r["pieces"]) == r["taken"]
        for p in r["pieces"]:
            key = (r["source"], p["shard"])
            words[key] = words.get(key, 0) + p["words"]
    aims = {r["source"]: (r["source_size"], r["target"]) for r in got.select("source", "source_size", "target").distinct().collect()}
    blocks = {s: round(size / max(1, min(mixing.BLOCK, size // mixing.FEW))) for s, (size, _) in aims.items()}
    own = [(aims[s][1] * blocks[s] / aims[s][0], s) for s in sorted(aims)]
    order = sorted(((k - 0.5) / x, s) for x, s in own for k in range(1, int(x + 0.5) + 1))
    for j in range(5):
        part = [s for _, s in order[len(order) * j // 5:len(order) * (j + 1) // 5]]
        for s, (size, _) in aims.items():
            assert abs(words.get((s, j), 0) - part.count(s) * size / blocks[s]) <= part.count(s)  # a block's length, to one word
