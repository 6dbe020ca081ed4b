"""Every operator over the edge rows, over empty tables and through its registered query."""

from __future__ import annotations

import pytest

from tests.llm import edge
from tierflow.llm import content_sort, entropy, factor, feistel, latent, mixing, order_minhash, pii, toxicity, url_rules

PER_ROW = {
    "op2": lambda s, d: toxicity.toxicity(d, edge.labels(s)),
    "op3": lambda s, d: order_minhash.near_duplicates(d),
    "op4": lambda s, d: mixing.mix(d),
    "op5": lambda s, d: content_sort.content_sort(d),
    "op6": lambda s, d: pii.find_pii(d),
    "op8": lambda s, d: feistel.manifest(d, 4),
    "op9": lambda s, d: entropy.find_secrets(d),
    "op10": lambda s, d: factor.quality(d, edge.labels(s)),
}
FILTERS = {
    "op3": lambda s, d: order_minhash.keep_one(d),
    "op4": lambda s, d: mixing.mix_documents(d),
    "op7": lambda s, d: latent.keep_clean(d, edge.benchmark(s)),
    "op10": lambda s, d: factor.keep_good(d, edge.labels(s)),
}


def ids(df):
    return sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=repr)


@pytest.mark.parametrize("op", PER_ROW)
def test_one_result_per_row(spark, op):
    docs = edge.documents(spark)
    assert ids(PER_ROW[op](spark, docs)) == ids(docs)


@pytest.mark.parametrize("op", PER_ROW)
def test_empty_table(spark, op):
    assert PER_ROW[op](spark, edge.documents(spark).where("false")).count() == 0


@pytest.mark.parametrize("op", FILTERS)
def test_filters_keep_columns(spark, op):
    docs = edge.documents(spark)
    out = FILTERS[op](spark, docs)
    assert out.dtypes == docs.dtypes
    known = {tuple(r) for r in docs.collect()}
    assert {tuple(r) for r in out.collect()} <= known
    empty = FILTERS[op](spark, docs.where("false"))
    assert empty.dtypes == docs.dtypes and empty.count() == 0


def test_results_of_the_edge_rows(spark):
    docs = edge.documents(spark)
    kept = [tuple(r) for r in order_minhash.near_duplicates(docs).collect()]
    same = [r for r in kept if r[1] == 1]
    assert sorted((r[0] for r in same), key=repr) == [1, 1, 2, None] and sum(r[2] for r in same) == 1
    assert sum(r[2] for r in kept if r[0] in (6, 7)) == 1  # a word more at the end is a near copy
    assert sum(r[2] for r in kept if r[0] in (3, 4, 5)) == 1  # texts without words are copies of each other
    mixed = mixing.mix(docs).collect()
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in mixed)
    assert {r["source_size"] for r in mixed if r["source"] is None} == {13 + 8}
    left = latent.keep_clean(docs, edge.benchmark(spark)).select("text").collect()
    assert edge.SAME not in {r["text"] for r in left} and len(left) == len(edge.ROWS) - 4
    assert latent.contaminated(docs.where("doc_id = 2"), edge.benchmark(spark)).select("item_id").orderBy("item_id").collect() == [(1,), (4,)]
    assert latent.contaminated(docs, edge.benchmark(spark).where("false")).count() == 0


def test_labels_of_one_class_or_none(spark):
    docs = edge.documents(spark)
    none = toxicity.toxicity(docs, edge.labels(spark).where("false")).select("score").distinct().collect()
    assert none == [(0.5,)]
    assert factor.quality(docs, edge.labels(spark).where("quality = 1")).where("score <= 0.5 OR score > 1").count() == 0


def test_urls(spark):
    pages = spark.createDataFrame([(1, None), (2, ""), (3, "no scheme/x"), (None, "http://EXAMPLE.com/en/1"), (5, "http://example.com"),
                                   (5, "http://example.com"), (6, "x://" + "a." * 5000 + "net/es/" + "b/" * 5000)], "page_id long, url string")
    got = url_rules.judge(pages.selectExpr("*", "'x' AS host", "'y' AS verdict")).collect()
    assert len(got) == 7
    by = {(r["page_id"], r["host"][:11], r["path"][:4]): (r["rule"], r["verdict"]) for r in got}
    assert by[1, "", ""] == by[2, "", ""] == by[3, "", ""] == (None, "allow")
    assert by[None, "example.com", "/en/"] == ("example.com/en/", "block")
    assert by[5, "example.com", ""][0] is None  # an empty path starts with no rule's
    assert by[6, "a.a.a.a.a.a", "/es/"] == ("net/es/", "block")
    assert url_rules.judge(pages.where("false")).count() == 0
