"""The pipeline stage by stage, and the registered queries."""

from __future__ import annotations

import __spark_entry__
import corpus_pipeline
from tierflow.llm import feistel, latent, mixing, order_minhash
from tierflow.llm.common import table
from tierflow.session import stage


def test_stages(spark, sf):
    docs = table(spark, sf, "documents")
    kept = []
    for name, step in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        out = stage(step(spark, docs, sf), f"test-{name}")
        assert out.dtypes == docs.dtypes
        assert all(before[r["doc_id"]] == r["text"] for r in out.collect())
        kept.append((docs, out))
        docs = out
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near-duplicates", "decontamination", "mixing", "sharding"]

    bad = {r["doc_id"] for r in table(spark, sf, "labels").where("quality = 0").collect()}
    good = {r["doc_id"] for r in table(spark, sf, "labels").where("quality = 1").collect()}
    stays = {r["doc_id"] for r in kept[0][1].collect()}
    assert len(stays & bad) <= 0.1 * len(bad) and len(stays & good) >= 0.97 * len(good)

    one = order_minhash.near_duplicates(kept[1][0])
    assert sorted(r["doc_id"] for r in kept[1][1].collect()) == sorted(r["doc_id"] for r in one.where("kept").collect())
    leaks = {r["doc_id"] for r in latent.contaminated(kept[2][0], table(spark, sf, "benchmark")).collect()}
    assert {r["doc_id"] for r in kept[2][1].collect()} == {r["doc_id"] for r in kept[2][0].collect()} - leaks
    assert kept[3][1].count() == mixing.mix_documents(kept[3][0]).count() > 0
    places = feistel.manifest(docs).collect()
    assert len(places) == docs.count() and len({(r["shard"], r["slot"]) for r in places}) == len(places)


def test_run_is_reproducible(spark, sf):
    a, b = (sorted(map(tuple, corpus_pipeline.run(spark, sf).collect()), key=repr) for _ in range(2))
    assert a == b and a


def test_queries_are_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))
    assert set(__spark_entry__.oracle_sql()) <= set(names)
