"""The registered queries of the operators, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierflow.llm import (content_sort, divergence, entropy, factor, feistel, latent, merkle, mixing, order_minhash, pii, spans, toxicity,
                          trie_bpe, url_rules)
from tierflow.llm.common import table


def op1_association_rules(spark, sf_dir):
    return url_rules.judge(table(spark, sf_dir, "pages"))


def op2_counterfactual(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_order_minhash(spark, sf_dir):
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_sainte_lague(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_content_sort(spark, sf_dir):
    return content_sort.content_sort(table(spark, sf_dir, "documents"))


def op6_weak_supervision(spark, sf_dir):
    found = pii.find_pii(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("doc_id", *spans.digest(F.col("pii"), pii.BASE_KINDS))


def op7_latent_semantic(spark, sf_dir):
    return latent.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_feistel(spark, sf_dir):
    return feistel.manifest(table(spark, sf_dir, "documents"))


def op9_entropy(spark, sf_dir):
    found = entropy.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *spans.digest(F.col("secrets"), entropy.BASE_KINDS))


def op10_factorisation_machine(spark, sf_dir):
    return factor.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_prefix_trie(spark, sf_dir):
    import public_tokenizers

    return trie_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op12_duplicate_collapse(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark, sf_dir):
    return merkle.audit(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_association_rules, op2_counterfactual, op3_order_minhash, op4_sainte_lague, op5_content_sort,
    op6_weak_supervision, op7_latent_semantic, op8_feistel, op9_entropy, op10_factorisation_machine,
    op11_prefix_trie, op12_duplicate_collapse, op13_merkle_manifest)}
ORACLE = {"op5_content_sort": content_sort.ORACLE_SQL, "op12_duplicate_collapse": divergence.ORACLE_SQL,
          "op13_merkle_manifest": merkle.ORACLE_SQL}
