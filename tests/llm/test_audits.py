"""Operators 12 and 13 against plain loops, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from tests.llm import edge
from tierflow.llm import divergence, merkle, queries
from tierflow.llm.common import table
from tierflow.llm.merkle import append_log, fold, height, position, proofs_of, sha

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


# --- operator 12 -------------------------------------------------------------------

def divergences(rows: list[tuple], least: int = 3, ranks: int = 200) -> set[tuple]:
    """The audit as it is defined: every pair over every kept term."""
    docs = [((lang or ""), (source or ""), TERM.findall((text or "").translate(LOWER))) for text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = {t for t, n in df.items() if n >= least}
        counts = {s: Counter(t for d in mine if d[1] == s for t in d[2] if t in kept) for s in {d[1] for d in mine}}
        whole = sum(counts.values(), Counter())

        def share(c: Counter, t: str) -> int:
            return 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))

        p = {s: {t: share(c, t) for t in kept} for s, c in counts.items()}
        q = {t: share(whole, t) for t in kept}
        for s in p:
            pair = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in p if o != s]
            term = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pair), ("term", term)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, i, v, k) for k, (i, v) in enumerate(found, 1) if part == "pair" or k <= ranks}
    return out


def test_divergence_against_every_pair(spark):
    rng = random.Random(2)
    words = ["Ähre", "ähre", "One", "one's", "x1y", "漢字", "ΑΒΓ", "a_b", "THE", "the", "😀", "so", "rare", "ı"]
    rows = [(" ".join(rng.choices(words, k=rng.randint(0, 9))), rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "c", None, "ñ", ""])) for _ in range(300)]
    rows += [("the same text again", "en", s) for s in "aaaaaabbbccd"] + [(None, "fr", "z"), ("", "fr", "y"), ("lone words here", "it", "q")]
    got = divergence.audit(spark.createDataFrame(rows, "text string, lang string, source string"))
    found = [tuple(r) for r in got.collect()]
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert len(found) == len(set(found)) and set(found) == divergences(rows)


def test_divergence_of_edge_rows_and_small_tables(spark, monkeypatch):
    docs = edge.documents(spark)
    rows = [(r["text"], r["lang"], r["source"]) for r in docs.collect()]
    assert {tuple(r) for r in divergence.audit(docs).collect()} == divergences(rows)
    assert {tuple(r) for r in divergence.audit(docs, ranks=2).collect()} == divergences(rows, ranks=2)
    monkeypatch.setattr(divergence, "HELD", 3)  # every text hands its counts on
    assert {tuple(r) for r in divergence.audit(docs, least=1).collect()} == divergences(rows, least=1)
    assert divergence.audit(docs.where("false")).count() == 0


def test_a_text_is_tokenized_once(spark):
    rows = [("copied words " * 4, "en", f"s{i % 5}") for i in range(500)] + [("other words", "en", "s0")]
    groups, texts = divergence.collapsed(spark.createDataFrame(rows, "text string, lang string, source string"))
    held = texts.collect()
    assert len(held) == 2 and {s["n"] for r in held for s in r["sources"]} == {100, 1}
    assert groups.count() == 5


# --- operator 13 -------------------------------------------------------------------

def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(leaves: list[str]) -> tuple[str, list[list[str]], list[list[str]]]:
    """Root, and per leaf its siblings level by level and the runs that it is hashed in."""
    paths, runs = [[] for _ in leaves], [[] for _ in leaves]
    nodes, under = list(leaves), [[i] for i in range(len(leaves))]
    while len(nodes) > 1:
        up, covers = [], []
        for i in range(0, len(nodes), 2):
            run = nodes[i : i + 2]
            for k, members in enumerate(under[i : i + 2]):
                for leaf in members:
                    paths[leaf] += [n for j, n in enumerate(run) if j != k]
                    runs[leaf].append([None if j == k else n for j, n in enumerate(run)])
            up.append(h(*run))
            covers.append([x for m in under[i : i + 2] for x in m])
        nodes, under = up, covers
    return nodes[0], paths, runs


def manifest_rows(rows: list[tuple]) -> list[tuple]:
    """The contract, row by row; rows are (doc_id, source, lang, n_chars, text)."""
    def leaf(r):
        return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in r])

    def order(x):
        return (x is not None, x if not isinstance(x, str) else x.encode()) if x is not None else (False,)

    by = defaultdict(list)
    for r in rows:
        by[r[2]].append((r, leaf(r)))
    langs = sorted(by, key=order)
    subs = {}
    for lang in langs:
        by[lang].sort(key=lambda x: (order(x[0][0]), x[1]))
        subs[lang] = tree([x[1] for x in by[lang]])
    root, paths, runs = tree([subs[lang][0] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        for i, (r, made) in enumerate(by[lang]):
            way = subs[lang][2][i] + runs[k]
            changed = r if r[0] is None or zlib.crc32(str(r[0]).encode()) % 7 or r[3] is None else (*r[:3], r[3] + 1, r[4])
            node = leaf(changed)
            for run in way:
                node = h(*[node if x is None else x for x in run])
            out.append((r[0], made, subs[lang][0], root, h(*subs[lang][1][i], *paths[k]), node, node == root))
    return out


def test_positions_are_the_order_of_completion():
    for n in range(1, 70):
        leaves = [sha(str(i)) for i in range(n)]
        levels = height(n)
        log = append_log(leaves, levels)
        nodes, level, seen = leaves, 0, {}
        while True:
            for at, node in enumerate(nodes):
                seen[position(level, at, n, levels)] = node
            if len(nodes) == 1:
                break
            nodes, level = [sha("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)], level + 1
        assert sorted(seen) == list(range(len(log))) and [seen[i] for i in range(len(log))] == log
        assert {fold(leaf, p) for leaf, p in zip(leaves, proofs_of(log, n, levels), strict=True)} == {log[-1]}


@pytest.mark.parametrize("tier", [2, 10])
def test_manifest_against_plain_trees(spark, monkeypatch, tier):
    monkeypatch.setattr(merkle, "TIER", tier)
    rows = [(i, "s", lang, None if i % 5 == 0 else i, f"text é {i}") for lang, n in (("en", 37), ("de", 8), (None, 5), ("ñ", 1)) for i in range(n)]
    rows += [(7, "s", "en", 7, "another text of an id")] + [(3, None, "en", 3, None)] * 30 + [(None, "s", "de", 1, ""), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = sorted(map(tuple, merkle.audit(docs).collect()), key=repr)
    assert got == sorted(manifest_rows(rows), key=repr)
    assert any(not r[-1] for r in got) and sum(r[-1] for r in got) > len(got) / 2

    trees, over, root = merkle.manifest(docs)
    logged = defaultdict(dict)
    for r in merkle.log_rows(trees).collect():
        assert r["position"] not in logged[r["tree"]]
        logged[r["tree"]][r["position"]] = r["hash"]
    sizes = Counter(r[2] for r in rows)
    for lang, log in logged.items():
        assert sorted(log) == list(range(len(log))) and len(log) == 1 + position(height(sizes[lang]), 0, sizes[lang], height(sizes[lang]))
        assert log[len(log) - 1] in {r[2] for r in got}  # a tree's root comes last
    last = merkle.log_rows(over).orderBy("position").collect()[-1]
    assert last["hash"] == root == got[0][3]


def test_manifest_of_edge_rows(spark):
    docs = edge.documents(spark).selectExpr("*", "cast(length(text) AS long) AS n_chars")
    rows = [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, merkle.audit(docs).collect()), key=repr) == sorted(manifest_rows(rows), key=repr)
    empty = merkle.audit(docs.where("false"))
    assert empty.count() == 0 and empty.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    one = merkle.audit(docs.where("doc_id = 4")).collect()
    assert one[0]["leaf"] == one[0]["subroot"] == one[0]["root"] and one[0]["proof_sha256"] == h()


@pytest.mark.parametrize("name", ["op12_duplicate_collapse", "op13_merkle_manifest"])
def test_queries_against_sql(spark, sf, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{sf}/documents.parquet')")
    got = queries.QUERIES[name](spark, sf)
    theirs = con.sql(queries.ORACLE[name])
    assert got.columns == theirs.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(theirs.fetchall(), key=repr)
    assert table(spark, sf, "documents").count() == 200
