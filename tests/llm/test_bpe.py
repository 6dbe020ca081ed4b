"""Operator 11 against the tokenizers library, a plain BPE loop and an exact round trip."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm import edge
from tierflow.llm import queries, trie_bpe
from tierflow.llm.common import table

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def vocabulary():
    return trie_bpe.Vocabulary.read(FILE)


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(FILE)
    t.no_padding()
    t.no_truncation()
    return t


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def merged(v, word: bytes) -> tuple[int, ...]:
    """BPE as it is defined: the earliest merge first, the leftmost of equal ones."""
    parts = [v.ids[bytes([b])] for b in word]
    while True:
        turns = [(v.merges[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in v.merges]
        if not turns:
            return tuple(parts)
        _, i = min(turns)
        parts[i : i + 2] = [v.ids[v.tokens[parts[i]] + v.tokens[parts[i + 1]]]]


def odd_texts(n: int) -> list[str]:
    rng = random.Random(5)
    pools = ["aaab", "-=*", "etaoin shrdlu", "0123456789", " \t\n\r\x0b 　", "äßéÑ漢字かな한글", "😀🏳️‍🌈é‍", "'s't'll'RE", "<|endoftext|>"]
    out = ["", " ", "<|endoftext|>", "a<|endoftext|> b", "<|endoftext", "it's  we'll   \n x", "x" * 700, "ab" * 5000, "漢" * 400, "   ", "\x00\x01é"]
    for _ in range(n):
        out.append("".join("".join(rng.choices(rng.choice(pools), k=rng.randint(1, 12))) for _ in range(rng.randint(1, 12))))
    return out


def test_against_the_library(vocabulary, library):
    texts = odd_texts(3000)
    mine = [i.tolist() for i in trie_bpe.Encoder(vocabulary).texts(texts)]
    theirs = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    wrong = [t for t, a, b in zip(texts, mine, theirs, strict=True) if a != b]
    assert not wrong, wrong[:3]


def test_paths_against_the_plain_loop(vocabulary):
    rng = random.Random(9)
    words = {bytes(rng.choices(pool, k=rng.randint(1, 30))) for pool in (b"ab", b"etaoins", bytes(range(256)), b" -=") for _ in range(300)}
    words = sorted(words)
    assert list(vocabulary.encodings(words)) == [merged(vocabulary, w) for w in words]
    for a, b in [(rng.choice([*vocabulary.ids.values()]), rng.choice([*vocabulary.ids.values()])) for _ in range(2000)]:
        assert vocabulary.stands(a, b) == (merged(vocabulary, vocabulary.tokens[a] + vocabulary.tokens[b]) == (a, b))


class Counted(dict):
    nodes = 0

    def get(self, piece):
        self.nodes += len(piece) == 1  # the first search of every node
        return super().get(piece)


def test_shared_prefixes_are_walked_once(vocabulary, monkeypatch):
    words = [" sharing" + x for x in ("", "s", "ly", "ness", "nesses")]
    work = trie_bpe.Encoder(vocabulary)
    monkeypatch.setitem(vocabulary.__dict__, "ends", Counted(vocabulary.ends))
    work.learn(set(words))
    assert vocabulary.ends.nodes == len({w[:k] for w in words for k in range(1, len(w) + 1)})
    assert all(work.known[w] == merged(vocabulary, w.encode()) for w in words)


class Searched(dict):
    searches = 0

    def get(self, piece):
        self.searches += 1
        return super().get(piece)


def test_a_node_takes_one_search(vocabulary, monkeypatch):
    words = [" internationally", " -------------------------------x", "etaoinshrdluetaoinshrdlu", "ab" * 40]
    work = trie_bpe.Encoder(vocabulary)
    monkeypatch.setitem(vocabulary.__dict__, "ends", Searched(vocabulary.ends))
    work.learn(set(words))
    assert vocabulary.ends.searches == len({w[:k] for w in words for k in range(1, len(w) + 1)})
    assert all(work.known[w] == merged(vocabulary, w.encode()) for w in words)


def test_steps_are_bounded(vocabulary, monkeypatch):
    monkeypatch.setattr(trie_bpe, "MEMO", 50)
    monkeypatch.setattr(trie_bpe, "PORTION", 40)
    work = trie_bpe.Encoder(vocabulary)
    for k in range(50):
        list(work.texts([f"w{k}ord{k * 7919}x and qz{k * 31}"]))
        assert sum(map(len, vocabulary.ends.values())) < 200


def test_memo_is_bounded(vocabulary, monkeypatch):
    monkeypatch.setattr(trie_bpe, "MEMO", 10)
    monkeypatch.setattr(trie_bpe, "PORTION", 40)
    work = trie_bpe.Encoder(vocabulary)
    texts = [f"word{i} and more{i}" for i in range(200)] + ["y" * 1000]
    assert [tuple(i) for i in work.texts(texts)] == [tuple(i) for i in trie_bpe.Encoder(vocabulary).texts(texts)]
    assert len(work.known) < 60 and not any(len(w) > trie_bpe.LONG for w in work.known)


def test_query(spark, sf, library):
    docs = {r["doc_id"]: r["text"] or "" for r in table(spark, sf, "documents").collect()}
    got = queries.op11_prefix_trie(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode(docs[r["doc_id"]], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), sha(",".join(map(str, ids))))
        assert r["decoded_sha256"] == sha(library.decode(ids, skip_special_tokens=False)) == sha(docs[r["doc_id"]])


def test_edge_rows(spark, library):
    docs = edge.documents(spark)
    out = trie_bpe.decode(trie_bpe.encode(docs, FILE), FILE)
    assert out.columns == [*docs.columns, "ids", "decoded"]
    rows = out.select("text", "ids", "decoded").collect()
    assert len(rows) == len(edge.ROWS)
    assert all(r["decoded"] == (r["text"] or "") and r["ids"] == library.encode(r["text"] or "", add_special_tokens=False).ids for r in rows)
    assert trie_bpe.round_trip(docs.where("false"), FILE).count() == 0
    clash = trie_bpe.encode(docs.withColumnsRenamed({"n": "ids", "m": "decoded"}), FILE)
    assert clash.schema["ids"].dataType.simpleString() == "array<int>"


def test_other_files_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        trie_bpe.Vocabulary.read(public_tokenizers.path("word_bpe_49k.json"))
