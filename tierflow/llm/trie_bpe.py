"""Operator 11: byte-level BPE by a prefix-sharing trie, and its decoding.

The encoding of a text is known from the last token of each of its prefixes: a
token t ends the prefix of length d if its bytes do and if it can stand after the
token that ends the prefix of length d - len(t).  Exactly one token can.  Whether
b can stand after a is decided by undoing their merges, the latest first: they
can't if at any time the two parts that met at the border would have merged
sooner (``stands``).

The distinct words of some texts that are not known yet make a trie of bytes.  It
is kept in preorder: the words sorted, each leaving the path of the one before it
where their bytes part.  The depth-first walk along it gives every node its last
token from those of its ancestors, so a prefix that many words share is encoded
once, and where a word ends its tokens are read backwards.  A node also knows the
longest beginning of a token that ends its prefix: one step by the next byte gives
that of its child, and with it every token that could be the last.  Tasks keep the
words they have met, up to ``MEMO`` of them, and those of over ``LONG`` characters
for their portion only.

The file is read by the driver and broadcast: its size is that of a vocabulary,
whatever the corpus.  Its special tokens are cut out of a text first, as the
tokenizers library does; the words between them are those of the byte-level
pattern.

Defined results: NULL and empty texts have no tokens and decode to ''; texts of
any length are encoded whole, in portions of whole texts; repeated rows give
repeated results; an empty table gives an empty result; other columns are kept,
except that ``encode`` and ``decode`` replace columns named ``ids`` and ``decoded``.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import chain

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.common import BATCH_ROWS

# fixed value: the words of byte-level BPE
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Words, answers about pairs of tokens, and steps, that a worker keeps before it starts anew.
MEMO = 600_000
#: Longer words are not kept.
LONG = 256
#: Characters whose words are held at a time (one text at least).
PORTION = 500_000


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the file: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Vocabulary:
    """Tokens by number, and the merges that make them."""

    tokens: list[bytes]
    merges: dict[tuple[int, int], int]  # two tokens to the turn of their merge
    made: dict[int, tuple[int, int, int]]  # token to (turn, left, right); single bytes are not made
    special: dict[str, int] = field(default_factory=dict)

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, letters = file["model"], byte_letters()
        plain = [t for t in file["added_tokens"] if not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"])]
        steps = file["pre_tokenizer"] or {}
        if (model["type"] != "BPE" or file["normalizer"] or steps.get("type") != "ByteLevel" or steps.get("add_prefix_space")
                or not steps.get("use_regex") or model.get("ignore_merges") or len(plain) < len(file["added_tokens"])):
            raise ValueError(f"{path} is not a plain byte-level BPE")
        special = {t["content"]: t["id"] for t in plain}
        number = model["vocab"]
        tokens = [b""] * (1 + max([*number.values(), *special.values()]))
        for text, i in number.items():
            tokens[i] = bytes(map(letters.__getitem__, text))
        for text, i in special.items():
            tokens[i] = text.encode()
        merges, made = {}, {}
        for turn, m in enumerate(model["merges"]):
            left, right = m.split(" ") if isinstance(m, str) else m
            a, b, both = number[left], number[right], number[left + right]
            if both in made:
                raise ValueError(f"{path}: two merges make token {both}")
            merges[a, b], made[both] = turn, (turn, a, b)
        return cls(tokens, merges, made, special)

    def stands(self, a: int, b: int, until: float = float("inf")) -> bool:
        """Whether a and b stay apart when their bytes are encoded together, up to turn ``until``."""
        merges, (turn, first, second) = self.merges, self.parts
        while True:
            if merges.get((a, b), until) < until:
                return False
            if turn[a] > turn[b]:
                until, a = turn[a], second[a]
            elif turn[b] >= 0:  # of equal merges the left one comes first
                until, b = turn[b] + 1, first[b]
            else:
                return True

    @cached_property
    def parts(self) -> tuple[list[int], list[int], list[int]]:
        """By token the turn of its merge, its left and its right part; -1 for single bytes."""
        rows = [self.made.get(i, (-1, -1, -1)) for i in range(len(self.tokens))]
        return tuple(map(list, zip(*rows, strict=True)))

    @cached_property
    def stood(self) -> dict[int, bool]:
        """What ``stands`` said of pairs that words have asked for; emptied when it has grown."""
        return {}

    @cached_property
    def ids(self) -> dict[bytes, int]:
        """The tokens that encoding can give: single bytes, and made ones whose parts meet before any other merge."""
        single = {t: i for i, t in enumerate(self.tokens) if len(t) == 1 and i not in self.special.values()}
        good = set(single.values())
        for i, (turn, a, b) in self.made.items():  # in turn, so parts come first
            if a in good and b in good and self.stands(a, b, turn):
                good.add(i)
        return {self.tokens[i]: i for i in good}

    @cached_property
    def starts(self) -> dict[bytes, int]:
        """All beginnings of tokens, numbered; the empty one is 0."""
        return {s: i for i, s in enumerate(dict.fromkeys(chain([b""], (t[:k] for t in self.ids for k in range(1, len(t) + 1)))))}

    @cached_property
    def tails(self) -> list[tuple[int, ...]]:
        """By beginning the tokens that end it, the longest first."""
        ids = self.ids
        return [tuple(ids[s[k:]] for k in range(len(s)) if s[k:] in ids) for s in self.starts]

    @cached_property
    def ends(self) -> dict[bytes, Steps]:
        """By byte the steps that it makes from one beginning to the next."""
        names = list(self.starts)
        return {t: Steps(t, self.starts, names) for t in self.ids if len(t) == 1}

    @cached_property
    def cut(self) -> regex.Pattern | None:
        """Splits a text at special tokens, the longest first."""
        names = sorted(self.special, key=len, reverse=True)
        return regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None

    def encodings(self, words: Iterable[bytes]) -> Iterator[tuple[int, ...]]:
        """The tokens of sorted distinct words, walked depth first as a trie.

        ``last`` has the last token of every prefix on the path, ``at`` the longest
        beginning of a token that ends the prefix.  The next token is the longest
        that ends the path and can stand after the one before it; all that end the
        path end that beginning.
        """
        step, tails, stood, stands, size = self.ends.get, self.tails, self.stood, self.stands, len(self.tokens)
        length = list(map(len, self.tokens))
        before, last, at = b"", [-1], [0]
        for word in words:
            d = shared(before, word)
            del last[d + 1 :], at[d + 1 :]
            start = at[d]
            for d in range(d + 1, len(word) + 1):
                steps = step(word[d - 1 : d])
                if steps is None:
                    raise ValueError("the vocabulary lacks a byte")
                start = steps[start]
                for token in tails[start]:
                    rest = d - length[token]
                    if not rest:
                        break
                    pair = last[rest] * size + token
                    apart = stood.get(pair)
                    if apart is None:
                        apart = stood[pair] = stands(last[rest], token)
                    if apart:
                        break
                at.append(start)
                last.append(token)
            out, d = [], len(word)
            while d:  # backwards from the word's end
                out.append(last[d])
                d -= length[last[d]]
            yield tuple(reversed(out))
            before = word

    def words(self, text: str) -> list[str | int]:
        """The words of a text, and its special tokens as numbers."""
        if not self.cut or not self.cut.search(text):
            return WORD.findall(text)
        parts = [[self.special[p]] if k % 2 else WORD.findall(p) for k, p in enumerate(self.cut.split(text))]
        return list(chain.from_iterable(parts))


class Steps(dict):
    """By beginning of a token (its number) the longest one that ends it with a byte added; filled as words ask."""

    def __init__(self, byte: bytes, starts: dict[bytes, int], names: list[bytes]) -> None:
        self.byte, self.starts, self.names = byte, starts, names

    def __missing__(self, start: int) -> int:
        path = self.names[start] + self.byte
        while path not in self.starts:
            path = path[1:]
        self[start] = self.starts[path]
        return self[start]


def shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    most, i = min(len(a), len(b)), 0
    while i < most and a[i] == b[i]:
        i += 1
    return i


class Packed(dict):
    """Words and special tokens to their token numbers: ``get`` gives these as bytes of int32, to be joined, [] as a tuple."""

    def __getitem__(self, word: str | int) -> tuple[int, ...]:
        return tuple(np.frombuffer(super().__getitem__(word), np.int32).tolist())


class Encoder:
    """Encodes texts with one vocabulary and the words met so far."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.known = Packed()

    def texts(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        held: list[list[str | int]] = []
        size = 0
        for t in texts:
            held.append(self.vocabulary.words(t))
            size += len(t)
            if size > PORTION:
                yield from self.portion(held)
                held, size = [], 0
        yield from self.portion(held)

    def portion(self, held: list[list[str | int]]) -> Iterator[np.ndarray]:
        steps = self.vocabulary.ends.values()
        for memos in ([self.known], [self.vocabulary.stood], steps):
            if sum(map(len, memos)) > MEMO:
                for memo in memos:
                    memo.clear()
        long = self.learn({w for w in set(chain.from_iterable(held)) if w not in self.known})
        for words in held:
            yield np.frombuffer(b"".join(map(self.known.get, words)), np.int32)
        for w in long:
            del self.known[w]

    def learn(self, new: set[str | int]) -> list[str]:
        """Encodes new words in one walk; returns those that are too long to be kept."""
        self.known.update((i, array("i", (i,)).tobytes()) for i in new if isinstance(i, int))
        words = sorted(w for w in new if isinstance(w, str))  # code points sort as their bytes do
        packed = (array("i", e).tobytes() for e in self.vocabulary.encodings(w.encode("utf-8", "surrogatepass") for w in words))
        self.known.update(zip(words, packed, strict=True))
        return [w for w in words if len(w) > LONG]


_ENCODERS: dict[str, Encoder] = {}  # of a worker process, which outlives its tasks


def encoder(name: str, vocabulary: Vocabulary) -> Encoder:
    if name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name] = Encoder(vocabulary)
    return _ENCODERS[name]


class Codec:
    """Column functions of one vocabulary file."""

    def __init__(self, spark: SparkSession, tokenizer: str) -> None:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        self.name = tokenizer
        self.sent = spark.sparkContext.broadcast(Vocabulary.read(tokenizer))

    def ids(self, text: Column) -> Column:
        name, sent = self.name, self.sent

        @F.pandas_udf("array<int>")
        def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            work = encoder(name, sent.value)
            for texts in batches:
                yield pd.Series(list(work.texts(t or "" for t in texts)), dtype=object)

        return tokens(text.cast("string"))

    def text(self, ids: Column) -> Column:
        sent = self.sent

        @F.pandas_udf("string")
        def joined(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            token = sent.value.tokens.__getitem__
            for many in batches:
                yield pd.Series([b"".join(map(token, i.tolist() if i is not None else ())).decode("utf-8", "replace") for i in many], dtype=object)

        return joined(ids)


def encode(documents: DataFrame, tokenizer: str) -> DataFrame:
    """``documents`` with ``ids``, the token numbers of their texts."""
    return documents.withColumn("ids", Codec(documents.sparkSession, tokenizer).ids(F.col("text")))


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``encoded`` with ``decoded``, the text that its ``ids`` stand for."""
    return encoded.withColumn("decoded", Codec(encoded.sparkSession, tokenizer).text(F.col("ids")))


def round_trip(documents: DataFrame, tokenizer: str) -> DataFrame:
    """Per document: n_tokens, and the digests of its token numbers and of the text they decode to."""
    both = decode(encode(documents.select("doc_id", "text"), tokenizer).select("doc_id", "ids"), tokenizer)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
