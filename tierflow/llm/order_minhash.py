"""Operator 3: near-duplicates by order MinHash, verified by banded alignment.

A text is the sequence of its five-word shingles (k-mers), each labelled with
its occurrence number so that all elements differ.  A sketch takes, per hash
function, the ``ELEMENTS`` labelled k-mers with the smallest hashes and keeps
them in text order: equal sketches ask for the same k-mers in the same order.

Texts that share a sketch form a bucket, and every pair of a bucket that is not
of one class already is compared.  A bucket of up to ``CHUNK`` texts is compared
by one task.  A larger one first goes through rounds that make its classes fewer:
in each, two classes are drawn by hash, each with one of its texts, and every text
of the bucket is paired with those of the two that are not of its own class, under
2m pairs for m texts.  It leaves the rounds when one of them absorbs less than a
quarter of its classes.  What then still has several classes is cut into chunks
of about ``CHUNK`` texts, and all pairs of chunks are compared, but for chunks of
one and the same class.  So the rounds only save work and decide nothing; the
work left grows with the square of the texts that share a sketch and are unlike.

A pair is a link when its alignment, the longest common subsequence of labelled
k-mers, is at least ``SIMILARITY`` of the union:  L / (n + m - L).  Any alignment
that good keeps matches within a band around the diagonal, so only matches
inside it are aligned; a pair whose lengths or number of equal k-mers forbid it
is not.  Links between distinct texts make the classes.

Equal texts are one node: copies are counted before anything is shuffled.

Defined results: NULL counts as an empty text; texts of fewer than five words
are one k-mer of all their words, so they link only to texts of the same words;
rows without an id form classes like others, and a class's id is its least id
(NULL only if it has no other); of repeated rows one is kept; an empty table
gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import collapse, expand, map_batches, text_or_empty
from tierflow.llm.components import stars
from tierflow.llm.features import MEMO
from tierflow.session import stage

SHINGLE = 5
SIMILARITY = 0.8
#: At similarity 0.8 one sketch agrees with a chance of about 0.8^5; all 20 miss with 0.0004.
SKETCHES = 20
ELEMENTS = 5
#: Texts, and labelled k-mers, of a chunk: a task compares two chunks at a time.
CHUNK, CHUNK_KMERS = 256, 1 << 19
#: A large bucket stays in the rounds while one leaves at most this share of its classes.
STAYS = 0.75

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)
_SEEDS = np.random.default_rng(31).integers(1, 2**63, SKETCHES, dtype=np.uint64)


class WordHashes(dict):
    """Word to 32-bit hash; emptied when it has grown, so that its size is bounded."""

    def __missing__(self, word: str) -> int:
        h = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        return h

    def sequence(self, text: str) -> np.ndarray:
        if len(self) > MEMO:
            self.clear()
        return np.array(list(map(self.__getitem__, text.split())), np.uint32)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX2
    return h ^ (h >> np.uint64(27))


def labelled(words: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of the labelled k-mers of a word sequence, in text order."""
    w = words.astype(np.uint64) + np.uint64(1)
    k = min(shingle, len(w))
    n = len(w) - k + 1 if k else 1
    h = np.full(n, len(w) if len(w) < shingle else 0, np.uint64)
    for j in range(k):
        h = mix(h * _MIX + w[j : j + n])
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = s[1:] == s[:-1]
    if same.any():
        starts = np.flatnonzero(np.concatenate(([True], ~same)))
        nth = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
        occurrence = np.empty(n, np.uint64)
        occurrence[order] = nth
        h = mix(h + occurrence * _MIX)
    return h


def sketches(kmers: np.ndarray, seeds: np.ndarray = _SEEDS, elements: int = ELEMENTS) -> np.ndarray:
    """One 64-bit key per hash function: its smallest k-mers, in text order."""
    out = np.empty(len(seeds), np.uint64)
    step = max(1, 2_000_000 // len(kmers))
    for a in range(0, len(seeds), step):
        part = seeds[a : a + step]
        h = mix((kmers[None, :] ^ part[:, None]) * _MIX)
        take = min(elements, h.shape[1])
        at = np.sort(np.argpartition(h, take - 1, axis=1)[:, :take] if take < h.shape[1] else np.tile(np.arange(take), (len(part), 1)), axis=1)
        key = part.copy()
        for j in range(take):
            key = mix(key * _MIX + kmers[at[:, j]])
        out[a : a + step] = key
    return out.view(np.int64)


def alignment(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """L / (n + m - L) for the banded longest common subsequence of two k-mer sequences.

    0.0 as soon as ``least`` is out of reach.  All elements of a sequence
    differ, so the subsequence is the longest increasing run of positions.
    """
    n, m = len(a), len(b)
    if min(n, m) < least * max(n, m):
        return 0.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    band = (n + m) - 2 * (least * (n + m) / (1 + least)) + 1  # most elements that stay unmatched
    near = np.abs(i - j) <= band
    i, j = i[near], j[near]
    if len(i) < least * (n + m - len(i)):
        return 0.0
    j = j[np.argsort(i)]
    length = len(j) if (np.diff(j) > 0).all() else increasing(j)
    return length / (n + m - length)


def increasing(values: np.ndarray) -> int:
    from bisect import bisect_left

    tails: list[int] = []
    for v in values.tolist():
        at = bisect_left(tails, v)
        if at == len(tails):
            tails.append(v)
        else:
            tails[at] = v
    return len(tails)


def key_of(*parts: Column) -> Column:
    """A 16-byte digest; NULL parts differ from empty ones."""
    marked = [F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("")) for p in parts]
    return F.unhex(F.substring(F.sha2(F.concat_ws("\x00", *marked).cast("binary"), 256), 1, 32))


def sketch_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for b in batches:
        kmers = [labelled(hashes.sequence(x)) for x in b.text]
        yield pd.DataFrame({"doc_id": b.doc_id, "t": b.t, "n": [len(k) for k in kmers], "keys": [sketches(k) for k in kmers]})


def sequence_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for b in batches:
        yield pd.DataFrame({"t": b.t, "words": [hashes.sequence(x).tobytes() for x in b.text]})


def verify_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        made: dict[bytes, np.ndarray] = {}

        def kmers(t: bytes, words: bytes) -> np.ndarray:
            if t not in made:
                made[t] = labelled(np.frombuffer(words, np.uint32))
            return made[t]

        ok = [alignment(kmers(u, x), kmers(v, y)) >= SIMILARITY for u, v, x, y in zip(b.u, b.v, b.uw, b.vw, strict=True)]
        yield b.loc[ok, ["ru", "rv"]]


def common(kmers: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """How many labelled k-mers each two of the sequences have in common."""
    who = np.repeat(np.arange(len(kmers)), [len(k) for k in kmers])
    _, place, times = np.unique(np.concatenate(kmers), return_inverse=True, return_counts=True)
    shared = np.cumsum(times > 1) - 1
    held = times[place] > 1
    who, place = who[held], shared[place[held]]
    order = np.argsort(place, kind="stable")
    who, place = who[order], place[order]
    out = np.zeros((len(kmers), len(kmers)))
    for at in range(0, int(place[-1]) + 1 if len(place) else 0, columns):  # bounds the table of k-mers
        part = slice(*np.searchsorted(place, (at, at + columns)))
        table = np.zeros((len(kmers), columns), np.float32)
        table[who[part], place[part] - at] = 1
        out += table @ table.T
    return out


def links_of(roots: list[bytes], sides: np.ndarray, kmers: list[np.ndarray]) -> Iterator[tuple[bytes, bytes]]:
    """Links that join the classes of these texts: of all pairs, or of those between two sides."""
    parent = {r: r for r in roots}

    def find(r: bytes) -> bytes:
        while parent[r] != r:
            parent[r] = r = parent[parent[r]]
        return r

    n = np.array([len(k) for k in kmers], float)
    same = common(kmers)
    able = same >= SIMILARITY * (n[:, None] + n[None, :] - same)
    able &= np.triu(np.ones(able.shape, bool), 1)
    if sides.any():
        able &= sides[:, None] != sides[None, :]
    for i, j in np.argwhere(able).tolist():
        a, b = find(roots[i]), find(roots[j])
        if a != b and alignment(kmers[i], kmers[j]) >= SIMILARITY:
            parent[b] = a
            yield roots[i], roots[j]


def compare_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links (ru, rv) of every (key, lo, hi); the rows of each come one after another."""
    def links(rows: list[tuple]) -> pd.DataFrame:
        kmers = [labelled(np.frombuffer(r[5], np.uint32)) for r in rows]
        found = list(links_of([r[4] for r in rows], np.array([r[3] for r in rows]), kmers))
        return pd.DataFrame({"ru": [u for u, _ in found], "rv": [v for _, v in found]}, dtype=object)

    held: list[tuple] = []
    for b in batches:
        for r in zip(b.key, b.lo, b.hi, b.side, b.root, b.words, strict=True):
            if held and held[0][:3] != r[:3]:
                yield links(held)
                held = []
            held.append(r)
    if held:
        yield links(held)


def turn_order(root: Column, turn: int) -> Column:
    """A turn's order of the classes, the same in every bucket."""
    return F.xxhash64(root, F.lit(turn))


def candidate_pairs(members: DataFrame, turn: int) -> DataFrame:
    """Distinct (u, v) of one round with their classes (ru, rv), from the rows (key, t, n, root) of the buckets."""
    drawn = members.groupBy("key", "root").agg(F.min(F.struct(F.xxhash64("t", "key", F.lit(turn)).alias("h"), "t", "n")).alias("d"))
    first = F.struct(turn_order(F.col("root"), turn).alias("h"), "root", F.col("d.t").alias("t"), F.col("d.n").alias("n"))
    other = F.struct(F.xxhash64("root", "key", F.lit(turn)).alias("h"), "root", F.col("d.t").alias("t"), F.col("d.n").alias("n"))
    # the first of the turn's order, and another one that each bucket draws for itself
    ends = (drawn.groupBy("key").agg(F.min(first).alias("a"), F.max(other).alias("b"), F.min("root").alias("lo"), F.max("root").alias("hi"))
            .where("lo <> hi").select("key", F.array("a", "b").alias("ends")))
    pairs = members.join(ends, "key").select("t", "n", "root", F.explode(F.array_distinct("ends")).alias("e")).where("root <> e.root")
    pairs = pairs.where(F.least("n", "e.n") >= SIMILARITY * F.greatest("n", "e.n"))
    less = F.col("t") < F.col("e.t")
    return pairs.select(F.least("t", "e.t").alias("u"), F.greatest("t", "e.t").alias("v"),
                        F.when(less, F.col("root")).otherwise(F.col("e.root")).alias("ru"),
                        F.when(less, F.col("e.root")).otherwise(F.col("root")).alias("rv")).distinct()


def absorbed(links: DataFrame, turn: int) -> DataFrame:
    """(root, into): the classes that have a link to one before them in the turn's order, and the first such."""
    ends = links.select(F.explode(F.array(F.struct(F.col("ru").alias("root"), F.col("rv").alias("into")),
                                          F.struct(F.col("rv").alias("root"), F.col("ru").alias("into")))).alias("e")).select("e.*")
    ends = ends.where(turn_order(F.col("into"), turn) < turn_order(F.col("root"), turn))
    best = F.min(F.struct(turn_order(F.col("into"), turn).alias("h"), "into")).alias("b")
    return ends.groupBy("root").agg(best).select("root", F.col("b.into").alias("into"))


def whole_buckets(members: DataFrame, words: DataFrame) -> DataFrame:
    """Links (ru, rv) among all texts of different classes in a bucket, from the rows (key, t, n, root)."""
    sized = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("kmers"))
    several = sized.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("key")
    # a class that fills a chunk has chunks of its own, which are not compared with each other
    alone = sized.where((F.col("m") > CHUNK) | (F.col("kmers") > CHUNK_KMERS)).select("key", "root", F.hex("root").alias("alone"))
    rows = members.join(several, "key").join(alone, ["key", "root"], "left").withColumn("alone", F.coalesce("alone", F.lit("")))
    parts = rows.groupBy("key", "alone").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / CHUNK), F.ceil(F.sum("n") / CHUNK_KMERS)).cast("int").alias("parts"))
    chunk = F.concat_ws(":", "alone", "chunk")
    rows = stage(rows.join(parts, ["key", "alone"]).withColumn("chunk", F.pmod(F.xxhash64("t", F.lit(5)), F.col("parts")))
                 .select("key", "t", "root", chunk.alias("chunk")), "near-chunks")
    chunks = parts.select("key", "alone", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("chunk"))
    lo, hi = (chunks.select("key", F.col("alone").alias(f"{x}_alone"), chunk.alias(x)) for x in ("lo", "hi"))
    tasks = lo.join(hi, "key").where("lo <= hi AND (lo_alone = '' OR lo_alone <> hi_alone)").select("key", "lo", "hi")
    sides = F.when(F.col("lo") == F.col("hi"), F.array(F.struct(F.col("lo").alias("chunk"), F.lit(0).alias("side")))).otherwise(
        F.array(F.struct(F.col("lo").alias("chunk"), F.lit(0).alias("side")), F.struct(F.col("hi").alias("chunk"), F.lit(1).alias("side"))))
    dealt = tasks.select("key", "lo", "hi", F.inline(sides)).join(rows, ["key", "chunk"]).join(words, "t")
    dealt = (dealt.select("key", "lo", "hi", "side", "root", "words").repartition("key", "lo", "hi")
             .sortWithinPartitions("key", "lo", "hi", "side"))
    return map_batches(dealt, compare_rows, "ru binary, rv binary")


def classes(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, groups): rows (doc_id, t, _w_n) and, per text t, its class: class_id and the text that stays."""
    text = text_or_empty()
    texts = documents.select("doc_id", key_of(text).alias("t"), text.alias("text"))
    made = stage(map_batches(texts.select(F.col("doc_id").cast("long"), "t", "text"), sketch_rows,
                             "doc_id long, t binary, n int, keys array<long>"), "sketches")
    rows = collapse(made.select("doc_id", "t"), "near-rows")
    nodes = stage(made.groupBy("t").agg(F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("keys").alias("keys")), "near-nodes")

    members = nodes.select("t", "n", F.explode("keys").alias("key"))
    # of buckets with the same texts one is enough
    shared = (members.groupBy("key").agg(F.count(F.lit(1)).alias("m"), *[F.bit_xor(F.xxhash64("t", F.lit(i))).alias(f"h{i}") for i in (1, 2)])
              .where("m > 1").groupBy("m", "h1", "h2").agg(F.min("key").alias("key")).select("key", "m"))
    members = stage(members.join(shared, "key"), "near-buckets")
    # of each candidate text the row with its first id: copies of one text do not meet in one task
    needed = (members.select("t").distinct().join(nodes.select("t", "first_id"), "t")
              .select(F.col("t").alias("_t"), "first_id"))
    # the candidates grow with the corpus: their join is planned as a shuffle at every size
    one_each = (texts.join(needed.hint("merge"), (F.col("t") == F.col("_t")) & F.col("doc_id").cast("long").eqNullSafe(F.col("first_id")))
                .select("t", "text").dropDuplicates(["t"]))
    words = stage(map_batches(one_each, sequence_rows, "t binary, words binary"), "near-words")

    # a text's root is some text of its class, at first itself; links are kept between roots and closed once, at the end
    large = members.where(F.col("m") > CHUNK).select("key", "t", "n", F.col("t").alias("root"), F.col("m").alias("had"))
    place, found, tested, turn = None, [], None, 0
    while not large.isEmpty():
        pairs = candidate_pairs(large, turn)
        if tested is not None:
            pairs = pairs.join(tested, ["u", "v"], "left_anti")
        pairs = stage(pairs, "near-pairs")
        tested = pairs.select("u", "v") if tested is None else tested.unionByName(pairs.select("u", "v"))
        both = (pairs.join(words.select(F.col("t").alias("u"), F.col("words").alias("uw")), "u")
                .join(words.select(F.col("t").alias("v"), F.col("words").alias("vw")), "v"))
        found.append(stage(map_batches(both.select("u", "v", "ru", "rv", "uw", "vw"), verify_rows, "ru binary, rv binary"), "near-links"))
        merged = stage(absorbed(found[-1], turn), "near-places")
        place = words.select("t", F.col("t").alias("root")) if place is None else place
        place = place.join(merged, "root", "left").select("t", F.coalesce("into", "root").alias("root"))
        turn += 1
        grown = large.join(merged, "root", "left").withColumn("root", F.coalesce("into", "root")).drop("into")
        left = grown.groupBy("key", "root").agg(F.first("had").alias("had")).groupBy("key").agg(F.count(F.lit(1)).alias("has"), F.first("had").alias("had"))
        left = left.where((F.col("has") > 1) & (F.col("has") <= STAYS * F.col("had"))).select("key", F.col("has").alias("had"))
        large = stage(grown.drop("had").join(left, "key"), "near-buckets")

    rest = stage(members.join(place, "t").select("key", "t", "n", "root"), "near-buckets") if turn else members.withColumn("root", F.col("t"))
    links = whole_buckets(rest, words)
    for more in found:
        links = links.unionByName(more)
    closed = stars(links.select(F.col("ru").alias("u"), F.col("rv").alias("v"))).select(F.col("u").alias("t"), "root")

    placed = nodes.select("t", "first_id").join(closed, "t", "left")
    placed = placed.select("t", "first_id", F.coalesce("root", "t").alias("root"))
    best = placed.groupBy("root").agg(F.min(F.struct(F.col("first_id").isNull().alias("n"), "first_id", "t")).alias("b"))
    groups = placed.join(best, "root").select("t", F.col("b.first_id").alias("class_id"), F.col("b.t").alias("keep_t"))
    return rows, stage(groups, "near-classes")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id (least id of its class) and kept (one row per class)."""
    rows, groups = classes(documents)
    placed = expand(rows.join(groups, "t"))
    kept = (F.col("t") == F.col("keep_t")) & F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("_w_copy") == 0)
    return placed.select("doc_id", "class_id", kept.alias("kept"))


def keep_one(documents: DataFrame) -> DataFrame:
    """The documents, one of each class, with all their columns.

    Of several rows with the id and text that stay, the first by all their columns is kept.
    """
    _, groups = classes(documents)
    keep = groups.where("t = keep_t").select(key_of(F.hex("t"), F.col("class_id")).alias("_w_row"))
    row = key_of(F.hex(key_of(text_or_empty())), F.col("doc_id").cast("long"))
    # rows of one id and text are told apart by a digest of their other columns; only equal rows share it
    others = key_of(*[F.to_json(F.struct(F.col(f"`{c}`").alias("v"))) for c in documents.columns if c != "text"])
    marked = documents.withColumns({"_w_row": row, "_w_all": others})
    first = marked.select("_w_row", "_w_all").join(keep, "_w_row", "left_semi").groupBy("_w_row").agg(F.min("_w_all").alias("_w_all"))
    return marked.join(first, ["_w_row", "_w_all"], "left_semi").dropDuplicates(["_w_row"]).drop("_w_row", "_w_all")
