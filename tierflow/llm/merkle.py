"""Operator 13: Merkle manifest of a dataset, kept as a postorder append log.

A document is a leaf, the hash of its columns.  The leaves of one language
ascend by id and form a binary tree; the roots of the languages, in order, form
one more.  A node without a neighbour is hashed alone.

Aligned builders each own ``2 ** TIER`` consecutive nodes, a whole subtree.  A
builder appends a node to its log as soon as the node is complete, which is
postorder, so no index is kept: ``position`` computes a node's place from the
sizes of the subtrees before it.  The builders' tops are the nodes of the next
tier, built alike, until one node is left per tree; every tier has
``2 ** TIER`` times fewer rows.  A proof reads the siblings of a leaf at their
computed places, then those of its builder's top one tier up.

Equal rows are counted before they are shuffled and laid out as runs, so the
builders, not one task, expand a row that a third of the table repeats.

Defined results: a NULL column hashes as ``-``; a NULL id sorts first and is
never tampered with; rows of one id sort by their leaves; repeated rows are
leaves of their own, each with its own proof; empty texts have length 0 and long
ones are hashed whole; an empty table gives an empty result; a lone language's
root is the root; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.common import collapse
from tierflow.session import empty_frame, stage

#: Levels of the subtree that one builder owns: 1,024 nodes.
TIER = 10
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Of a proof: the sibling stands left or right, or there is none.
ENTRY = re.compile(r"([LR])([0-9a-f]{64})|(-)")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(nodes: int) -> int:
    return max(0, nodes - 1).bit_length()


def position(level: int, at: int, nodes: int, levels: int) -> int:
    """Place in the postorder log of node ``at`` of ``level``, in a tree of ``levels`` over ``nodes`` leaves.

    Before it come, on its own level and below, all nodes up to its last leaf,
    and above, the nodes that end before its first leaf.
    """
    first, end = at << level, min((at + 1) << level, nodes)
    return sum(-(-end >> k) for k in range(level + 1)) + sum(first >> k for k in range(level + 1, levels + 1)) - 1


def append_log(leaves: list[str], levels: int) -> list[str]:
    """All nodes over ``leaves``, in the order in which they become complete."""
    log: list[str] = []
    waiting = [""] * (levels + 1)  # by level, the left node whose neighbour is still to come
    for i, node in enumerate(leaves, 1):
        log.append(node)
        level = 0
        while level < levels and i % (2 << level) == 0:
            node = sha(waiting[level] + node)
            log.append(node)
            level += 1
        waiting[level] = node
    edge, n = "", len(leaves)  # close the nodes that the last leaf leaves open
    for level in range(levels):
        if n % (2 << level):
            alone = -(-n >> level) % 2
            if alone:
                edge = sha(edge if n % (1 << level) else waiting[level])
            else:
                edge = sha(waiting[level] + edge)
            log.append(edge)
    return log


def proofs_of(log: list[str], nodes: int, levels: int) -> list[str]:
    """Per leaf the siblings on its way up, each found at its computed place in the log."""
    above = [""]
    for level in range(levels - 1, -1, -1):
        count = -(-nodes >> level)
        here = []
        for at in range(count):
            beside = at ^ 1
            if beside < count:
                entry = ("L" if at & 1 else "R") + log[position(level, beside, nodes, levels)]
            else:
                entry = "-"
            here.append(entry + above[at >> 1])
        above = here
    return above


def fold(leaf: str, proof: str) -> str:
    """The root that a leaf and its proof lead to."""
    for side, other, _ in ENTRY.findall(proof):
        leaf = sha(other + leaf if side == "L" else leaf + other)
    return leaf


def leaf_hash(n_chars: Column | None = None) -> Column:
    """The leaf of a row: sha256 over length-prefixed columns, ``-`` for NULL."""
    parts = []
    for name in COLUMNS:
        value = (F.col(name) if name != "n_chars" or n_chars is None else n_chars).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``first`` (leaves of the tree before the row) and ``size`` (leaves of the tree).

    ``rows`` have ``tree`` and ``_w_n``, the number of their copies.  They are range
    partitioned and counted in order inside each task; one narrow row per task
    and tree then carries the counts from task to task.
    """
    by = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("part", F.spark_partition_id())

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, total = object(), 0
        for b in batches:
            before = []
            for t, n in zip(b.column("tree").to_pylist(), b.column("_w_n").to_pylist(), strict=True):
                if t != tree:
                    tree, total = t, 0
                before.append(total)
                total += n
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(before, pa.int64())], [*b.schema.names, "before"])

    counted = stage(ranged.mapInArrow(running, T.StructType([*ranged.schema.fields, T.StructField("before", T.LongType())])), "merkle-ranks")
    sums = counted.groupBy(F.col("tree").alias("_t"), F.col("part").alias("_p")).agg(F.sum("_w_n").alias("n"))
    earlier = Window.partitionBy("_t").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_t", "_p", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("off"),
                       F.sum("n").over(Window.partitionBy("_t")).alias("size"))
    out = counted.join(sums, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("part") == F.col("_p")))
    return out.withColumn("first", F.col("off") + F.col("before")).drop("_t", "_p", "off", "before", "part")


def runs(rows: DataFrame) -> DataFrame:
    """Rows (tree, size, first, _w_n, hash, row) cut at the builders' borders: (tree, block, size, start, n, hash, row)."""
    width = 1 << TIER
    last = F.col("first") + F.col("_w_n") - 1
    out = rows.withColumn("block", F.explode(F.sequence(F.shiftright("first", TIER), F.shiftright(last, TIER))))
    base = F.col("block") * width
    start = F.greatest("first", base)
    return out.select("tree", "block", "size", (start - base).cast("int").alias("start"),
                      (F.least(last + 1, base + width) - start).cast("int").alias("n"), "hash", "row")


def segments(nodes: DataFrame, name: str) -> DataFrame:
    """One row per builder: its log, its top and the rows of its nodes."""
    row = nodes.schema["row"].dataType
    schema = T.StructType([
        nodes.schema["tree"], nodes.schema["block"], T.StructField("size", T.LongType()), T.StructField("count", T.IntegerType()),
        T.StructField("log", T.ArrayType(T.StringType())), T.StructField("top", T.StringType()),
        T.StructField("runs", T.ArrayType(T.StructType([T.StructField("n", T.IntegerType()), T.StructField("row", row)])))])

    def build(held: pa.Table) -> pa.Table:
        held = held.sort_by("start").combine_chunks()
        size = held.column("size")[0].as_py()
        hashes = [h for h, n in zip(held.column("hash").to_pylist(), held.column("n").to_pylist(), strict=True) for _ in range(n)]
        log = append_log(hashes, min(TIER, height(size)))
        runs = pa.StructArray.from_arrays([held.column("n").chunk(0), held.column("row").chunk(0)], ["n", "row"])
        return pa.table([
            held.column("tree").slice(0, 1), held.column("block").slice(0, 1), pa.array([size], pa.int64()),
            pa.array([len(hashes)], pa.int32()), pa.array([log], pa.list_(pa.string())), pa.array([log[-1]], pa.string()),
            pa.ListArray.from_arrays(pa.array([0, held.num_rows], pa.int32()), runs)], schema.names)

    return stage(nodes.groupBy("tree", "block").applyInArrow(build, schema), name)


def grow(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The tiers over the runs of the leaves, the lowest first."""
    tiers = [segments(nodes, f"{name}-0")]
    while True:
        above = F.shiftright(F.col("size") + ((1 << TIER) - 1), TIER)
        tops = tiers[-1].select("tree", F.col("block").alias("first"), above.alias("size"), F.lit(1).cast("long").alias("_w_n"),
                                F.col("top").alias("hash"), F.struct(F.col("block").alias("idx")).alias("row")).where("size > 1")
        if tops.isEmpty():
            return tiers
        tiers.append(segments(runs(tops), f"{name}-{len(tiers)}"))


def roots(tiers: list[DataFrame]) -> DataFrame:
    """(tree, hash): the tops of the builders that own a whole tree."""
    done = [t.where(F.col("size") <= (1 << TIER)).select("tree", F.col("top").alias("hash")) for t in tiers]
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def extract(tier: DataFrame, above: DataFrame) -> DataFrame:
    """(tree, row, leaf, subroot, proof) of a tier's nodes; ``above`` has (tree, idx, up, subroot) of its builders' tops."""
    above = above.select(F.col("tree").alias("_t"), F.col("idx").alias("_i"), "up", "subroot")
    held = tier.join(above, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("block") == F.col("_i")))
    held = held.select("tree", "size", "count", "log", "runs", "up", "subroot")
    schema = T.StructType([tier.schema["tree"], T.StructField("row", tier.schema["runs"].dataType.elementType["row"].dataType),
                           *[T.StructField(c, T.StringType()) for c in ("leaf", "subroot", "proof")]])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                one = {c: b.column(c)[k] for c in b.schema.names}
                log, nodes, levels = one["log"].as_py(), one["count"].as_py(), min(TIER, height(one["size"].as_py()))
                up = one["up"].as_py()
                made = one["runs"].values
                which = pa.array([r for r, n in enumerate(made.field("n").to_pylist()) for _ in range(n)], pa.int32())
                leaves = [log[position(0, at, nodes, levels)] for at in range(nodes)]
                proofs = [p + up for p in proofs_of(log, nodes, levels)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([one["tree"].as_py()] * nodes, pa.string()), made.field("row").take(which), pa.array(leaves, pa.string()),
                    pa.array([one["subroot"].as_py()] * nodes, pa.string()), pa.array(proofs, pa.string())], schema.names)

    return held.mapInArrow(read, schema)


def descend(tiers: list[DataFrame], base: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The proofs of the leaves; ``base`` adds (up, subroot), the way from a tree's root on, to rows (tree, idx)."""
    below = None
    for tier in reversed(tiers):
        above = base(tier.where(F.col("size") <= (1 << TIER)).select("tree", F.lit(0).cast("long").alias("idx")))
        if below is not None:
            above = above.unionByName(below.select("tree", F.col("row.idx").alias("idx"), F.col("proof").alias("up"), "subroot"))
        below = extract(tier, above)
    return below


def manifest(documents: DataFrame) -> tuple[list[DataFrame], list[DataFrame], str | None]:
    """The logs of the languages' trees and of the tree over their roots, and the root (None without rows)."""
    seventh = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0
    changed = F.when(F.coalesce(seventh, F.lit(False)) & F.col("n_chars").isNotNull(), leaf_hash(F.col("n_chars") + 1))
    rows = documents.select(F.col("lang").cast("string").alias("tree"), "doc_id", leaf_hash().alias("hash"), changed.alias("tampered"))
    placed = ranked(collapse(rows, "merkle-leaves"), ["doc_id", "hash"])
    trees = grow(runs(placed.withColumn("row", F.struct("doc_id", "tampered"))), "merkle-log")
    subroots = roots(trees).select(F.lit(None).cast("string").alias("tree"), F.col("tree").alias("lang"), "hash", F.lit(1).cast("long").alias("_w_n"))
    over = grow(runs(ranked(subroots, ["lang"]).withColumn("row", F.struct("lang"))), "merkle-langs")
    top = roots(over).first()
    return trees, over, top["hash"] if top else None


def log_rows(tiers: list[DataFrame]) -> DataFrame:
    """The manifest as rows (tree, position, hash): every node at its place in the whole tree's postorder."""
    out = None
    for t, tier in enumerate(tiers):
        def read(batches: Iterator[pa.RecordBatch], low: int = t * TIER, lowest: bool = t == 0) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for one in b.to_pylist():
                    size, levels = one["leaves"], height(one["leaves"])
                    own = min(TIER, height(one["size"]))
                    places = []
                    for level in range(own + 1):
                        for at in range(-(-one["count"] >> level)):
                            if level or lowest:  # a tier's lowest nodes stand in the log below it
                                whole = (one["block"] << (own - level)) + at if own == TIER else at
                                places.append((position(low + level, whole, size, levels), position(level, at, one["count"], own)))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([one["tree"]] * len(places), pa.string()), pa.array([p for p, _ in places], pa.int64()),
                        pa.array([one["log"][q] for _, q in places], pa.string())], ["tree", "position", "hash"])

        sizes = tiers[0].groupBy(F.col("tree").alias("_t")).agg(F.max("size").alias("leaves"))
        part = tier.join(sizes, F.col("tree").eqNullSafe(F.col("_t"))).select("tree", "block", "size", "count", "log", "leaves")
        part = part.mapInArrow(read, "tree string, position long, hash string")
        out = part if out is None else out.unionByName(part)
    return out


def proofs(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, lang, leaf, tampered (its leaf after tampering, else NULL), subroot, root, proof.

    ``proof`` lists the siblings from the leaf up: ``L`` or ``R`` (where the sibling stands) and
    its hash, or ``-`` for a level without one.
    """
    trees, over, root = manifest(documents)
    if root is None:
        kinds = {"doc_id": documents.schema["doc_id"].dataType}
        return empty_frame(documents.sparkSession, T.StructType([
            T.StructField(c, kinds.get(c, T.StringType())) for c in ("doc_id", "lang", "leaf", "tampered", "subroot", "root", "proof")]))
    langs = descend(over, lambda whole: whole.select("tree", "idx", F.lit("").alias("up"), F.lit(root).alias("subroot")))
    langs = stage(langs.select(F.col("row.lang").alias("_l"), F.col("proof").alias("up"), F.col("leaf").alias("subroot")), "merkle-tops")
    out = descend(trees, lambda whole: whole.join(langs, F.col("tree").eqNullSafe(F.col("_l"))).drop("_l"))
    return out.select("row.doc_id", F.col("tree").alias("lang"), "leaf", "row.tampered", "subroot", F.lit(root).alias("root"), "proof")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that each leaf and proof lead to."""
    @F.arrow_udf("string")
    def climb(leaves: pa.Array, paths: pa.Array) -> pa.Array:
        return pa.array([fold(a, p) for a, p in zip(leaves.to_pylist(), paths.to_pylist(), strict=True)], pa.string())

    return climb(leaf, proof)


def audit(documents: DataFrame) -> DataFrame:
    """Every document's proof as a digest, and whether its row still leads to the root after the tampering."""
    out = proofs(documents).withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("proof")))
    siblings = F.translate("proof", "LR-", "")
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


_LEAF = " || ".join(f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')" for c in COLUMNS)
# crc32 as a table of its 256 steps: DuckDB has no such function
_CRC = """
crc_steps(byte, step, c) as (
  select range::ubigint, 0, range::ubigint from range(256)
  union all
  select byte, step + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end from crc_steps where step < 8),
crc_table as (select list(c order by byte) as t from crc_steps where step = 8),
crcs(doc_id, left_over, c) as (
  select distinct doc_id, doc_id::varchar, 4294967295::ubigint from documents where doc_id is not null
  union all
  select doc_id, left_over[2:], xor(t[((xor(c, ord(left_over[1])::ubigint) & 255) + 1)::bigint], c >> 8) from crcs, crc_table where left_over <> ''),
crc as (select doc_id as of_id, xor(c, 4294967295::ubigint) as crc from crcs where left_over = '')"""
ORACLE_SQL = f"""
with recursive {_CRC.strip()},
leaves as (
  select lang, doc_id, sha256({_LEAF}) as leaf,
         case when crc % 7 = 0 then sha256({_LEAF.replace("n_chars::", "(n_chars + 1)::")}) else sha256({_LEAF}) end as changed
  from documents left join crc on doc_id = of_id),
placed as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos,
         count(*) over (partition by lang) as size from leaves),
nodes(lang, level, pos, size, h) as (
  select lang, 0, pos, size, leaf from placed
  union all
  select lang, level + 1, pos // 2, (any_value(size) + 1) // 2, sha256(string_agg(h, '' order by pos))
  from nodes where size > 1 group by lang, level, pos // 2),
subroots as (
  select lang, level, h, row_number() over (order by lang nulls first) - 1 as pos, count(*) over () as size from nodes where size = 1),
tops(level, pos, size, h) as (
  select 0, pos, size, h from subroots
  union all
  select level + 1, pos // 2, (any_value(size) + 1) // 2, sha256(string_agg(h, '' order by pos))
  from tops where size > 1 group by level, pos // 2),
walk(doc_id, lang, leaf, id, level, pos, height, proof, h) as (
  select p.doc_id, p.lang, leaf, row_number() over (), 0, p.pos, s.level, '', changed
  from placed p join subroots s on p.lang is not distinct from s.lang
  union all
  select w.doc_id, w.lang, w.leaf, w.id, w.level + 1, w.pos // 2, w.height, w.proof || coalesce(n.h, ''),
         sha256(case when w.pos % 2 = 1 then coalesce(n.h, '') || w.h else w.h || coalesce(n.h, '') end)
  from walk w left join nodes n on n.lang is not distinct from w.lang and n.level = w.level and n.pos = xor(w.pos, 1)
  where w.level < w.height),
climb(doc_id, leaf, subroot, id, level, pos, height, proof, h) as (
  select w.doc_id, w.leaf, s.h, w.id, 0, s.pos, (select max(level) from tops), w.proof, w.h
  from walk w join subroots s on w.lang is not distinct from s.lang where w.level = w.height
  union all
  select c.doc_id, c.leaf, c.subroot, c.id, c.level + 1, c.pos // 2, c.height, c.proof || coalesce(n.h, ''),
         sha256(case when c.pos % 2 = 1 then coalesce(n.h, '') || c.h else c.h || coalesce(n.h, '') end)
  from climb c left join tops n on n.level = c.level and n.pos = xor(c.pos, 1)
  where c.level < c.height)
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, c.h as folded_root, c.h = root as verified
from climb c, (select h as root from tops where size = 1) r
where c.level = c.height
"""
