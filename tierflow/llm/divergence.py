"""Operator 12: audit of how the sources of a language differ, over collapsed texts.

Identical texts of a language are one group with a multiplicity per source: the
counts per (language, text digest, source) are narrow rows, and one text per
digest is shuffled beside them, both combined in the map tasks first.  Each group
is tokenized once; its term counts enter every source's counts times that
source's multiplicity, and its distinct terms enter the language's document
frequencies times the whole multiplicity.  Tasks combine these before the
shuffle, in tables of at most ``HELD`` entries.

Pairs of sources are evaluated sparsely.  With p0 and q0 the probabilities of a term
that a group does not have, the sum over all kept terms of f(p, q) is

    V f(p0, q0) + sum over A's terms of f(p, q0) - f(p0, q0)
                + sum over B's terms of f(p0, q) - f(p0, q0)
                + sum over common terms of f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)

The first two sums need only the histogram of a group's p against the other
group's one number, the last only terms that both have.  All numbers are whole:
f is at most the larger of p squared and q, and the p of a group add up to at
most 10^9 + V, so every sum fits 64 bits below two billion kept terms a language.

Defined results: NULL text, language and source count as ''; a group without
terms takes part with counts of 0; a language with no kept term has value 0 for
every pair and no term rows; a language of one source has no pairs; ties of value
rank by item as UTF-8 bytes; repeated rows count as often as they occur; long
texts are read whole; an empty table gives an empty result; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.session import stage

#: Documents of a language that must have a term.
LEAST = 3
SCALE = 1_000_000_000
#: Ranks of a group's terms that are reported.
RANKS = 200
#: Entries of a task's tables before they are handed on.
HELD = 400_000
#: Every byte of a term stays, A-Z lower-cased; all others part terms.  Bytes from 0x80 on belong to characters from U+0080 on.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split(b" ") if text else []


def collapsed(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(groups, texts): rows (lang, source, n documents), and per distinct text of a language its multiplicities by source."""
    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)

    docs = documents.select(plain("lang"), plain("source"), plain("text"))
    docs = docs.withColumn("d", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    times = docs.groupBy("lang", "d", "source").agg(F.count(F.lit(1)).alias("n"))
    by_source = times.groupBy("lang", "d").agg(F.collect_list(F.struct("source", "n")).alias("sources"))  # one entry per source
    one = docs.groupBy("lang", "d").agg(F.first("text").alias("text"))
    texts = one.join(by_source.hint("merge"), ["lang", "d"]).select("lang", F.col("text").cast("binary").alias("text"), "sources")
    groups = docs.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("docs"))
    return groups, texts


def tokenized(texts: DataFrame) -> DataFrame:
    """Rows (lang, source, term, n) combined per task; those with a NULL source count documents, not occurrences."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Counter] = defaultdict(Counter)

        def handed() -> Iterator[pa.RecordBatch]:
            for (lang, source), terms in held.items():
                terms.pop(b"", None)
                n = len(terms)
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()),
                    pa.array(list(terms), pa.binary()).cast(pa.string()), pa.array(list(terms.values()), pa.int64())], ["lang", "source", "term", "n"])
            held.clear()

        entries = 0
        for b in batches:
            for lang, text, sources in zip(b.column("lang").to_pylist(), b.column("text"), b.column("sources").to_pylist(), strict=True):
                words = terms_of(text.as_py())
                distinct = set(words)
                if len(sources) == 1 and sources[0]["n"] == 1:
                    held[lang, sources[0]["source"]].update(words)
                    held[lang, None].update(distinct)
                else:
                    counts = Counter(words)
                    for s in sources:
                        add(held[lang, s["source"]], counts, s["n"])
                    add(held[lang, None], dict.fromkeys(distinct, 1), sum(s["n"] for s in sources))
                entries += len(distinct)
                if entries > HELD:  # counts new and old alike; the true size is looked up only then
                    entries = sum(map(len, held.values()))
                    if entries > HELD // 2:
                        yield from handed()
                        entries = 0
        yield from handed()

    return texts.mapInArrow(count, "lang string, source string, term string, n long")


def add(to: Counter, counts: dict, times: int) -> None:
    for term, n in counts.items():
        to[term] += n * times


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (count + 1) / (total + kept)), in whole numbers that cannot overflow."""
    a = (F.coalesce(count, F.lit(0)) + 1).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1).cast("long") + F.call_function("div", a, (total + kept).cast("decimal(19,0)"))


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def audit(documents: DataFrame, least: int = LEAST, ranks: int = RANKS) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): part ``pair`` for each other source, ``term`` for the terms above the language's share."""
    groups, texts = collapsed(documents)
    groups = stage(groups, "divergence-groups")
    sums = stage(tokenized(texts).groupBy("lang", "source", "term").agg(F.sum("n").alias("n")), "divergence-counts")
    kept = sums.where(F.col("source").isNull() & (F.col("n") >= least)).select("lang", "term")
    counts = stage(sums.where(F.col("source").isNotNull()).join(kept.hint("merge"), ["lang", "term"])
                   .select("lang", "term", "source", F.col("n").alias("c")), "divergence-kept")

    # one row per language and per group: narrow beside the terms
    kinds = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("V"))
    sizes = groups.select("lang", "source").join(kinds, "lang", "left").join(
        counts.groupBy("lang", "source").agg(F.sum("c").alias("N")), ["lang", "source"], "left")
    sizes = sizes.select("lang", "source", F.coalesce("V", F.lit(0)).cast("long").alias("V"), F.coalesce("N", F.lit(0)).cast("long").alias("N"))
    sizes = stage(sizes.withColumn("p0", F.when(F.col("V") > 0, share(F.lit(0), F.col("N"), F.col("V")))), "divergence-groups")
    made = stage(counts.join(sizes, ["lang", "source"]).select("lang", "source", "term", "V", share(F.col("c"), F.col("N"), F.col("V")).alias("p"), "c", "p0"),
                 "divergence-shares")

    # terms: a group's share against its language's
    whole = made.groupBy("lang", "term").agg(F.sum("c").alias("all_c"))
    totals = sizes.groupBy("lang").agg(F.sum("N").alias("T"))
    terms = made.join(whole, ["lang", "term"]).join(totals, "lang").withColumn("q", share(F.col("all_c"), F.col("T"), F.col("V")))
    terms = terms.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                        distance(F.col("p"), F.col("q")).alias("value"))
    return (ranked(pairs(sizes, made)).unionByName(ranked(terms).where(F.col("rank") <= ranks)))


def ranked(rows: DataFrame) -> DataFrame:
    place = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), F.col("item"))
    return rows.withColumn("rank", F.row_number().over(place))


def pairs(sizes: DataFrame, made: DataFrame) -> DataFrame:
    """(lang, source, part, item, value) of every two groups of a language.

    The pairs themselves are the result; their values are sums over terms that are combined in the map tasks.
    """
    a = sizes.select("lang", "source", "V", F.col("p0").alias("p0"))
    b = sizes.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    both = a.join(b, "lang").where("source <> item")
    zero = F.coalesce(F.col("V") * distance(F.col("p0"), F.col("q0")), F.lit(0))

    # a group's terms by their share: few rows, as most terms are rare
    shares = made.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("m"))
    none = distance(F.col("p0"), F.col("q0"))
    first = (both.join(shares, ["lang", "source"]).groupBy("lang", "source", "item")
             .agg(F.sum(F.col("m") * (distance(F.col("p"), F.col("q0")) - none)).alias("first")))
    second = (both.join(shares.select("lang", F.col("source").alias("item"), F.col("p").alias("q"), "m"), ["lang", "item"]).groupBy("lang", "source", "item")
              .agg(F.sum(F.col("m") * (distance(F.col("p0"), F.col("q")) - none)).alias("second")))

    other = made.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"), F.col("p0").alias("q0"))
    common = made.join(other, ["lang", "term"]).where("source <> item")
    third = common.groupBy("lang", "source", "item").agg(F.sum(
        distance(F.col("p"), F.col("q")) - distance(F.col("p"), F.col("q0")) - distance(F.col("p0"), F.col("q")) + none).alias("third"))
    out = both
    for part in (first, second, third):
        out = out.join(part, ["lang", "source", "item"], "left")
    wide = [F.coalesce(c, F.lit(0)).cast("decimal(38,0)") for c in (zero, F.col("first"), F.col("second"), F.col("third"))]
    value = (wide[0] + wide[1] + wide[2] + wide[3]).cast("long")
    return out.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))


ORACLE_SQL = r"""
with docs as (
  select coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as id,
         regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents),
said as (select lang, source, id, unnest(terms) as term from docs),
kept as (select lang, term from said group by lang, term having count(distinct id) >= 3),
kinds as (select lang, count(*) as v from kept group by lang),
groups as (select distinct lang, source from docs),
counts as (select s.lang, s.source, s.term, count(*) as c from said s semi join kept k on s.lang = k.lang and s.term = k.term group by all),
sizes as (
  select g.lang, g.source, coalesce(any_value(v), 0) as v, coalesce(sum(c), 0) as n
  from groups g left join kinds k on g.lang = k.lang left join counts t on g.lang = t.lang and g.source = t.source group by g.lang, g.source),
dense as (
  select z.lang, z.source, k.term, coalesce(c, 0) as c, 1 + (1000000000::hugeint * (coalesce(c, 0) + 1)) // (n + v) as p
  from sizes z join kept k on z.lang = k.lang left join counts t on t.lang = z.lang and t.source = z.source and t.term = k.term),
whole as (
  select lang, term, 1 + (1000000000::hugeint * (sum(c) + 1)) // (any_value(n) + any_value(v)) as q
  from dense join (select lang, sum(n) as n, any_value(v) as v from sizes group by lang) using (lang) group by lang, term),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
  from dense a join dense b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
  union all
  select a.lang, a.source, 'pair', b.source, 0 from sizes a join sizes b on a.lang = b.lang and a.source <> b.source where a.v = 0),
terms as (
  select lang, source, 'term' as part, term as item, (p - q) * (p - q) // q as value
  from dense join whole using (lang, term) where c > 0 and p > q)
select lang, source, part, item, value::bigint as value, rank::int as rank from (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
  from (select * from pairs union all select * from terms))
where part = 'pair' or rank <= 200
"""
