"""Source divergence audit: how the words of a language differ between its sources.

Identical texts of a language are collapsed first: one row per different text, with
how often each source holds it.  Each different text is tokenized once; its
counts, times the copies, are added up inside a task before anything is shuffled.
A language keeps the terms that stand in at least ``MIN_DOCS`` of its documents.

Every group (lang, source) gives a kept term p = 1 + floor(10^9 (count + 5) /
(N + 5 V)), N the group's occurrences of kept terms, V their number; a language as
a whole likewise.  All numbers are whole, products in decimals, so sums are exact
whatever the order.

Pairs are evaluated sparsely: with z the p of a term that a group lacks, the
distance of groups a and b is

    V |za - zb|  +  over terms of a (|pa - zb| - |za - zb|)
                 +  over terms of b (|za - pb| - |za - zb|)
                 +  over terms of both (|pa - pb| - |pa - zb| - |za - pb| + |za - zb|)

so that only terms a group really has are touched: the last sum is an equi-join on
(lang, term), the middle ones go over the different values of p in a group.

Defined cases: null text, lang or source count as empty; repeated rows count as
documents of their own; a language without kept terms has distance 0 for all
pairs and no terms; a source alone in its language has no pairs; an empty table
gives an empty result.  Columns other than text, lang and source are not read,
whatever their names.
"""
from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from judgeline.llm.common import broadcast_if_small, ship
from judgeline.session import cut_lineage

ship(__name__)

MIN_DOCS = 30             # documents of a language that a kept term stands in
SCALE = 1_000_000_000
SMOOTHING = 5
TOP_TERMS = 50
HELD_TERMS = 300_000      # (source, term) sums that a task holds before it passes them on

#: Bytes of terms: letters A-Z (made small) and a-z, and all of characters beyond ASCII.
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    """Longest runs of ASCII letters and characters beyond ASCII, A-Z made small."""
    return text.encode().translate(_TERM_BYTES).split()


def copies(docs: DataFrame) -> DataFrame:
    """lang, text, held: each different text of a language once, with an array of
    (source, times).  Texts are compared by SHA-256; copies are collapsed before
    the shuffle, so that a text of any number of copies is no hot key."""
    rows = docs.select(F.coalesce(docs["lang"], F.lit("")).alias("lang"),
                       F.coalesce(docs["source"], F.lit("")).alias("source"),
                       F.coalesce(docs["text"], F.lit("")).alias("text")) \
        .withColumn("h", F.coalesce(F.unhex(F.sha2("text", 256)), F.lit(b"")))   # never null: no filter that hashes twice
    held = (rows.groupBy("lang", "h", "source").agg(F.count(F.lit(1)).alias("times"))
            .groupBy("lang", "h").agg(F.collect_list(F.struct("source", "times")).alias("held")))
    texts = rows.groupBy("lang", "h").agg(F.first("text").alias("text"))
    return texts.join(held, ["lang", "h"]).select("lang", "text", "held")


def _partial_counts(batches):
    """Adds up counts and document counts per (lang, source, term) in a task."""
    sums: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def passed_on(below: int | None = None):
        """Passes on the terms seen less often than ``below`` so far, or all."""
        for (lang, source), (count, docs) in sums.items():
            terms = [t for t, n in count.items() if below is None or n < below]
            for i in range(0, len(terms), 100_000):
                some = terms[i:i + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(some)), pa.array([source] * len(some)),
                     pa.array([t.decode() for t in some], pa.string()),
                     pa.array([count[t] for t in some], pa.int64()), pa.array([docs[t] for t in some], pa.int64())],
                    names=["lang", "source", "term", "count", "docs"])
            for t in terms:
                del count[t], docs[t]

    for batch in batches:
        langs, held = batch.column("lang").to_pylist(), batch.column("held").to_pylist()
        for i, (lang, sources) in enumerate(zip(langs, held)):
            found = terms_of(batch.column("text")[i].as_py())
            once = Counter(found) if len(sources) > 1 or sources[0]["times"] > 1 else None
            for s in sources:
                count, docs = sums.setdefault((lang, s["source"]), (Counter(), Counter()))
                if once is None:
                    count.update(found)
                    docs.update(set(found))
                    continue
                times = s["times"]
                for t, n in once.items():
                    count[t] += n * times
                    docs[t] += times
            below = 2               # frequent terms stay, so that a task passes them on once
            while sum(len(c) for c, _ in sums.values()) > (HELD_TERMS if below == 2 else HELD_TERMS // 2):
                yield from passed_on(below)
                below *= 2
    yield from passed_on()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, count (occurrences), docs (documents with the term).  The
    tasks' sums are dealt by (lang, term), which also serves what follows by term."""
    parts = copies(docs).mapInArrow(_partial_counts, "lang string, source string, term string, count long, docs long") \
        .repartition("lang", "term")
    return parts.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def _p(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(SCALE (count + SMOOTHING) / (n + SMOOTHING v)) as long."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (count + F.lit(SMOOTHING)).cast("decimal(20,0)")
    below = (n + F.lit(SMOOTHING) * v).cast("decimal(20,0)")
    return F.call_function("div", top, below) + F.lit(1).cast("long")


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, source, term, count, total (in the language) and lead (true in one row
    of each term of a language), for the terms that a language keeps."""
    term = Window.partitionBy("lang", "term")
    return (term_counts(docs)
            .withColumn("in_lang", F.sum("docs").over(term))
            .withColumn("total", F.sum("count").over(term))
            .withColumn("lead", F.row_number().over(term.orderBy("source")) == 1)
            .where(F.col("in_lang") >= min_docs)
            .select("lang", "source", "term", "count", "total", "lead"))


def group_sizes(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, n, z, v, lang_n of every group that occurs: occurrences of kept
    terms, p of a term it lacks (null if v is 0), kept terms of the language and their
    occurrences in it.  One row a group, as the result has."""
    groups = docs.select(F.coalesce(docs["lang"], F.lit("")).alias("lang"),
                         F.coalesce(docs["source"], F.lit("")).alias("source")).distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    whole = kept.where("lead").groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"))
    joined = groups.join(own, ["lang", "source"], "left").join(whole, "lang", "left") \
        .fillna(0, ["n", "v", "lang_n"])
    z = F.when(F.col("v") > 0, _p(F.lit(0).cast("long"), F.col("n"), F.col("v")))
    return joined.select("lang", "source", "n", z.alias("z"), "v", "lang_n")


def _ranked(rows: DataFrame, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    rows = rows.withColumn("rank", F.row_number().over(order))
    return rows if most is None else rows.where(F.col("rank") <= most)


def pair_distances(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, a, b, value for a < b: the distance of two sources of a language.
    ``terms``: lang, source, term, p, z; ``groups``: as ``group_sizes``."""
    def side(df: DataFrame, name: str, *columns: str) -> DataFrame:
        return df.select("lang", F.col("source").alias(name), *[F.col(c).alias(c + name) for c in columns])

    ga, gb = side(groups, "a", "z", "v"), side(groups, "b", "z")
    apart = F.coalesce(F.abs(F.col("za") - F.col("zb")), F.lit(0).cast("long"))
    every = ga.join(gb, "lang").where("a < b").select("lang", "a", "b", (F.col("va") * apart).alias("value"))
    # terms of one side, whether the other has them or not
    values = terms.groupBy("lang", "source", "p", "z").agg(F.count(F.lit(1)).alias("times"))
    other = groups.select("lang", F.col("source").alias("other"), F.col("z").alias("zo"))
    away = F.abs(F.col("p") - F.col("zo")) - F.abs(F.col("z") - F.col("zo"))
    single = values.join(other, "lang").where("source <> other").select(
        "lang", F.least("source", "other").alias("a"), F.greatest("source", "other").alias("b"),
        (F.col("times") * away).alias("value")) \
        .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    ta = terms.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("pa"), F.col("z").alias("za"))
    tb = terms.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("pb"), F.col("z").alias("zb"))
    shared = F.abs(F.col("pa") - F.col("pb")) - F.abs(F.col("pa") - F.col("zb")) \
        - F.abs(F.col("za") - F.col("pb")) + F.abs(F.col("za") - F.col("zb"))
    both = ta.join(tb, ["lang", "term"]).where("a < b").select("lang", "a", "b", shared.alias("value")) \
        .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    return every.unionByName(single).unionByName(both) \
        .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank.  Part ``pair``: every other source of the
    language and how far its words are; part ``term``: the terms that set a source
    apart from its language most."""
    kept = cut_lineage(kept_terms(docs, min_docs))
    groups = cut_lineage(group_sizes(docs, kept))
    terms = kept.join(broadcast_if_small(groups), ["lang", "source"]) \
        .withColumn("p", _p(F.col("count"), F.col("n"), F.col("v")))
    pairs = cut_lineage(pair_distances(terms.select("lang", "source", "term", "p", "z"), groups))
    pair_rows = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        pairs.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    q = _p(F.col("total"), F.col("lang_n"), F.col("v"))
    term_rows = terms.select("lang", "source", F.col("term").alias("item"), (F.col("p") - q).alias("value")) \
        .where("value > 0")

    def shaped(rows: DataFrame, part: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))

    return shaped(_ranked(pair_rows), "pair").unionByName(shaped(_ranked(term_rows, top_terms), "term"))
