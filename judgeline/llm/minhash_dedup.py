"""MinHash near-duplicates with tensored banding.

A document is the set of its distinct word shingles.  Two collections of half
keys, each made of a few minhashes, are computed; a table's key is a pair of one
half key from either collection.  ``HALVES`` half keys a side give HALVES squared
tables for 2 * HALVES * ROWS minhashes, about the square root of what separate
tables would take.  Pairs at the threshold meet in no table with a chance of
about 4e-4 (halves of 3 rows, 12 a side); more similar ones far more rarely.

Documents with equal sets are one class.  Rows are dealt by the half keys of the
first collection, so the second half is expanded inside a partition, once, and never
shuffled.  Within a bucket every member is first compared with the smallest one only;
a half key that very many classes share is salted, and the salted parts' smallest
members are compared in turn.  A pair keeps the tables in which it meets this way as
a bit mask.  Candidates are confirmed on the full sets.

A member may be linked with another one though not with the smallest.  So the
classes that comparisons found at least ``FAMILY`` percent similar form families,
and in a family whose links leave several components, every class outside the
largest one is compared with all classes of other components, on full sets, in
blocks of rows; a task returns the components it joins, not pairs.  Buckets that
then still hold several families are opened, those of the same smallest member
together: the masks tell their members, which are compared across families, as pairs
that share a bucket when there are up to ``SMALL`` and in blocks of rows when more.
So every pair that meets in a table is compared or in one component
already.  No pair, set or fingerprint goes to the driver.

Defined cases: a text that is null or has no word has an empty set, is linked
with nothing and is kept; a text with fewer words than a shingle is one shingle;
rows that share a doc_id are one document, each row with its own set; a null
doc_id is linked with nothing; an empty table gives an empty result.  Columns
other than doc_id and text are not read, whatever their names.
"""
from __future__ import annotations

from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from judgeline.llm.common import broadcast_if_small, components, ship
from judgeline.session import cut_lineage

ship(__name__)

WORDS = 5                 # of a shingle
PERCENT = 80              # least similarity
HALVES = 12               # half keys of a collection
ROWS = 3                  # minhashes of a half key
FAMILY = 50               # least similarity, in percent, of comparisons that make families
BLOCK_ROWS = 256          # rows of a block of a family
COLUMNS = 1 << 14         # shingles of a block counted at once
SMALL = 64                # members of open buckets that are compared as pairs
BITS = 62                 # tables in a number of a bit mask
SPLIT = 500               # a half key holding over 1/SPLIT of the classes is salted
CACHED_WORDS = 200_000    # hashes a task remembers
SEED = 20_240_502

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


class _WordHashes(dict):
    """Hash of a word; forgets all when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int, hashes: dict) -> np.ndarray:
    """Distinct shingles of a text as ascending 64-bit hashes.  bytes.lower() and
    bytes.split() know ASCII only, which is what words are made by."""
    own = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not own:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(hashes.__getitem__, own), np.uint64, len(own))
    size = min(words, len(own))
    found = np.full(len(own) - size + 1, size, np.uint64)
    for k in range(size):
        found = _mixed(found * _MIX[0] + each[k:len(own) - size + 1 + k])
    return np.unique(found)


def _family(n: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(SEED).integers(0, 2**63, (2, n), np.uint64)
    return draw[0] * np.uint64(2) + np.uint64(1), draw[1]


def half_keys(found: np.ndarray, halves: int, rows: int) -> np.ndarray:
    """The half keys of both collections, one after the other (int64)."""
    a, b = _family(2 * halves * rows)
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 4096):
        part = found[at:at + 4096]
        least = np.minimum(least, (part[None, :] * a[:, None] + b[:, None]).min(axis=1))
    keys = np.arange(1, 2 * halves + 1, dtype=np.uint64)
    for r in range(rows):
        keys = _mixed(keys * _MIX[0] + least[r::rows])
    return keys.view(np.int64)


def signatures(docs: DataFrame, words: int, halves: int = HALVES, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, same (hash of the whole set), u and v (half keys); the
    last three are null for an empty set."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sign(batches):
        hashes = _WordHashes()
        for batch in batches:
            sizes, same, u, v = [], [], [], []
            for text in batch.column("text").to_pylist():
                found = shingles(text, words, hashes)
                sizes.append(len(found))
                if len(found):
                    keys = half_keys(found, halves, rows)
                    same.append(xxhash.xxh3_128_digest(found.tobytes()))
                    u.append(keys[:halves])
                    v.append(keys[halves:])
                else:
                    same.append(None), u.append(None), v.append(None)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(same, pa.binary()),
                 pa.array(u, longs), pa.array(v, longs)], names=["doc_id", "n_shingles", "same", "u", "v"])

    return docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text")).mapInArrow(
        sign, f"doc_id {kind}, n_shingles long, same binary, u array<long>, v array<long>")


def _sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """(id, own): the full sets of the documents in ``ids``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def whole(batches):
        hashes = _WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                found = [shingles(t, words, hashes).view(np.int64) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(found, pa.list_(pa.int64()))], names=["id", "own"])

    own = docs.select(docs["doc_id"].alias("id"), docs["text"].alias("text")).join(ids, "id", "left_semi")
    return own.mapInArrow(whole, f"id {kind}, own array<long>")


def _long_enough(a: Column, b: Column, percent: int) -> Column:
    """Sets whose sizes differ too much cannot be similar enough."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _bucket(halves: DataFrame) -> DataFrame:
    """One row for each table in which a class is: the second half is expanded."""
    return halves.select(*[c for c in halves.columns if c != "v"], F.posexplode("v").alias("j", "other"))


def _hot(classes: DataFrame, n: int) -> DataFrame:
    """(i, half, parts): the half keys that very many classes share."""
    limit = max(64, n // SPLIT)
    # at most HALVES * SPLIT half keys hold that many classes
    hot = classes.select(F.posexplode("u").alias("i", "half")).groupBy("i", "half").count() \
        .where(F.col("count") > limit).select("i", "half", F.ceil(F.col("count") / limit).alias("parts"))
    return F.broadcast(cut_lineage(hot))


def _masks(halves: int) -> list[str]:
    """Names of the numbers that hold one bit for each table."""
    return [f"t{k}" for k in range(-(-halves * halves // BITS))]


def _united(masks: list[str]) -> list[Column]:
    return [F.bit_or(t).alias(t) for t in masks]


def _shared(rows: DataFrame, other: DataFrame, on: str, masks: list[str]) -> DataFrame:
    """``rows`` joined with ``other``, with the tables of both, where there are any."""
    other = other.withColumnsRenamed({t: f"o{t}" for t in masks})
    both = rows.join(broadcast_if_small(cut_lineage(other)), on)
    both = both.withColumns({t: F.col(t).bitwiseAND(F.col(f"o{t}")) for t in masks}).drop(*[f"o{t}" for t in masks])
    return both.where(" or ".join(f"{t} <> 0" for t in masks))


def _stars(classes: DataFrame, hot: DataFrame, least: int, halves: int) -> DataFrame:
    """(a, b, kind, fits, t0, ...): in each bucket its smallest member and each other
    one, whether their sizes let them be ``least`` percent similar, and the tables.
    Kind 0 is of half keys that are not hot, 1 of the salted parts of hot ones, and 2
    of the smallest members of these parts, each with the smallest of the bucket, also
    that one with itself."""
    own = classes.select("rep", "n", "v", F.posexplode("u").alias("i", "half"))
    key, masks = ["i", "half", "salt"], _masks(halves)
    rows = own.join(hot, ["i", "half"], "left") \
        .withColumn("salt", F.coalesce(F.pmod(F.xxhash64("rep"), F.col("parts")), F.lit(0)))
    hub = F.min(F.struct("rep", "n")).over(Window.partitionBy(*key, "j", "other"))
    rows = _bucket(rows.repartition(*key)).withColumn("hub", hub).where("rep <> hub.rep or parts is not null")
    bits = [F.expr(f"if((i * {halves} + j) div {BITS} = {k}, shiftleft(1L, (i * {halves} + j) % {BITS}), 0L)").alias(t)
            for k, t in enumerate(masks)]
    rows = rows.select(F.col("hub.rep").alias("a"), F.col("rep").alias("b"), "n", F.col("parts").isNotNull().cast("int").alias("kind"),
                       F.when(F.col("rep") == F.col("hub.rep"), F.struct("i", "half", "j", "other")).alias("bucket"),
                       _long_enough(F.col("hub.n"), F.col("n"), least).alias("fits"), *bits)
    found = cut_lineage(rows.groupBy("a", "b", "kind", "bucket").agg(F.min("n").alias("n"), F.max("fits").alias("fits"), *_united(masks)))
    top = F.min(F.struct("b", "n")).over(Window.partitionBy("bucket"))
    above = found.where("bucket is not null").withColumn("top", top) \
        .select(F.col("top.b").alias("a"), "b", F.lit(2).alias("kind"),
                ((F.col("b") != F.col("top.b")) & _long_enough(F.col("top.n"), F.col("n"), least)).alias("fits"), *masks) \
        .groupBy("a", "b", "kind").agg(F.max("fits").alias("fits"), *_united(masks))
    return found.where("bucket is null").select("a", "b", "kind", "fits", *masks).union(above)


def _open_buckets(classes: DataFrame, stars: DataFrame, families: DataFrame, halves: int) -> DataFrame | None:
    """(hub, m, rep, n, family, t0, ...): members of the buckets that hold several
    families, and the tables of these buckets; one row for each smallest member of
    such buckets, and m rows of that one in all."""
    masks = _masks(halves)
    by_a = families.select(F.col("id").alias("a"), F.col("family").alias("fa"))
    by_b = families.select(F.col("id").alias("b"), F.col("family").alias("fb"))
    crossed = cut_lineage(
        stars.where("a <> b").join(by_a, "a", "left").join(by_b, "b", "left")
        .where(F.coalesce("fa", "a") != F.coalesce("fb", "b")).groupBy("a", "kind").agg(*_united(masks)))
    if crossed.isEmpty():
        return None
    # a salted part that holds several families opens the whole bucket
    above, part = stars.where("kind = 2").select("a", "b", *masks), crossed.where("kind = 1")
    raised = _shared(above, part.select(F.col("a").alias("b"), *masks), "b", masks)
    hot = crossed.where("kind = 2").select("a", *masks).union(raised.select("a", *masks)).groupBy("a").agg(*_united(masks))
    cool = crossed.where("kind = 0").select("a", *masks)
    parts = cut_lineage(_shared(above, hot, "a", masks).select(F.col("a").alias("hub"), F.col("b").alias("a"), *masks))
    shape = ["hub", "rep", *masks]
    member = cool.select(F.col("a").alias("hub"), F.col("a").alias("rep"), *masks) \
        .union(_shared(stars.where("kind = 0").select(F.col("a").alias("hub"), F.col("b").alias("rep"), *masks),
                       cool.withColumnRenamed("a", "hub"), "hub", masks).select(*shape)) \
        .union(parts.select("hub", "a", *masks)) \
        .union(_shared(stars.where("kind = 1").select("a", F.col("b").alias("rep"), *masks), parts, "a", masks).select(*shape)) \
        .groupBy("hub", "rep").agg(*_united(masks))
    member = cut_lineage(member.join(classes.select("rep", "n"), "rep")
                         .join(families.withColumnRenamed("id", "rep"), "rep", "left")
                         .select(*shape, "n", F.coalesce("family", "rep").alias("family")))
    sizes = cut_lineage(member.groupBy("hub").agg(F.count(F.lit(1)).alias("m")))
    return member.join(broadcast_if_small(sizes), "hub")


def _confirmed(docs: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b, linked, near): the pairs with the verdicts of their full sets."""
    ids = cut_lineage(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    sets = _sets(docs, broadcast_if_small(ids), words)
    both = pairs.join(sets.select(F.col("id").alias("b"), F.col("own").alias("own_b")), "b") \
        .join(sets.select(F.col("id").alias("a"), F.col("own").alias("own_a")), "a")
    common = F.size(F.array_intersect("own_a", "own_b"))
    checked = both.select("a", "b", common.alias("common"), (F.size("own_a") + F.size("own_b") - common).alias("union"))
    reached = lambda least: F.max(F.col("common") * 100 >= F.col("union") * least)
    return checked.groupBy("a", "b").agg(reached(percent).alias("linked"), reached(min(FAMILY, percent)).alias("near"))


def _crossed(frame, percent: int):
    """Components that links join, of one pair of blocks: side 0 against side 1."""
    asking, other = frame[frame["side"] == 0], frame[frame["side"] == 1]
    sizes = [np.fromiter(map(len, x["own"]), float, len(x)) for x in (asking, other)]
    flat = [np.concatenate(list(x["own"])) if len(x) else np.zeros(0, np.int64) for x in (asking, other)]
    rows = [np.repeat(np.arange(len(n)), n.astype(int)) for n in sizes]
    known = np.unique(flat[0])
    at = [np.searchsorted(known, f) for f in flat]
    there = at[1] < len(known)
    there[there] = known[at[1][there]] == flat[1][there]
    at[1], rows[1] = at[1][there], rows[1][there]
    common = np.zeros((len(asking), len(other)))
    for start in range(0, len(known), COLUMNS):
        width = min(COLUMNS, len(known) - start)
        present = []
        for side in (0, 1):
            here = (at[side] >= start) & (at[side] < start + width)
            bits = np.zeros((len(sizes[side]), width), np.float32)
            bits[rows[side][here], at[side][here] - start] = 1
            present.append(bits)
        common += present[0] @ present[1].T
    union = sizes[0][:, None] + sizes[1][None, :] - common
    a, b = asking["comp"].to_numpy(), other["comp"].to_numpy()
    i, j = np.nonzero((common * 100 >= union * percent) & (a[:, None] != b[None, :]))
    return pd.DataFrame({"a": a[i], "b": b[j]}).drop_duplicates()


def _within_families(docs: DataFrame, member: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): components that further links join, among the classes of a family.
    ``member`` has id, family and comp, the component found so far."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    member = cut_lineage(member)
    parts = member.groupBy("family", "comp").count()
    several = parts.groupBy("family").agg(
        F.count("*").alias("parts"), F.sum("count").alias("n"), F.max(F.struct("count", "comp")).alias("main")) \
        .where("parts > 1").select("family", F.ceil(F.col("n") / BLOCK_ROWS).alias("blocks"), F.col("main.comp").alias("main"),
                                   F.ceil((F.col("n") - F.col("main.count")) / BLOCK_ROWS).alias("asking"))
    member = cut_lineage(member.join(broadcast_if_small(cut_lineage(several)), "family"))
    ids = broadcast_if_small(cut_lineage(member.select("id").distinct()))
    member = member.join(_sets(docs, ids, words).dropDuplicates(["id"]), "id")
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    asking = member.where("comp <> main").select("family", own("asking").alias("q"), every("blocks").alias("m"),
                                                 F.lit(0).alias("side"), "comp", "own")
    other = member.select("family", every("asking").alias("q"), own("blocks").alias("m"), F.lit(1).alias("side"), "comp", "own")
    return asking.union(other).groupBy("family", "q", "m").applyInPandas(
        lambda frame: _crossed(frame, percent), f"a {kind}, b {kind}")


def _across_families(docs: DataFrame, buckets: DataFrame | None, roots: DataFrame, words: int, percent: int,
                     halves: int) -> DataFrame | None:
    """(a, b): links, or components that links join, across the families of buckets."""
    if buckets is None:
        return None
    masks = _masks(halves)
    meet = lambda y: reduce(or_, [y[t].bitwiseAND(F.col(f"x.{t}")) != 0 for t in masks])
    other = F.filter("all", lambda y: (y["rep"] > F.col("x.rep")) & (y["family"] != F.col("x.family")) & meet(y)
                     & _long_enough(y["n"], F.col("x.n"), percent))
    pairs = buckets.where(F.col("m") <= SMALL).groupBy("hub").agg(F.collect_list(F.struct("rep", "n", "family", *masks)).alias("all")) \
        .select("all", F.explode("all").alias("x")).select(F.col("x.rep").alias("a"), F.explode(other).alias("y")) \
        .select("a", F.col("y.rep").alias("b")).distinct()
    found = _confirmed(docs, cut_lineage(pairs), words, percent).where("linked").select("a", "b")
    large = buckets.where(F.col("m") > SMALL).select(F.col("rep").alias("id"), F.col("hub").alias("family"))
    if not large.isEmpty():
        member = large.distinct().join(roots, "id", "left").select("id", "family", F.coalesce("root", "id").alias("comp"))
        found = found.union(_within_families(docs, member, words, percent))
    return cut_lineage(found.distinct())


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT,
                    halves: int = HALVES, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept
    (doc_id = component_id): one row per row of ``docs``."""
    signed = cut_lineage(signatures(docs, words, halves, rows))
    classes = cut_lineage(
        signed.where("same is not null and doc_id is not null").groupBy("same").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"),
            F.first("u").alias("u"), F.first("v").alias("v")))
    hot = _hot(classes, classes.count())
    stars = cut_lineage(_stars(classes, hot, min(FAMILY, percent), halves))
    checked = cut_lineage(_confirmed(docs, stars.where("fits").select("a", "b").distinct(), words, percent))
    linked = checked.where("linked").select("a", "b")
    roots = components(linked)
    families = roots.withColumnRenamed("root", "family")
    if not checked.where("near and not linked").isEmpty():
        families = components(checked.where("near")).withColumnRenamed("root", "family")
        member = families.join(roots, "id", "left").select("id", "family", F.coalesce("root", "id").alias("comp"))
        more = cut_lineage(_within_families(docs, member, words, percent).distinct())
        if not more.isEmpty():
            linked = linked.union(more)
            roots = components(linked)
    more = _across_families(docs, _open_buckets(classes, stars, families, halves), roots, words, percent, halves)
    if more is not None and not more.isEmpty():
        roots = components(linked.union(more))
    found = classes.select("same", "rep").join(roots.withColumnRenamed("id", "rep"), "rep", "left") \
        .select("same", F.coalesce("root", "rep").alias("root"))
    joined = signed.select("doc_id", "n_shingles", "same").join(broadcast_if_small(cut_lineage(found)), "same", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"),
                         component.eqNullSafe(F.col("doc_id")).alias("kept"))


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, with all their columns, of one document of each group:
    the one with the smallest doc_id.  Of rows that share a doc_id one stays, the
    first by text; rows without doc_id or words stay."""
    found = cut_lineage(near_duplicates(docs, words, percent).select("doc_id", "kept"))
    copies = broadcast_if_small(cut_lineage(found.where("not kept").select("doc_id").distinct()))
    kept = docs.join(copies, docs["doc_id"] == copies["doc_id"], "left_anti")
    again = cut_lineage(found.where("kept and doc_id is not null").groupBy("doc_id").count()
                        .where("count > 1").select("doc_id"))
    if again.isEmpty():
        return kept
    again = broadcast_if_small(again)
    place = F.row_number().over(Window.partitionBy(docs["doc_id"]).orderBy(docs["text"]))
    first = kept.join(again, docs["doc_id"] == again["doc_id"], "left_semi") \
        .select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), place.alias("place"))
    return kept.join(again, docs["doc_id"] == again["doc_id"], "left_anti") \
        .union(first.where("place = 1").select("row.*"))
