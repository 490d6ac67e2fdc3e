"""Mixing sources to target weights.

Every document gets a hash-random key.  Within its source the documents stand
in the order of the keys; distributed prefix sums of their word counts tell how
many words stand before each.  The mix takes each source's words up to its
budget, going round the source again (epochs) when the budget exceeds it.

Defined cases: a null text has size 0; a null source is a source of its own, in
the last place; a null doc_id is hashed as the word null; repeated rows are
documents of their own, however many there are; an empty table gives an empty
result.  Other columns of the input than doc_id, text and source, whatever their
names, are not read by ``mix_words`` and pass through ``mix_documents``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from judgeline.llm.common import (
    COPIES, broadcast_if_small, counted, each_copy, hash_key, n_words, prefix_sums, spread)
from judgeline.session import cut_lineage

WEIGHTS = (5, 2, 1)       # by the sources' places, repeating
SHARE = 1.5               # words of the mix, as a multiple of all words
MAX_EPOCHS = 2            # a source gives at most so many times its words
SEED = "mix"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(src, source_size, target) from (src, size), one row per source.

    All words times ``share`` are dealt by weight.  A source stops at
    ``max_epochs`` times its words; what is over goes to the others by weight.
    In the order of capacity over weight the sources that stop are the first
    ones, so one pass over the sources' totals finds them.  The windows below
    run over one row per source, after the rows have been summed up.
    """
    totals = sizes.groupBy("src").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("src").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((place - 1) % len(weights) + 1).cast("int"))
    every = Window.partitionBy()
    fill = Window.orderBy(F.col("cap") / F.col("w"), F.col("src").asc_nulls_last())
    t = totals.select("src", "source_size", weight.alias("w"),
                      (F.col("source_size") * float(max_epochs)).alias("cap"))
    t = t.withColumn("budget", F.sum("source_size").over(every) * F.lit(float(share)))
    t = t.withColumn("before", F.coalesce(
        F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    t = t.withColumn("open_w", F.sum("w").over(fill.rowsBetween(0, Window.unboundedFollowing)))
    t = t.withColumn("full", F.col("cap") * F.col("open_w") <= (F.col("budget") - F.col("before")) * F.col("w"))
    t = t.withColumn("rest", F.col("budget") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(every)) \
        .withColumn("rest_w", F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("w"))).over(every))
    return t.select("src", "source_size", F.when(F.col("full"), F.col("cap"))
                    .otherwise(F.col("rest") * F.col("w") / F.col("rest_w")).alias("target"))


def _placed(rows: DataFrame, order: list[str], **targets) -> DataFrame:
    """``rows`` (src, size, key, copies and more) with source_size, target, the words
    before the row in its source, whole epochs and the words left for the last one."""
    words = F.col("size") * F.col("copies")
    per_source = broadcast_if_small(cut_lineage(source_targets(rows.select("src", words.alias("size")), **targets)))
    rows = prefix_sums(rows, ["src"], "key", order, words, "before")
    rows = rows.withColumnRenamed("src", "_src").join(
        per_source, F.col("_src").eqNullSafe(F.col("src"))).drop("_src")
    words = F.floor(F.col("target") + 0.5).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0)
    return rows.withColumn("epochs", epochs.cast("long")) \
        .withColumn("left", words - F.col("epochs") * F.col("source_size"))


def mix_words(docs: DataFrame, seed: str = SEED, **targets) -> DataFrame:
    """doc_id, size, source_size, target, taken: the words the mix takes of each
    document, repeats counted.  Each source's taken words are its target,
    rounded: the document at the cut is taken in part.  Rows that share doc_id,
    source and size are counted first and told apart again at the end."""
    rows = counted(docs.select("doc_id", F.col("source").alias("src"), n_words(F.col("text")).alias("size")))
    rows = cut_lineage(rows.withColumn("key", hash_key(F.col("doc_id"), seed)))
    rows = each_copy(_placed(rows, ["doc_id", "size", "part"], **targets))
    cut = F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - F.col("before") - F.col("copy") * F.col("size")))
    return rows.select("doc_id", "size", "source_size", "target",
                       (F.col("epochs") * F.col("size") + cut).cast("long").alias("taken"))


def _row_hash(docs: DataFrame) -> Column:
    """64 bits of all columns of a row; maps, which have no order, as JSON."""
    return F.xxhash64(*[F.to_json(F.struct(docs[c].alias("c"))) if "map<" in kind else docs[c] for c, kind in docs.dtypes])


def mix_documents(docs: DataFrame, seed: str = SEED, **targets) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as the mix takes it.

    Documents stay whole: the one at a source's cut is in if at least half of
    it fits, so a source is off its target by half a document at most, also where
    rows share a doc_id, have none or are equal in all columns.  The cut is a
    place per source in the order of (key, hash of the row, doc_id), so the texts
    are filtered in place and not shuffled.  Where the cut falls among equal rows,
    as many as fit are made from one of them.
    """
    names = ["key", "spread", "own", "id"]
    order = ["own", "doc_id"]
    rows = counted(docs.select(docs["doc_id"].alias("doc_id"), docs["source"].alias("src"), n_words(docs["text"]).alias("size"),
                               _row_hash(docs).alias("own")), most=None)
    rows = _placed(cut_lineage(rows.withColumn("key", hash_key(F.col("doc_id"), seed))), order, **targets)
    fits = F.expr("""if(size = 0, if(before <= left, copies, 0L),
        least(copies, greatest(0L, (2 * (left - before) + size) div (2 * size))))""")
    place = F.struct("key", spread(*order).alias("spread"), "own", F.col("doc_id").alias("id"), fits.alias("fits"), "copies")
    cuts = rows.groupBy("src").agg(F.max("epochs").alias("epochs"), F.max(F.when(fits > 0, place)).alias("cut"))
    cuts = cut_lineage(cuts.select("src", "epochs", "cut", (F.col("cut.fits") < F.col("cut.copies")).alias("among_equals")))
    among_equals = not cuts.where("among_equals").isEmpty()
    cuts = broadcast_if_small(cuts)
    own = _row_hash(docs)
    here = F.struct(hash_key(docs["doc_id"], seed).alias("key"), spread(own, docs["doc_id"]).alias("spread"),
                    own.alias("own"), docs["doc_id"].alias("id"))
    cut = F.struct(*[cuts["cut"][n].alias(n) for n in names])
    joined = docs.join(cuts, docs["source"].eqNullSafe(cuts["src"]))
    inside = (here < cut) | ((here == cut) & ~cuts["among_equals"])
    copies = cuts["epochs"] + F.when(cuts["cut"].isNotNull() & inside, 1).otherwise(0)
    row = F.struct(*[docs[c].alias(c) for c in docs.columns])
    mixed = joined.where(copies > 0).select(row.alias("row"), F.explode(F.sequence(F.lit(1), copies.cast("int"))).alias("copy"))
    if among_equals:
        equal = joined.where(cuts["among_equals"] & (here == cut)).groupBy(cuts["src"]) \
            .agg(F.first(row).alias("row"), F.first(cuts["cut"]["fits"]).alias("copies"))
        parts = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES).cast("long")))
        equal = equal.select("row", "copies", parts.alias("part")).repartition("part") \
            .withColumn("copies", F.least(F.lit(COPIES).cast("long"), F.col("copies") - F.col("part") * COPIES))
        mixed = mixed.select("row").union(each_copy(equal).select("row"))
    return mixed.select("row.*")
