"""Gains, ideal rankings and the result/ideal alignment.

The ideal ranking of a topic depends only on the judgements, and between two
changes of gain it is a straight stretch of positions.  So measures are aligned
with its levels, one row per topic and gain, from which a retrieved row works out
the ideal row at its own rank; no position is joined or replicated per run.
Positions beyond a run's length are summarised per level as suffix sums, so every
gain measure stays one aggregate per (run, topic).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import log2
from ..session import cut_lineage

STRETCH = 1 << 16         # positions that one row becomes when their discounts are added up


def gain_of(code: Column, gains: dict | None) -> Column:
    """Gain of a relevance code: `level=gain` pairs first, otherwise the level
    itself for judged levels and 0 for the negative codes."""
    expr = F.when(code >= 0, code.cast("double")).otherwise(F.lit(0.0))
    for lvl, g in sorted((gains or {}).items(), reverse=True):
        expr = F.when(code == int(lvl), F.lit(float(g))).otherwise(expr)
    return expr


def ideal_ranking(qrels: DataFrame, gains: dict | None, keys=("qid",),
                  scan: bool = False) -> DataFrame:
    """Judged documents with positive gain, by gain descending.

    Columns: keys, pos (1-based), ig (gain at pos), icum (ideal DCG to pos),
    bnd (a change of ideal gain follows pos), inv_after / cnt_after (sum of
    1/icum and count over boundary positions after pos).
    """
    g = gain_of(F.col("rel"), gains)
    if scan:
        return _ideal_ranking_scan(qrels, g, list(keys), scan)
    pos_w = Window.partitionBy(*keys).orderBy(F.col("ig").desc(), F.col("docno"))
    run_w = pos_w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ideal = (qrels.where(F.col("rel") >= 0)
             .select(*keys, "docno", g.alias("ig"))
             .where(F.col("ig") > 0)
             .withColumn("pos", F.row_number().over(pos_w))
             .withColumn("icum", F.sum(F.col("ig") / log2(F.col("pos") + 1)).over(run_w))
             .withColumn("next_ig", F.lead("ig").over(pos_w)))
    ideal = ideal.withColumn(
        "bnd", F.col("next_ig").isNull() | (F.col("next_ig") != F.col("ig")))
    after_w = Window.partitionBy(*keys).orderBy(F.col("pos").desc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    return ideal.select(
        *keys, "pos", "ig", "icum", "bnd",
        F.coalesce(F.sum(F.when(F.col("bnd"), 1.0 / F.col("icum"))).over(after_w),
                   F.lit(0.0)).alias("inv_after"),
        F.coalesce(F.sum(F.when(F.col("bnd"), 1).otherwise(0)).over(after_w),
                   F.lit(0)).alias("cnt_after"),
    )


def _ideal_ranking_scan(qrels: DataFrame, g, keys: list[str], scan: bool | int) -> DataFrame:
    """ideal_ranking for topics too large for one task: positions, ideal DCG
    and boundary suffix sums by distributed prefix scans (see prefix.py); a
    boundary is the last position of each gain value."""
    from .prefix import prefix_sums

    order = [F.col("ig").desc(), F.col("docno").asc()]
    base = (qrels.where(F.col("rel") >= 0).select(*keys, "docno", g.alias("ig"))
            .where(F.col("ig") > 0).withColumn("_one", F.lit(1)))
    p = prefix_sums(base, keys, order, {"pos": "_one"}, scan)
    p = p.withColumn("_disc", F.col("ig") / log2(F.col("pos") + 1))
    p = prefix_sums(p, keys, order, {"icum": "_disc"}, scan)
    last = p.groupBy(*keys, "ig").agg(F.max("pos").alias("_last"))
    p = p.join(last, keys + ["ig"]).withColumn("bnd", F.col("pos") == F.col("_last"))
    p = (p.withColumn("_inv", F.when(F.col("bnd"), 1.0 / F.col("icum")).otherwise(0.0))
         .withColumn("_b", F.when(F.col("bnd"), 1).otherwise(0)))
    p = prefix_sums(p, keys, order, {"inv_le": "_inv", "cnt_le": "_b"}, scan)
    tot = p.groupBy(*keys).agg(F.sum("_inv").alias("_inv_tot"), F.sum("_b").alias("_b_tot"))
    p = p.join(tot, keys)
    return p.select(*keys, F.col("pos").cast("int").alias("pos"), "ig", "icum", "bnd",
                    (F.col("_inv_tot") - F.col("inv_le")).alias("inv_after"),
                    (F.col("_b_tot") - F.col("cnt_le")).alias("cnt_after"))


def ideal_levels(qrels: DataFrame, gains: dict | None, keys=("qid",)) -> DataFrame:
    """J16 by levels: one row per topic and positive gain of its ideal ranking.

    Columns: keys, step (1 for the highest gain), ig, first and last (its positions),
    n, disc_before, icum_before and cost_before (discounts, ideal DCG and cost of the
    positions before `first`), icum_last, inv (1 / icum_last), inv_more / cnt_more
    (sum of inv and count over the levels that follow).

    A topic of any size is counted, not sorted; its positions are made again, in
    stretches spread over tasks, to add up their discounts."""
    keys = list(keys)
    down = Window.partitionBy(*keys).orderBy(F.col("ig").desc())
    before = down.rowsBetween(Window.unboundedPreceding, -1)
    after = down.rowsBetween(1, Window.unboundedFollowing)
    zero = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0).cast("double"))
    counts = (qrels.where(F.col("rel") >= 0).select(*keys, gain_of(F.col("rel"), gains).alias("ig"))
              .where(F.col("ig") > 0).groupBy(*keys, "ig").agg(F.count(F.lit(1)).alias("n"))
              .select("*", F.row_number().over(down).cast("long").alias("step"),
                      F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_less"))
              .select(*keys, "ig", "n", "step", (F.col("_less") + 1).alias("first"), (F.col("_less") + F.col("n")).alias("last")))
    counts = cut_lineage(counts.dropna(subset=keys))
    # positions from `first` to `last`, never more than STRETCH in an array but for the starts
    start, end = F.col("_from"), F.least(F.col("_from") + (STRETCH - 1), F.col("last"))
    discounts = (counts.select(*keys, "step", "last", F.explode(F.sequence("first", "last", F.lit(STRETCH).cast("long"))).alias("_from"))
                 .repartition(*keys, "step", "_from")
                 .select(*keys, "step", F.explode(F.sequence(start, end)).alias("_pos"))
                 .groupBy(*keys, "step").agg(F.sum(1.0 / log2(F.col("_pos") + 1)).alias("_disc")))
    rows = counts.join(discounts, keys + ["step"])
    rows = rows.select("*", zero(F.col("_disc"), before).alias("disc_before"),
                       zero(F.col("ig") * F.col("_disc"), before).alias("icum_before"),
                       zero(F.greatest(F.col("ig"), F.lit(1.0)) * F.col("n"), before).alias("cost_before"))
    rows = rows.withColumn("icum_last", F.col("icum_before") + F.col("ig") * F.col("_disc")) \
        .withColumn("inv", 1.0 / F.col("icum_last"))
    return cut_lineage(rows.select(
        *keys, "step", "ig", "first", "last", "n", "disc_before", "icum_before", "cost_before", "icum_last", "inv",
        zero(F.col("inv"), after).alias("inv_more"), F.count(F.lit(1)).over(after).alias("cnt_more")))


def ideal_totals(levels: DataFrame, keys=("qid",)) -> DataFrame:
    """Per topic: L (positions with positive gain), IDCG over all of them, the
    total ideal gain, and the boundary sums over every position."""
    return levels.groupBy(*keys).agg(
        F.max("last").alias("L"),
        F.max("icum_last").alias("idcg"),
        F.sum(F.col("ig") * F.col("n")).alias("ig_total"),
        F.sum("inv").alias("inv_total"),
        F.count(F.lit(1)).alias("cnt_total"),
    )


def ideal_dcg_at(qrels: DataFrame, cutoffs, keys=("qid",), scan: bool = False) -> DataFrame:
    """Ideal DCG at each cutoff with gain = level (levels >= 1), for ndcg_cut.
    Columns: keys, idcg_cut_<k>."""
    judged = qrels.where(F.col("rel") >= 1).select(*keys, "docno", "rel")
    if scan:
        from .prefix import prefix_sums
        ranked = prefix_sums(judged.withColumn("_one", F.lit(1)), list(keys),
                             [F.col("rel").desc(), F.col("docno").asc()], {"pos": "_one"}, scan)
    else:
        w = Window.partitionBy(*keys).orderBy(F.col("rel").desc(), F.col("docno"))
        ranked = judged.withColumn("pos", F.row_number().over(w))
    disc = F.col("rel").cast("double") / log2(F.col("pos") + 1)
    return ranked.groupBy(*keys).agg(*[
        F.sum(F.when(F.col("pos") <= int(k), disc).otherwise(0.0)).alias(f"idcg_cut_{k}")
        for k in cutoffs])
