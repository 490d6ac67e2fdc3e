"""Ranking and the judged join.

Plan shape for the qrels path: one hash exchange on (run_id, qid); ranking, the
-M cut, the judged join, the running counts and the per-topic aggregate run
inside it while the planner's byte threshold lets it broadcast the judgements.
Beyond it the judged join becomes a sort-merge join on (qid, docno) and the
windows re-exchange on (run_id, qid).  Nothing is counted to choose.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import RELVALUE_NONPOOL, RELVALUE_UNJUDGED, EvalConfig
from ..functions.columns import flag

RUN_KEYS = ["run_id", "qid"]


def rank_order(tie: str = "desc") -> list[Column]:
    """float32 score descending, then docno (desc for qrels, asc for prefs)."""
    d = F.col("docno").desc() if tie == "desc" else F.col("docno").asc()
    return [F.col("sim").cast("float").desc(), d]


def run_window(tie: str = "desc", keys=RUN_KEYS) -> Window:
    return Window.partitionBy(*keys).orderBy(*rank_order(tie))


def rank_run(runs: DataFrame, tie: str = "desc", max_docs: int | None = None,
             keys=RUN_KEYS) -> DataFrame:
    """1-based rank per (run_id, qid); optional cut to the first M.

    The cut is a filter on row_number, which Catalyst turns into a
    WindowGroupLimit (partial top-M before the exchange)."""
    ranked = runs.withColumn("rank", F.row_number().over(run_window(tie, keys)))
    if max_docs is not None:
        ranked = ranked.where(F.col("rank") <= max_docs)
    return ranked


def relevance_code(rel: Column) -> Column:
    """-1 not in the judgements, -2 pooled but unjudged (rel < 0), else rel."""
    return (F.when(rel.isNull(), F.lit(RELVALUE_NONPOOL))
            .when(rel < 0, F.lit(RELVALUE_UNJUDGED))
            .otherwise(rel)).cast("int")


def topic_stats(qrels: DataFrame, level: int, keys=("qid",), find_repeats: bool = False) -> DataFrame:
    """Per topic R (rel >= level), judged nonrelevant count, number of
    relevance levels (highest non-negative level + 1) and judged count.

    `find_repeats` (J5) adds `repeated`, a document that the topic judges twice, or
    null.  Judgements are then added up per (topic, document) first, so that a
    topic with very many of them is spread over the tasks."""
    rel = F.col("rel")
    parts = {"R": F.sum(flag(rel >= level)), "Nn": F.sum(flag((rel >= 0) & (rel < level))),
             "num_levels": F.max(F.when(rel >= 0, rel)), "num_judged": F.sum(flag(rel >= 0))}
    levels = lambda c: F.coalesce(c + 1, F.lit(0)).alias("num_levels")
    if not find_repeats:
        return qrels.groupBy(*keys).agg(*[levels(c) if n == "num_levels" else c.alias(n) for n, c in parts.items()])
    per_doc = qrels.groupBy(*keys, "docno").agg(F.count(F.lit(1)).alias("_n"), *[c.alias(n) for n, c in parts.items()])
    return per_doc.groupBy(*keys).agg(
        F.sum("R").alias("R"), F.sum("Nn").alias("Nn"), levels(F.max("num_levels")),
        F.sum("num_judged").alias("num_judged"), F.min(F.when(F.col("_n") > 1, F.col("docno"))).alias("repeated"))


def judged_join(ranked: DataFrame, qrels: DataFrame, keys=("qid",)) -> DataFrame:
    """Left join of the ranked run with the judgements; adds `code`."""
    q = qrels.select(*keys, "docno", F.col("rel").alias("_rel"))
    j = ranked.join(q, [*keys, "docno"], "left")
    return j.withColumn("code", relevance_code(F.col("_rel"))).drop("_rel")


def mark_repeats(judged: DataFrame, run_keys=RUN_KEYS) -> DataFrame:
    """Adds `again`, true where the same ranking holds the document more than once.
    A window per document: rankings of any size are spread over the tasks, and after a
    shuffled join with the judgements it takes no exchange."""
    w = Window.partitionBy(*run_keys, "docno")
    return judged.withColumn("again", F.col("docno").isNotNull() & (F.count(F.lit(1)).over(w) > 1))


def repeats_spread(judged: DataFrame, run_keys=RUN_KEYS) -> DataFrame:
    """J4 for rankings too large for one task: (run keys, again_doc) of the rankings
    that hold a document twice, counted per document first."""
    return (duplicate_docs(judged, run_keys).groupBy(*run_keys).agg(F.min("docno").alias("again_doc")))


def duplicate_docs(df: DataFrame, keys) -> DataFrame:
    """(keys, docno) that occur more than once."""
    return df.groupBy(*keys, "docno").count().where(F.col("count") > 1)


def judged_rows(runs: DataFrame, qrels: DataFrame, cfg: EvalConfig,
                stats: DataFrame | None = None, tie: str = "desc",
                run_keys=RUN_KEYS, topic_keys=("qid",), find_repeats: bool = False) -> DataFrame:
    """The `judged` frame: one row per retrieved document of every evaluated
    (run, topic), with running counts.

    Columns: run keys, docno, sim, orig_rank, code, keep, rank, rel, nonrel,
    unj, nonpool, cr, cn, cu plus the topic statistics (R, Nn, num_levels,
    num_judged).  `keep` is false for rows -J drops; `rank` counts kept rows
    only (J8), so every measure conditions on `keep`.  `find_repeats` adds `again`
    (J4), before the ranking windows, whose sort then stays the only one of its
    stage; not where the prefix scan cuts rankings afterwards.  After a prefix scan
    `_chunk` may be left, for further running sums (prefix.running_sums).
    Only topics present in the judgements survive (J12, inner join).
    """
    if cfg.topic is not None:                      # J14, pushed to the scans
        runs = runs.where(F.col("qid") == cfg.topic)
        qrels = qrels.where(F.col("qid") == cfg.topic)
    if stats is None:
        stats = topic_stats(qrels, cfg.level, topic_keys)

    base = runs.select(*run_keys, "docno", F.col("sim").cast("float"))
    if cfg.skew_safe:
        ranked = base.withColumn("orig_rank", F.lit(None).cast("int"))
    else:
        ranked = rank_run(base, tie=tie, max_docs=cfg.cut, keys=run_keys)
        ranked = ranked.withColumnRenamed("rank", "orig_rank")
    j = judged_join(ranked, qrels, topic_keys)
    j = j.join(stats, list(topic_keys), "inner")
    if find_repeats and not (cfg.skew_safe and cfg.cut is not None):
        j = mark_repeats(j, run_keys)

    code = F.col("code")
    keep = (code >= 0) if cfg.judged_only else F.lit(True)
    lvl = cfg.level
    if cfg.skew_safe:
        return _judged_rows_scan(j.drop("orig_rank"), cfg, keep, tie, run_keys)
    # same partitioning and ordering as the ranking window: no new exchange,
    # and the sort survives the broadcast joins
    w = run_window(tie, run_keys).rowsBetween(Window.unboundedPreceding,
                                              Window.currentRow)
    j = (j.withColumn("keep", keep)
         .withColumn("rel", F.col("keep") & (code >= lvl))
         .withColumn("nonrel", F.col("keep") & (code >= 0) & (code < lvl))
         .withColumn("unj", F.col("keep") & (code == RELVALUE_UNJUDGED))
         .withColumn("nonpool", F.col("keep") & (code == RELVALUE_NONPOOL)))
    return j.select(
        "*",
        F.sum(flag(F.col("keep"))).over(w).alias("rank"),
        F.sum(flag(F.col("rel"))).over(w).alias("cr"),
        F.sum(flag(F.col("nonrel"))).over(w).alias("cn"),
        F.sum(flag(F.col("unj"))).over(w).alias("cu"),
    )


def _judged_rows_scan(j: DataFrame, cfg: EvalConfig, keep, tie: str, run_keys) -> DataFrame:
    """judged_rows via the distributed prefix scan (hot groups split)."""
    from .prefix import chunked, running_sums

    code = F.col("code")
    lvl = cfg.level
    j = chunked(j, list(run_keys), rank_order(tie), cfg.skew_safe)
    j = (j.withColumn("keep", keep)
         .withColumn("rel", F.col("keep") & (code >= lvl))
         .withColumn("nonrel", F.col("keep") & (code >= 0) & (code < lvl))
         .withColumn("unj", F.col("keep") & (code == RELVALUE_UNJUDGED))
         .withColumn("nonpool", F.col("keep") & (code == RELVALUE_NONPOOL))
         .withColumn("_one", F.lit(1))
         .withColumn("_k", flag(F.col("keep"))).withColumn("_r", flag(F.col("rel")))
         .withColumn("_n", flag(F.col("nonrel"))).withColumn("_u", flag(F.col("unj"))))
    out = running_sums(j, list(run_keys), rank_order(tie),
                       {"orig_rank": "_one", "rank": "_k", "cr": "_r", "cn": "_n", "cu": "_u"})
    if cfg.cut is not None:
        out = out.where(F.col("orig_rank") <= cfg.cut)
    return out.drop("_one", "_k", "_r", "_n", "_u")


def evaluated_topics(runs: DataFrame, stats: DataFrame, cfg: EvalConfig,
                     run_keys=RUN_KEYS, topic_keys=("qid",)) -> DataFrame:
    """(run keys) of every topic with both a run and judgements."""
    r = runs
    if cfg.topic is not None:
        r = r.where(F.col("qid") == cfg.topic)
    pairs = r.select(*run_keys).distinct()
    return pairs.join(stats.select(*topic_keys).distinct(), list(topic_keys), "left_semi")
