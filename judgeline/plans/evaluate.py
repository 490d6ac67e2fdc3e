"""evaluate(): runs + relevance judgements -> per-topic and summary measures.

Many runs are evaluated together: `run_id` is part of every key, nothing loops
over runs or topics on the driver, and all rank-based measures come out of
one aggregate over one window pass (see operators/judged.py for the shape).
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import EvalConfig
from ..functions.columns import lit_d, log2, safe_div
from ..functions.sqlexpr import cnt, sum0
from ..operators import judged as J
from ..operators import ideal as I
from ..operators import measures as M
from ..operators import summary as S
from ..session import broadcast_if_small, cut_lineage, keep


@dataclass
class Evaluation:
    """Result of an evaluation.

    per_topic_all: (run_id, qid, measure, value, kind, ord) numeric values
    strings:       (run_id, qid, measure, text, ord) string measures (relstring)
    num_q:         (run_id, n, n_orig)
    """
    per_topic_all: DataFrame
    strings: DataFrame | None
    num_q: DataFrame
    selected: list
    zscored: bool = False
    cached: list | None = None

    def release(self) -> None:
        """Drop the persisted judgements and per-topic table."""
        for df in self.cached or []:
            df.unpersist()

    @property
    def per_topic(self) -> DataFrame:
        """(run_id, qid, measure, value) as printed per topic."""
        return S.per_topic_visible(self.per_topic_all).select("run_id", "qid", "measure", "value")

    def require_overlap(self) -> None:
        """Fail when no topic has both results and judgements."""
        if self.num_q.isEmpty():
            raise ValueError("no queries with both results and relevance information")

    def summary(self) -> DataFrame:
        """(run_id, measure, value) averaged over topics, with num_q.
        Raises when no topic has both results and judgements (S12)."""
        self.require_overlap()
        s = S.summarize(self.per_topic_all, self.num_q)
        names = [n for n, _ in self.selected]
        extra = []
        if "num_q" in names:
            nq = self.num_q.select("run_id", F.lit("num_q").alias("measure"),
                                   F.col("n").cast("double").alias("value"),
                                   F.lit("count").alias("kind"),
                                   F.array(F.lit(M.MEASURE_ORDER.index("num_q"))).alias("ord"))
            extra.append(nq)
        s = s.select("run_id", "measure", "value", "kind", "ord")
        for e in extra:
            s = s.unionByName(e)
        return s

    def summary_values(self) -> DataFrame:
        return self.summary().select("run_id", "measure", "value")


def _gain_columns(judged: DataFrame, sets: list, run_keys, topic_keys, tie: str, scan: bool = False) -> DataFrame:
    """Attach the ideal row at each kept rank and the running gain sums of all sets
    of gains; every column added ends in its set's suffix.  `sets` are (suffix,
    gains, ideal levels).

    A row's level is the number of levels that start at or above its rank.  So the
    ranking is joined with the few levels only, on its own exchange and sort."""
    keep_, rank = F.col("keep"), F.col("rank")
    zero = lit_d(0)
    at = lambda df, col, on: df.join(on, [F.col(k) == F.col(f"_i_{k}") for k in topic_keys] + [col == F.col("_at")], "left") \
        .drop("_at", *[f"_i_{k}" for k in topic_keys])
    keys = [F.col(k).alias(f"_i_{k}") for k in topic_keys]
    j = judged.withColumn("_disc", F.when(keep_, 1.0 / log2(rank + 1)).otherwise(zero))
    sums = {"disc_cum": "_disc"}
    for x, gains, levels in sets:
        j = at(j, F.when(keep_, rank), levels.select(*keys, F.col("first").alias("_at"), F.lit(1).alias("_start" + x)))
        g = F.when(keep_, I.gain_of(F.col("code"), gains)).otherwise(zero)
        j = j.withColumn("g" + x, g).withColumn("_d" + x, F.when(g != 0, g / log2(rank + 1)).otherwise(zero))
        sums |= {"dcg_cum" + x: "_d" + x, "got_cum" + x: "g" + x, "_step" + x: "_start" + x}
    if scan:
        from ..operators.prefix import running_sums
        j = running_sums(j, list(run_keys), J.rank_order(tie), sums)
    else:
        w = J.run_window(tie, run_keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        j = j.select("*", *[F.sum(F.col(c)).over(w).alias(name) for name, c in sums.items()])
    own = ["ig", "first", "last", "disc_before", "icum_before", "cost_before", "inv", "inv_more", "cnt_more"]
    for x, _, levels in sets:
        j = at(j, F.col("_step" + x), levels.select(*keys, F.col("step").alias("_at"), *[F.col(c).alias(f"_l_{c}") for c in own]))
        lv = lambda c: F.col(f"_l_{c}")
        inside = keep_ & (rank <= lv("last"))
        ended = F.greatest(lv("ig"), lit_d(1)) * (F.least(rank, lv("last")) - lv("first") + 1) + F.greatest(rank - lv("last"), F.lit(0))
        j = j.select(
            "*", F.when(inside, lv("icum_before") + lv("ig") * (F.col("disc_cum") - lv("disc_before"))).alias("icum" + x),
            F.when(inside, rank == lv("last")).alias("bnd" + x),
            F.when(inside, lv("inv_more") + F.when(rank < lv("last"), lv("inv")).otherwise(zero)).alias("inv_after" + x),
            F.when(inside, lv("cnt_more") + F.when(rank < lv("last"), 1).otherwise(0)).alias("cnt_after" + x),
            F.coalesce(lv("cost_before") + ended, rank.cast("double")).alias("cost_cum" + x)).drop(*[f"_l_{c}" for c in own])
    return j


def _gain_aggs(ctx: M.Ctx, x: str) -> None:
    ctx.agg(f"_dcg{x}", f"coalesce(sum(_d{x}), 0D)")
    ctx.agg(f"_g_sum{x}", sum0(f"keep AND g{x} <> 0", f"g{x} / log2(cost_cum{x} - got_cum{x} + 2)"))
    ctx.agg(f"_ndcg_rel_sum{x}", sum0(f"keep AND g{x} > 0 AND icum{x} IS NOT NULL", f"dcg_cum{x} / icum{x}"))
    ctx.agg(f"_ndcg_rel_beyond{x}", sum0(f"keep AND g{x} > 0 AND icum{x} IS NULL", f"dcg_cum{x}"))
    ctx.agg(f"_pos_ret{x}", cnt(f"keep AND g{x} > 0"))
    ctx.agg(f"_rndcg_sum{x}", sum0(f"keep AND bnd{x}", f"dcg_cum{x} / icum{x}"))
    ctx.agg(f"_rndcg_cnt{x}", cnt(f"keep AND bnd{x}"))
    ctx.agg(f"_inv_after_last{x}", f"max_by(inv_after{x}, CASE WHEN keep THEN rank END)")
    ctx.agg(f"_cnt_after_last{x}", f"max_by(cnt_after{x}, CASE WHEN keep THEN rank END)")
    ctx.agg("_num_ret_g", cnt("keep"))


def _gain_finish(agg: DataFrame, totals: DataFrame, x: str, topic_keys) -> DataFrame:
    names = ["L", "idcg", "ig_total", "inv_total", "cnt_total"]
    a = agg.join(totals.select(*topic_keys, *[F.col(c).alias(c + x) for c in names]), list(topic_keys), "left")
    a = a.fillna(0, subset=[c + x for c in names])
    c = lambda name: F.col(name + x)
    n = F.col("_num_ret_g")
    # Beyond a run's end: ndcg_rel uses IDCG over all ideal positions; the
    # Rndcg boundaries after the last retrieved rank use the final DCG.
    a = a.withColumn("_ndcg_rel_sum" + x, c("_ndcg_rel_sum") + safe_div(c("_ndcg_rel_beyond"), c("idcg")))
    tail_sum = (F.when(n < c("L"), c("_dcg") * F.coalesce(c("_inv_after_last"), c("inv_total")))
                .when(n > c("L") + 1, safe_div(c("_dcg"), c("idcg")))
                .otherwise(lit_d(0)))
    tail_cnt = (F.when(n < c("L"), F.coalesce(c("_cnt_after_last"), c("cnt_total")))
                .when((n > c("L") + 1) & (c("idcg") > 0), F.lit(1))
                .otherwise(F.lit(0)))
    return a.withColumn("_rndcg_tail_sum" + x, tail_sum).withColumn("_rndcg_tail_cnt" + x, tail_cnt)


def evaluate(runs: DataFrame, qrels: DataFrame, measures="official",
             config: EvalConfig | None = None, zref: DataFrame | None = None,
             run_keys=("run_id", "qid"), topic_keys=("qid",),
             judged: DataFrame | None = None) -> Evaluation:
    """Evaluate runs(run_id, qid, docno, sim) against qrels(qid, docno, rel).

    `measures`: nickname ("official", "all_trec", "set"), list of names, or a
    dict name -> params (cutoff list, fraction list, {level: gain}, ...).
    """
    cfg = config or EvalConfig()
    run_keys, topic_keys = list(run_keys), list(topic_keys)
    selected = M.resolve(measures)
    ctx = M.Ctx(level=cfg.level, num_docs=cfg.num_docs)
    outs = []
    for name, params in selected:
        outs.extend(M.BUILDERS[name](ctx, params))

    if cfg.topic is not None:
        qrels = qrels.where(F.col("qid") == cfg.topic)
        runs = runs.where(F.col("qid") == cfg.topic)
    # judgements feed several joins and aggregates: keep them once
    qrels = keep(qrels)
    persisted = [qrels]
    stats = J.topic_stats(qrels, cfg.level, topic_keys, find_repeats=cfg.strict)
    if ctx.gain_sets:
        # one row per topic; a shuffled join would sort the ranking by topic alone
        stats = broadcast_if_small(cut_lineage(stats))
    if judged is None:
        judged = J.judged_rows(runs, qrels, cfg, stats, run_keys=run_keys, topic_keys=topic_keys,
                               find_repeats=cfg.strict)
    sets = [(f"_{i}", gains, broadcast_if_small(I.ideal_levels(qrels, gains, topic_keys)))
            for i, gains in enumerate(ctx.gain_sets)]
    if sets:
        judged = _gain_columns(judged, sets, run_keys, topic_keys, "desc", scan=cfg.skew_safe)
    for x, _, _ in sets:
        _gain_aggs(ctx, x)

    aggs = [F.expr(e).alias(a) for a, e in ctx.aggs.items()] or [F.count(F.lit(1)).alias("_n")]
    # equal in all rows of a group; as aggregates, those that no measure asks for leave the rows
    aggs += [F.max(c).alias(c) for c in ("R", "Nn", "num_levels", "num_judged")]
    spread = False
    if cfg.strict:
        aggs.append(F.min("repeated").alias("_judged_twice"))
        spread = bool(cfg.skew_safe) and "again" not in judged.columns
        if not spread:
            judged = judged if "again" in judged.columns else J.mark_repeats(judged, run_keys)
            aggs.append(F.min(F.when(F.col("again"), F.col("docno"))).alias("_ranked_twice"))
    agg = judged.groupBy(*run_keys).agg(*aggs)
    if spread:
        agg = agg.join(J.repeats_spread(judged, run_keys).withColumnRenamed("again_doc", "_ranked_twice"), run_keys, "left")

    for x, _, levels in sets:
        agg = _gain_finish(agg, I.ideal_totals(levels, topic_keys), x, topic_keys)
    if ctx.needs_idcg_cut:
        cut = I.ideal_dcg_at(qrels, sorted(ctx.needs_idcg_cut), topic_keys, scan=cfg.skew_safe)
        agg = agg.join(cut, topic_keys, "left").fillna(
            0.0, subset=[f"idcg_cut_{k}" for k in ctx.needs_idcg_cut])

    numeric = [o for o in outs if o.kind in ("sum", "mean", "geo")]
    strings = [o for o in outs if o.kind == "topic"]
    order = {o.name: (M.MEASURE_ORDER.index(_base(o.name, selected)),) + tuple(o.order)
             for o in outs}
    # one row per evaluated (run, topic): small, reused by every output
    faults = ["_judged_twice", "_ranked_twice"] if cfg.strict else []
    wide = keep(agg.select(*run_keys, *faults, *[F.expr(o.expr).alias(f"_m{i}") for i, o in enumerate(numeric)],
                      *[F.expr(o.expr).alias(f"_s{i}") for i, o in enumerate(strings)]))
    if cfg.strict:
        _raise_on_repeats(wide, run_keys)
    per_topic = S.to_long(wide, run_keys,
                          [(f"_m{i}", o.name, o.kind, order[o.name]) for i, o in enumerate(numeric)])
    if zref is not None:
        per_topic = S.zscore(per_topic, zref)
    str_df = None
    if strings:
        items = ", ".join(
            f"named_struct('measure', '{o.name}', 'text', _s{i}, 'ord', "
            f"array({', '.join(str(x) for x in order[o.name])}))"
            for i, o in enumerate(strings))
        str_df = wide.select(*run_keys, F.expr(f"inline(array({items}))"))

    # Topics with both a run and judgements = the aggregate's groups
    topics_per_run = wide.select("run_id", "qid").distinct() \
        .groupBy("run_id").agg(F.count(F.lit(1)).alias("n_orig"))
    if cfg.complete:
        n_judged = qrels.select("qid").distinct().count()   # topics, not groups of them
        num_q = topics_per_run.withColumn("n", F.lit(n_judged).cast("long"))
    else:
        num_q = topics_per_run.withColumn("n", F.col("n_orig"))
    return Evaluation(per_topic, str_df, num_q, selected, zscored=zref is not None,
                      cached=persisted + [wide])


def _raise_on_repeats(wide: DataFrame, run_keys) -> None:
    """J4/J5 as errors: a document twice in a ranking (after the cut) or in the
    judgements of its topic.  The evaluation itself has found them, for the topics
    it evaluates; this reads its kept rows."""
    for what, c in (("judgements", "_judged_twice"), ("results", "_ranked_twice")):
        bad = wide.where(F.col(c).isNotNull()).agg(F.min(F.struct(*run_keys, c)).alias("r")).first()["r"]
        if bad is not None:
            found = bad.asDict()
            raise ValueError(f"duplicate document in {what}: {found.pop(c)} in {found}")


def _base(name: str, selected) -> str:
    for b, _ in sorted(selected, key=lambda kv: -len(kv[0])):
        if name == b or name.startswith(b + "_"):
            return b
    return name
