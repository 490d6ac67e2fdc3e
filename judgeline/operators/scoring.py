"""Retrieval models and top-k.

Plan: pruned postings (docno, dl, term, tf) -> join with the query terms and
their statistics (broadcast only when their measured bytes allow it, else a
shuffle join that splits skewed terms) -> one `groupBy(kind, qid, docno)` computing every requested model's score
at once (partial aggregation, so a frequent term spreads over documents) ->
per-topic top-k with `row_number() <= k` (Catalyst plans a WindowGroupLimit:
each map partition ships at most k rows per topic).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, keep
from .termstats import CollectionStats

# Fixed values of the reference's models.
BM25_K1 = 1.2
BM25_B = 0.75
DIRICHLET_MU = 2000.0
JM_LAMBDA = 0.7
TOP_K = 1000
# run tags written by the reference programs
RUN_TAGS = {"tfidf": "DEFAULT", "classic": "Default", "bm25": "BM25",
            "lm_dirichlet": "LMDirichlet", "lm_jm": "LMJelinekMercer"}
MODELS = list(RUN_TAGS)


def _d(x) -> Column:
    return F.lit(float(x)).cast("double")


def term_weights(qterms: DataFrame, tstats: DataFrame, stats: CollectionStats) -> DataFrame:
    """Query terms (keys..., term, qtf) with df, ttf and per-model idf /
    collection probability; terms absent from the collection get df 0."""
    n = _d(stats.num_docs)
    t = qterms.join(tstats, "term", "left").fillna(0, subset=["df", "ttf"])
    df, ttf = F.col("df").cast("double"), F.col("ttf").cast("double")
    return t.select(
        "*",
        F.when(df > 0, F.log10(_d(1) + n / df)).alias("idf_tfidf"),
        (_d(1) + F.log(n / (df + 1))).alias("idf_classic"),
        F.log(_d(1) + (n - df + _d(0.5)) / (df + _d(0.5))).alias("idf_bm25"),
        ((ttf + 1) / _d(stats.total_tokens + 1)).alias("p_coll"),
    )


def topic_norms(weights: DataFrame, keys: list[str]) -> DataFrame:
    """Per topic: number of query clauses and the classic query norm."""
    return weights.groupBy(*keys).agg(
        F.sum("qtf").alias("clauses"),
        (_d(1) / F.sqrt(F.sum(F.col("qtf") * F.col("idf_classic") * F.col("idf_classic"))))
        .alias("query_norm"))


def contributions(stats: CollectionStats, models) -> dict[str, Column]:
    """Per matched (topic, document, term) row: each model's summand."""
    tf, dl, qtf = F.col("tf").cast("double"), F.col("dl").cast("double"), F.col("qtf")
    avgdl = _d(stats.avgdl)
    p = F.col("p_coll")
    out = {}
    if "tfidf" in models:      # T11: distinct query terms
        out["tfidf"] = (tf / dl) * F.col("idf_tfidf")
    if "classic" in models:    # T12 (before coord and query norm)
        out["classic"] = qtf * F.sqrt(tf) * F.col("idf_classic") * F.col("idf_classic") / F.sqrt(dl)
    if "bm25" in models:       # T13
        out["bm25"] = qtf * F.col("idf_bm25") * tf * _d(BM25_K1 + 1) / (
            tf + _d(BM25_K1) * (_d(1 - BM25_B) + _d(BM25_B) * dl / avgdl))
    if "lm_dirichlet" in models:  # T14
        mu = _d(DIRICHLET_MU)
        out["lm_dirichlet"] = qtf * F.greatest(
            _d(0), F.log(_d(1) + tf / (mu * p)) + F.log(mu / (dl + mu)))
    if "lm_jm" in models:      # T15
        lam = _d(JM_LAMBDA)
        out["lm_jm"] = qtf * F.log(_d(1) + ((_d(1) - lam) * tf / dl) / (lam * p))
    return out


def score(post: DataFrame, qterms: DataFrame, tstats: DataFrame, stats: CollectionStats,
          models=MODELS, keys=("qid",)) -> DataFrame:
    """Scores of every document containing at least one query term:
    (keys..., docno, <model>...) for the requested models."""
    keys = list(keys)
    w = keep(term_weights(qterms, tstats, stats))
    j = post.join(broadcast_if_small(w), "term")
    parts = contributions(stats, models)
    aggs = [F.sum(c).alias(m) for m, c in parts.items()]
    if "classic" in models:
        aggs.append(F.sum("qtf").alias("_matched"))
    s = j.groupBy(*keys, "docno").agg(*aggs)
    if "classic" in models:
        nb = keep(topic_norms(w, keys))
        s = s.join(broadcast_if_small(nb), keys).withColumn(
            "classic", F.col("classic") * F.col("query_norm") * F.col("_matched") / F.col("clauses")
        ).drop("_matched", "clauses", "query_norm")
    return s


def top_k(scored: DataFrame, k: int = TOP_K, keys=("run_id", "qid"), score_col: str = "score",
          round_digits: int | None = None, zero_based: bool = False) -> DataFrame:
    """The k best documents per topic, ties by docno; adds `rank`
    (1-based, or 0-based as in the comparison program)."""
    s = F.col(score_col)
    if round_digits is not None:
        s = F.round(s, round_digits)
    w = Window.partitionBy(*keys).orderBy(s.desc(), F.col("docno").asc())
    r = scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    if zero_based:
        r = r.withColumn("rank", F.col("rank") - 1)
    return r


BOUND_PART = 16     # one document in so many gives the bounds of `above_bounds`


def above_bounds(runs: DataFrame, k: int = TOP_K, keys=("run_id", "qid"), score_col: str = "score",
                 round_digits: int | None = None) -> DataFrame:
    """The rows that can be among the `k` best of their topic: all that are not below
    the k-th best of one document in `BOUND_PART` (picked by hash), as the k-th best of
    all is no worse than that.  Topics with fewer than `k` such documents keep all rows.

    Exact: `top_k` finds the same rows afterwards, but sorts about k x `BOUND_PART` rows
    a topic whatever the number of documents."""
    keys = list(keys)
    s = F.col(score_col) if round_digits is None else F.round(F.col(score_col), round_digits)
    part = runs.where(F.pmod(F.xxhash64("docno"), F.lit(BOUND_PART)) == 0)
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(s.desc()))
    bounds = keep(part.select(*keys, s.alias("_bound"), last.alias("_n")).where(F.col("_n") <= k)
                  .where(F.col("_n") == k).select(*keys, "_bound"))
    return runs.join(broadcast_if_small(bounds), keys, "left") \
        .where(F.col("_bound").isNull() | (s >= F.col("_bound"))).drop("_bound")


def as_runs(scored: DataFrame, models, kind_col: str | None = "kind") -> DataFrame:
    """Model score columns -> runs(run_id, qid, docno, score) with the
    reference's run tags (e.g. BM25_SHORT), via one stack per row."""
    items = ", ".join(
        f"'{RUN_TAGS[m]}', {m}" for m in models)
    st = F.expr(f"stack({len(models)}, {items}) AS (model_tag, score)")
    out = scored.select("*", st)
    tag = F.col("model_tag")
    if kind_col is not None:
        tag = F.concat(tag, F.lit("_"), F.upper(F.col(kind_col)))
    return out.select(tag.alias("run_id"), "qid", "docno", "score")


def explain_terms(post: DataFrame, qterms: DataFrame, tstats: DataFrame, stats: CollectionStats,
                  model: str = "tfidf", keys=("qid",)) -> DataFrame:
    """Per (topic, document, term) contribution and running score in
    first-seen query-term order."""
    w = keep(term_weights(qterms, tstats, stats))
    j = post.join(broadcast_if_small(w), "term")
    c = contributions(stats, [model])[model]
    rw = Window.partitionBy(*keys, "docno").orderBy("first_pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return j.select(*keys, "docno", "term", "first_pos", c.alias("contribution")) \
        .withColumn("running", F.sum("contribution").over(rw))


def check_models(models):
    bad = [m for m in models if m not in RUN_TAGS]
    if bad:
        raise ValueError(f"unknown models {bad}")
    return list(models)
