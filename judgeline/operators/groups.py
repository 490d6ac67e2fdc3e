"""Per-user judgement-group measures.

Each (qid, jg) is evaluated as its own topic: the run is crossed with the
topic's judgement groups (the distinct (qid, jg) pairs), judged per group, and every measure is the
plain mean over the topic's groups.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import EvalConfig
from ..operators import measures as M

# per-group measure -> measure computed inside each group
JG_BASE = {"map_avgjg": "map", "P_avgjg": "P", "Rprec_mult_avgjg": "Rprec_mult"}


def runs_per_group(runs: DataFrame, qrels_jg: DataFrame, cfg: EvalConfig) -> DataFrame:
    """Every run row repeated for each judgement group of its topic."""
    groups = qrels_jg.select("qid", "jg").distinct()
    return runs.join(groups, "qid")


def evaluate_jg(runs: DataFrame, qrels_jg: DataFrame, measures="qrels_jg",
                config: EvalConfig | None = None):
    """Evaluate runs against qrels_jg(qid, jg, docno, rel)."""
    from ..plans.evaluate import Evaluation, evaluate

    cfg = config or EvalConfig()
    selected = M.resolve(measures)
    inner = {}
    for name, params in selected:
        if name in JG_BASE:
            inner[JG_BASE[name]] = params
        elif name not in ("runid", "num_q"):
            raise KeyError(f"{name} is not a per-group measure")
    rj = runs_per_group(runs, qrels_jg, cfg)
    ev = evaluate(rj, qrels_jg, inner, cfg, run_keys=("run_id", "qid", "jg"),
                  topic_keys=("qid", "jg"))
    base_of = {v: k for k, v in JG_BASE.items()}
    pt = ev.per_topic_all
    per_topic = (pt.groupBy("run_id", "qid", "measure", "kind", "ord")
                 .agg(F.avg("value").alias("value")))
    per_topic = per_topic.withColumn("measure", _rename_col(base_of))
    per_topic = per_topic.withColumn(
        "ord", F.concat(F.array(_order_col(base_of)), F.slice("ord", 2, 10)))
    per_topic = per_topic.select("run_id", "qid", "measure", "value", "kind", "ord")
    return Evaluation(per_topic, None, ev.num_q, selected, cached=ev.cached)


def _rename_col(base_of: dict):
    m = F.col("measure")
    expr = m
    # longest base names first: Rprec_mult before P
    for base in sorted(base_of, key=len, reverse=True):
        jg = base_of[base]
        expr = F.when(m == base, F.lit(jg)).when(
            m.startswith(base + "_") & (expr == m),
            F.concat(F.lit(jg + "_"), F.expr(f"substring(measure, {len(base) + 2})"))
        ).otherwise(expr)
    return expr


def _order_col(base_of: dict):
    m = F.col("measure")
    expr = F.lit(None).cast("int")
    for base in sorted(base_of, key=len):
        jg = base_of[base]
        expr = F.when((m == base) | m.startswith(base + "_"),
                      F.lit(M.MEASURE_ORDER.index(jg))).otherwise(expr)
    return expr
