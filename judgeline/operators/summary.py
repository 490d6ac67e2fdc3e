"""Aggregation over topics, z-scores and line selection.

Per-topic values live in a long table (run_id, qid, measure, value) plus the
private columns `kind` (sum / mean / geo) and `ord` (report order).  The
summary is a single groupBy(run_id, measure) with partial aggregation.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import MIN_GEO_MEAN, MISSING_ZSCORE_VALUE
from ..functions.columns import lit_d


def to_long(wide: DataFrame, keys: list[str], outs: list) -> DataFrame:
    """Wide per-topic columns -> (keys, measure, value, kind, ord).

    `outs` are (column alias, measure name, kind, order tuple)."""
    if not outs:
        return wide.select(*keys, F.lit(None).cast("string").alias("measure"),
                           F.lit(None).cast("double").alias("value"),
                           F.lit(None).cast("string").alias("kind"),
                           F.expr("CAST(array() AS ARRAY<INT>)").alias("ord")).where(F.lit(False))
    items = ", ".join(
        f"named_struct('measure', '{name}', 'value', CAST({alias} AS DOUBLE), "
        f"'kind', '{kind}', 'ord', array({', '.join(str(int(x)) for x in order)}))"
        for alias, name, kind, order in outs)
    return wide.select(*keys, F.expr(f"inline(array({items}))"))


def zscore(per_topic: DataFrame, zref: DataFrame) -> DataFrame:
    """A4: (value - mean) / stddev per (qid, measure); a topic missing from the
    reference or a missing measure gives -1000000; stddev 0 gives 0 when the
    value equals the mean and -1000000 otherwise."""
    z = zref.select("qid", "measure", F.col("mean").alias("_zm"), F.col("stddev").alias("_zs"))
    topics = zref.select("qid").distinct().withColumn("_zq", F.lit(True))
    j = per_topic.join(z, ["qid", "measure"], "left").join(topics, ["qid"], "left")
    v, m, s = F.col("value"), F.col("_zm"), F.col("_zs")
    miss = lit_d(MISSING_ZSCORE_VALUE)
    zv = (F.when(F.col("_zq").isNull() | m.isNull(), miss)
          .when(s != 0, (v - m) / s)
          .when(v == m, lit_d(0))
          .otherwise(miss))
    return j.withColumn("value", zv).drop("_zm", "_zs", "_zq")


def summarize(per_topic: DataFrame, num_q: DataFrame) -> DataFrame:
    """A1-A3: combine per-topic values per (run_id, measure).

    `num_q` is (run_id, n, n_orig): the divisor (judged topics under -c) and
    the number of evaluated topics.  Missing topics add 0 to means and
    ln(1e-5) to geometric means."""
    acc = per_topic.groupBy("run_id", "measure", "kind", "ord").agg(
        F.sum("value").alias("_sum"))
    acc = acc.join(num_q, "run_id")   # one row per run
    n = F.col("n").cast("double")
    geo_sum = F.col("_sum") + (F.col("n") - F.col("n_orig")) * lit_d(math.log(MIN_GEO_MEAN))
    value = (F.when(F.col("kind") == "sum", F.col("_sum"))
             .when(F.col("kind") == "geo",
                   F.when(n > 0, F.exp(geo_sum / n)).otherwise(lit_d(0)))
             .otherwise(F.when(n > 0, F.col("_sum") / n).otherwise(lit_d(0))))
    return acc.select("run_id", "measure", value.alias("value"), "kind", "ord")


def per_topic_visible(per_topic: DataFrame) -> DataFrame:
    """Geometric-mean measures are summary-only."""
    return per_topic.where(F.col("kind") != "geo")
