"""Headline-query timings at one scale factor; prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Every query runs over the whole tables; results are forced with a no-op
write (all columns) or a collect of a small summary.
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from judgeline.operators.groups import evaluate_jg  # noqa: E402
from judgeline.operators.prefs import evaluate_prefs  # noqa: E402
from judgeline.plans import fixtures as FX  # noqa: E402
from judgeline.plans.evaluate import evaluate  # noqa: E402
from judgeline.plans.retrieve import compare_runs, retrieve  # noqa: E402
from judgeline.session import env_cpus, local_session  # noqa: E402


def _force(df):
    df.write.format("noop").mode("overwrite").save()


def q_eval_official(spark, sf):
    ev = evaluate(FX.fixture_b_runs(spark, sf), FX.fixture_b_qrels(spark, sf), "official")
    ev.summary_values().collect()
    _force(ev.per_topic)
    ev.release()


def q_eval_all_trec(spark, sf):
    ev = evaluate(FX.fixture_b_runs(spark, sf), FX.fixture_b_qrels(spark, sf), "all_trec")
    ev.summary_values().collect()
    _force(ev.per_topic)
    ev.release()


def q_eval_qrels_jg(spark, sf):
    ev = evaluate_jg(FX.fixture_b_runs(spark, sf), FX.fixture_c_qrels_jg(spark, sf), "qrels_jg")
    ev.summary_values().collect()
    ev.release()


def q_eval_prefs(spark, sf):
    ev = evaluate_prefs(FX.fixture_d_runs(spark, sf), FX.fixture_d_prefs(spark, sf), "all_prefs")
    ev.summary_values().collect()
    ev.release()


def q_retrieve_grid(spark, sf):
    runs = retrieve(FX.fixture_a_docs(spark, sf), FX.fixture_a_topics(spark, sf), k=1000)
    _force(runs)


def q_retrieve_evaluate(spark, sf):
    runs = retrieve(FX.fixture_a_docs(spark, sf), FX.fixture_a_topics(spark, sf), k=1000) \
        .selectExpr("run_id", "qid", "docno", "CAST(score AS FLOAT) AS sim")
    ev = evaluate(runs, FX.fixture_a_qrels(spark, sf), "official")
    compare_runs(ev.summary_values()).collect()
    ev.release()


QUERIES = {
    "eval_official": q_eval_official,
    "eval_all_trec": q_eval_all_trec,
    "eval_qrels_jg": q_eval_qrels_jg,
    "eval_prefs": q_eval_prefs,
    "retrieve_grid": q_retrieve_grid,
    "retrieve_evaluate": q_retrieve_evaluate,
}


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = env_cpus()
    spark = local_session(cores=cpus, shuffle_partitions=max(8, cpus))
    # Untimed JVM/JIT warm-up on the smallest scale factor (a different
    # dataset; every persisted frame is released, nothing is reused).
    warm = os.path.join(os.path.dirname(sf.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        q_eval_official(spark, warm)
        q_retrieve_grid(spark, warm)
        spark.catalog.clearCache()
    times = {}
    for name, fn in QUERIES.items():
        t0 = time.time()
        fn(spark, sf)
        times[name] = round(time.time() - t0, 3)
    sf_label = os.path.basename(sf.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf_label}))


if __name__ == "__main__":
    main()
