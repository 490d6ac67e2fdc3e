"""Properties of the measures on fixture B (sf0.001)."""
import pytest
from pyspark.sql import functions as F

from conftest import SF
from judgeline.config import EvalConfig
from judgeline.operators import judged as J
from judgeline.plans import fixtures as FX
from judgeline.plans.evaluate import evaluate


@pytest.fixture(scope="module")
def b(spark):
    return FX.fixture_b_runs(spark, SF), FX.fixture_b_qrels(spark, SF)


def _pt(ev):
    return {(r.run_id, r.qid, r.measure): r.value for r in ev.per_topic.collect()}


def test_precision_times_cutoff_is_integer(b):
    runs, qrels = b
    for r in evaluate(runs, qrels, ["P"]).per_topic.collect():
        k = int(r.measure.split("_")[1])
        assert abs(r.value * k - round(r.value * k)) < 1e-9


def test_ndcg_bounded(b):
    runs, qrels = b
    for r in evaluate(runs, qrels, ["ndcg", "ndcg_cut", "ndcg_rel", "Rndcg"]).per_topic.collect():
        assert -1e-12 <= r.value <= 1 + 1e-9


def test_runs_together_equal_runs_alone(b):
    runs, qrels = b
    both = _pt(evaluate(runs, qrels, ["map", "bpref", "P", "G"]))
    one = _pt(evaluate(runs.where(F.col("run_id") == "sumqty"), qrels, ["map", "bpref", "P", "G"]))
    for k, v in one.items():
        assert both[k] == pytest.approx(v, abs=1e-12)


def test_judged_only_on_fully_judged_run_changes_nothing(b):
    runs, qrels = b
    judged = runs.join(qrels.where("rel >= 0"), ["qid", "docno"], "left_semi")
    a = _pt(evaluate(judged, qrels, ["map", "P", "bpref"]))
    c = _pt(evaluate(judged, qrels, ["map", "P", "bpref"], EvalConfig(judged_only=True)))
    assert a.keys() == c.keys()
    for k in a:
        assert a[k] == pytest.approx(c[k], abs=1e-12)


def test_no_duplicates_in_fixture(b):
    runs, qrels = b
    assert J.duplicate_docs(runs, ["run_id", "qid"]).count() == 0
    assert J.duplicate_docs(qrels.withColumn("run_id", F.lit("q")), ["run_id", "qid"]).count() == 0


def test_num_q_and_summary_sum(b):
    runs, qrels = b
    ev = evaluate(runs, qrels, ["num_q", "num_ret"])
    s = {(r.run_id, r.measure): r.value for r in ev.summary_values().collect()}
    n = runs.groupBy("run_id").count().collect()
    for r in n:
        assert s[(r.run_id, "num_ret")] == r["count"]


def test_prefix_scan_equals_windows(b):
    """The skew-safe running counts (hot groups split across partitions)
    give exactly the per-group window results."""
    runs, qrels = b
    ms = ["map", "bpref", "infAP", "P", "G", "ndcg_rel", "Rndcg", "relstring"]
    for cfg in (dict(), dict(max_docs=7), dict(judged_only=True)):
        a = _pt(evaluate(runs, qrels, ms, EvalConfig(skew_safe=False, **cfg)))
        c = _pt(evaluate(runs, qrels, ms, EvalConfig(skew_safe=8, **cfg)))
        assert a.keys() == c.keys()
        for k in a:
            assert c[k] == pytest.approx(a[k], abs=1e-12)


def test_prefs_prefix_scan_equals_windows(spark):
    from judgeline.operators.prefs import evaluate_prefs
    runs, prefs = FX.fixture_d_runs(spark, SF), FX.fixture_d_prefs(spark, SF)
    for p in (prefs, prefs.where("jsg = '0'")):
        a = _pt(evaluate_prefs(runs, p, "all_prefs", EvalConfig(skew_safe=False)))
        c = _pt(evaluate_prefs(runs, p, "all_prefs", EvalConfig(skew_safe=8)))
        assert a.keys() == c.keys()
        for k in a:
            assert c[k] == pytest.approx(a[k], abs=1e-12)


@pytest.mark.parametrize("hot_rows", [1, 30, 10**6])
def test_hot_groups_alone_are_chunked(spark, hot_rows):
    """Nine rows in ten in one group, ties and a null group included."""
    from pyspark.sql import Window
    from judgeline.operators.prefix import prefix_sums
    rows = [("hot" if i % 10 else ("cold" if i % 20 else None), (i * 7919) % 997, i, i % 3) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, o int, id int, v int").repartition(5)
    order = [F.col("o").desc(), F.col("id").asc()]
    got = {r.id: r.s for r in prefix_sums(df, ["g"], order, {"s": "v"}, hot_rows).collect()}
    w = Window.partitionBy("g").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    assert got == {r.id: r.s for r in df.withColumn("s", F.sum("v").over(w)).collect()}
