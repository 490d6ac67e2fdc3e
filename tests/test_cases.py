"""Options held to values worked out by hand on a small case.

Topic 1 judges a=2 b=1 c=0 d=1 and topic 2 judges x=1 y=0; topic 3 has
judgements and no results.  The run ranks b, c, z, a for topic 1 and y, x for 2.
"""
import math

import pytest

from conftest import report
from judgeline.config import EvalConfig
from judgeline.operators.groups import evaluate_jg
from judgeline.operators.prefs import evaluate_prefs
from judgeline.plans.evaluate import evaluate
from judgeline.session import owned
from judgeline.sources.text_formats import qrels_to_prefs


@pytest.fixture(scope="module")
def runs(spark):
    rows = [("r", "1", d, 10.0 - i) for i, d in enumerate("bcza")] + [("r", "2", d, 2.0 - i) for i, d in enumerate("yx")]
    return spark.createDataFrame(rows, "run_id string, qid string, docno string, sim float").cache()


@pytest.fixture(scope="module")
def qrels(spark):
    rows = [("1", "a", 2), ("1", "b", 1), ("1", "c", 0), ("1", "d", 1), ("2", "x", 1), ("2", "y", 0), ("3", "k", 1)]
    return spark.createDataFrame(rows, "qid string, docno string, rel int").cache()


def topic(ev, qid="1"):
    return {r.measure: r.value for r in ev.per_topic.where(f"qid = '{qid}'").collect()}


def summary(ev):
    return {r.measure: r.value for r in ev.summary_values().collect()}


def test_basic(runs, qrels):
    ev = evaluate(runs, qrels, {"num_q": None, "num_ret": None, "num_rel": None, "num_rel_ret": None, "map": None,
                                "P": [2, 5], "recip_rank": None, "Rprec": None, "bpref": None})
    got = topic(ev)
    ap = (1 / 1 + 2 / 4) / 3
    assert got["map"] == pytest.approx(ap) and got["P_2"] == 0.5 and got["P_5"] == pytest.approx(2 / 5)
    assert got["Rprec"] == pytest.approx(1 / 3) and got["recip_rank"] == 1
    assert got["bpref"] == pytest.approx((1 + 0) / 3)      # one nonrelevant, before the second relevant one
    all_ = summary(ev)
    assert (all_["num_q"], all_["num_ret"], all_["num_rel"], all_["num_rel_ret"]) == (2, 6, 4, 3)
    assert all_["map"] == pytest.approx((ap + 0.5) / 2)


def test_complete_cut_and_level(runs, qrels):
    assert summary(evaluate(runs, qrels, ["num_q", "map"], EvalConfig(complete=True)))["num_q"] == 3
    cut = topic(evaluate(runs, qrels, ["map", "num_ret"], EvalConfig(max_docs=2)))
    assert cut["map"] == pytest.approx(1 / 3) and cut["num_ret"] == 2
    high = topic(evaluate(runs, qrels, {"map": None, "relstring": [4]}, EvalConfig(level=2)))
    assert high["map"] == pytest.approx(1 / 4)
    ev = evaluate(runs, qrels, {"relstring": [4]})
    assert {r.text for r in ev.strings.where("qid = '1'").collect()} == {"10-2"}


def test_gains_of_their_own(runs, qrels):
    """Each gain measure uses its own pairs, as if it were asked for alone."""
    asked = {"G": None, "ndcg": {1: 3, 2: 9}, "ndcg_rel": {2: 5}, "Rndcg": None}
    together = topic(evaluate(runs, qrels, asked))
    assert set(together) == {"G", "ndcg_1=3,2=9", "ndcg_rel_2=5", "Rndcg"}
    for name, pairs in asked.items():
        alone = topic(evaluate(runs, qrels, {name: pairs}))
        assert alone == {k: pytest.approx(v) for k, v in together.items() if k in alone} and len(alone) == 1
    dcg = 3 / math.log2(2) + 9 / math.log2(5)
    ideal = 9 / math.log2(2) + 3 / math.log2(3) + 3 / math.log2(4)
    assert together["ndcg_1=3,2=9"] == pytest.approx(dcg / ideal)


def test_zscores(spark, runs, qrels):
    zref = spark.createDataFrame([("1", "map", 0.25, 0.5), ("2", "map", 0.5, 0.0)],
                                 "qid string, measure string, mean double, stddev double")
    ev = evaluate(runs, qrels, ["map"], zref=zref)
    assert topic(ev)["map"] == pytest.approx((0.5 - 0.25) / 0.5) and topic(ev, "2")["map"] == 0
    moved = zref.replace(0.5, 0.75, subset=["mean"])
    assert topic(evaluate(runs, qrels, ["map"], zref=moved), "2")["map"] == -1000000.0


def test_groups(spark, runs):
    rows = [("1", "u", "a", 1), ("1", "u", "b", 0), ("1", "v", "b", 1), ("2", "u", "x", 1), ("3", "u", "k", 1), ("3", "v", "k", 1)]
    jg = spark.createDataFrame(rows, "qid string, jg string, docno string, rel int")
    ev = evaluate_jg(runs, jg, ["num_q", "map_avgjg"], EvalConfig(complete=True))
    assert topic(ev)["map_avgjg"] == pytest.approx((1 / 4 + 1) / 2)
    assert summary(ev) == {"num_q": 3, "map_avgjg": pytest.approx(((1 / 4 + 1) / 2 + 1 / 2) / 3)}


def test_preferences(spark, runs, qrels):
    prefs = qrels_to_prefs(qrels.where("qid = '1'").selectExpr("qid", "'0' AS jg", "docno", "rel"))
    got = topic(evaluate_prefs(runs, prefs, ["prefs_num_prefs_poss", "prefs_num_prefs_ful", "prefs_num_prefs_ful_ret", "prefs_simp"]))
    # preferred: a>b a>c a>d b>c d>c; ranked b c a, then d: b>c and a>d hold, a>b, a>c and d>c do not
    assert got == {"prefs_num_prefs_poss": 5, "prefs_num_prefs_ful": 2, "prefs_num_prefs_ful_ret": 1, "prefs_simp": pytest.approx(2 / 5)}


def test_report_lines(runs, qrels):
    lines = report(evaluate(runs, qrels, ["num_ret", "map"]))
    assert lines == ["num_ret               \t1\t4", "map                   \t1\t0.5000", "num_ret               \t2\t2",
                     "map                   \t2\t0.5000", "num_ret               \tall\t6", "map                   \tall\t0.5000"]


def test_everything_is_released(spark, runs, qrels):
    with owned() as frames:
        evaluate(runs, qrels, "official").summary().collect()
        assert frames and all(f.is_cached for f in frames)
    assert not any(f.is_cached for f in frames)


@pytest.mark.parametrize("skew_safe", [False, 2])
def test_repeated_documents_count_after_the_cut_and_in_matched_topics(spark, runs, qrels, skew_safe):
    """What the evaluation does not look at may repeat."""
    def with_(**options):
        return EvalConfig(skew_safe=skew_safe, **options)
    below = runs.union(spark.createDataFrame([("r", "1", "b", 1.0)], runs.schema))
    got = topic(evaluate(below, qrels, ["map", "num_ret"], with_(max_docs=3)))
    assert got == {"map": pytest.approx(1 / 3), "num_ret": 3}
    with pytest.raises(ValueError, match="duplicate document in results: b"):
        evaluate(below, qrels, ["map"], with_())
    with pytest.raises(ValueError, match="duplicate document in results: b"):
        evaluate(below, qrels, {"ndcg": {1: 2}, "map": None}, with_(judged_only=True))
    unjudged = runs.union(spark.createDataFrame([("r", "9", "b", 1.0), ("r", "9", "b", 2.0)], runs.schema))
    assert summary(evaluate(unjudged, qrels, ["num_q"], with_()))["num_q"] == 2
    no_run = qrels.union(spark.createDataFrame([("3", "k", 1)], qrels.schema))
    assert summary(evaluate(runs, no_run, ["num_q"], with_()))["num_q"] == 2
    twice = qrels.union(spark.createDataFrame([("2", "y", 1)], qrels.schema))
    with pytest.raises(ValueError, match="duplicate document in judgements: y"):
        evaluate(runs, twice, ["map"], with_())
    lax = summary(evaluate(below, qrels, ["num_ret"], with_(strict=False)))
    assert lax["num_ret"] == 7


def test_repeats_within_a_group_only(spark, runs):
    """A document judged by two groups of a topic is no repeat, twice by one is."""
    rows = [("1", "u", "a", 1), ("1", "v", "a", 1)]
    jg = spark.createDataFrame(rows, "qid string, jg string, docno string, rel int")
    assert topic(evaluate_jg(runs, jg, ["map_avgjg"]))["map_avgjg"] == pytest.approx(1 / 4)
    with pytest.raises(ValueError, match="judgements"):
        evaluate_jg(runs, jg.union(jg.limit(1)), ["map_avgjg"])
