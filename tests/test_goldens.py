"""The evaluator's own golden reports, reproduced line for line (read-only
inputs from the reference's test folder)."""
import os

import pytest

from conftest import REF, golden, report
from judgeline.config import EvalConfig
from judgeline.operators.groups import evaluate_jg
from judgeline.operators.prefs import evaluate_prefs
from judgeline.plans.evaluate import evaluate
from judgeline.sources import text_formats as T


# inputs from outside; test_cases.py holds the same options to values worked out by hand
pytestmark = pytest.mark.skipif(not os.path.exists(REF + "out.test"), reason="the golden reports are not at hand")


@pytest.fixture(scope="module")
def inputs(spark):
    return {
        "runs": T.read_run(spark, REF + "results.test"),
        "trunc": T.read_run(spark, REF + "results.trunc"),
        "qrels": T.read_qrels(spark, REF + "qrels.test"),
    }


def test_official(inputs):
    assert report(evaluate(inputs["runs"], inputs["qrels"], "official"), per_topic=False) == golden("out.test")


def test_all_trec_summary(inputs):
    assert report(evaluate(inputs["runs"], inputs["qrels"], "all_trec"), per_topic=False) == golden("out.test.a")


def test_all_trec_per_topic(inputs):
    assert report(evaluate(inputs["runs"], inputs["qrels"], "all_trec")) == golden("out.test.aq")


def test_complete(inputs):
    ev = evaluate(inputs["trunc"], inputs["qrels"], "all_trec", EvalConfig(complete=True))
    assert report(ev) == golden("out.test.aqc")


def test_complete_cut(inputs):
    ev = evaluate(inputs["trunc"], inputs["qrels"], "all_trec", EvalConfig(complete=True, max_docs=100))
    assert report(ev) == golden("out.test.aqcM")


def test_levels_and_relstring(spark, inputs):
    rl = T.read_qrels(spark, REF + "qrels.rel_level")
    ev = evaluate(inputs["runs"], rl, {"all_trec": None, "relstring": [20]}, EvalConfig(level=2))
    assert report(ev) == golden("out.test.aql")


def test_zscores(spark, inputs):
    z = T.read_zref(spark, REF + "zscores_file")
    assert report(evaluate(inputs["runs"], inputs["qrels"], "all_trec", zref=z)) == golden("out.test.aqZ")


def test_parameters(inputs):
    mp = {"iprec_at_recall": [.10, .20, .25, .75, .50], "P": [5, 7, 3], "recall": [20, 2000],
          "Rprec_mult": [5.0, 0.2, 0.35], "utility": [2, -1, 0, 0], "11pt_avg": [.25, .5, .75],
          "ndcg": {1: 3, 2: 9, 4: 4.5}, "ndcg_cut": [10, 20, 23], "success": [2, 5, 20]}
    got = report(evaluate(inputs["runs"], inputs["qrels"], mp))
    exp = golden("out.test.meas_params")
    # parameter strings are printed as given on the command line there
    norm = lambda s: s.replace("11pt_avg_.25,.5,.75   ", "11pt_avg_0.25,0.5,0.75")
    assert sorted(norm(x) for x in exp) == sorted(got)


def test_qrels_jg(spark, inputs):
    qj = T.read_qrels_jg(spark, REF + "qrels.123")
    assert report(evaluate_jg(inputs["runs"], qj, "qrels_jg")) == golden("out.test.qrels_jg")


def test_prefs(spark):
    pr = T.read_prefs(spark, REF + "prefs.test")
    runs = T.read_run(spark, REF + "prefs.results.test")
    assert report(evaluate_prefs(runs, pr, "all_prefs")) == golden("out.test.prefs")


def test_qrels_as_prefs(spark, inputs):
    qp = T.read_qrels_as_prefs(spark, REF + "qrels.test")
    assert report(evaluate_prefs(inputs["runs"], qp, "all_prefs")) == golden("out.test.qrels_prefs")
