"""API surfaces: report files, measure registration, run files."""
import glob

from conftest import SF
from judgeline.operators import measures as M
from judgeline.plans import fixtures as FX
from judgeline.plans.evaluate import evaluate
from judgeline.sources.sinks import write_report


def test_write_report_one_folder_per_run(spark, tmp_path):
    runs, qrels = FX.fixture_b_runs(spark, SF), FX.fixture_b_qrels(spark, SF)
    ev = evaluate(runs, qrels, "official")
    out = str(tmp_path / "rep")
    write_report(ev, out)
    for run in ("sumqty", "hash97"):
        files = sorted(glob.glob(f"{out}/run_id={run}/part-*"))
        lines = [x for f in files for x in open(f).read().splitlines()]
        assert lines[-len(lines):] and any(x.startswith("map ") for x in lines)
        summary = [x for x in lines if "\tall\t" in x]
        assert summary[0].startswith("runid") and summary[0].endswith(run)
        assert summary[1].startswith("num_q")


def test_register_measure(spark):
    def b_unjudged(ctx, params):
        a = ctx.agg("_unj_cnt", "sum(CASE WHEN unj THEN 1L ELSE 0L END)")
        return [M.Out("num_unjudged_ret", f"CAST({a} AS DOUBLE)", "sum", ())]

    M.register_measure("num_unjudged_ret", b_unjudged, after="num_nonrel_judged_ret")
    runs, qrels = FX.fixture_b_runs(spark, SF), FX.fixture_b_qrels(spark, SF)
    ev = evaluate(runs, qrels, ["num_unjudged_ret", "num_ret"])
    got = {(r.run_id, r.measure): r.value for r in ev.summary_values().collect()}
    expect = runs.join(qrels.where("rel < 0"), ["qid", "docno"]).groupBy("run_id").count().collect()
    for r in expect:
        assert got[(r.run_id, "num_unjudged_ret")] == r["count"]
