"""Queries read the base tables once for each input they build from them."""
import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from judgeline.plans import catalog as C


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Own small orders of 2 topics, 60 parts, before and after the fixtures' date."""
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(1, 1), (2, 2)], "c_custkey long, c_nationkey long").write.parquet(f"{path}/customer.parquet")
    spark.createDataFrame([(i, 1 + i % 2, "1-URGENT") for i in range(40)],
                          "o_orderkey long, o_custkey long, o_orderpriority string").write.parquet(f"{path}/orders.parquet")
    rows = [(o, (o * 7 + k * 11) % 60, float(1 + (o * k) % 50), "ANR"[k % 3], dt.datetime(1996 + (o + k) % 3, 5, 1))
            for o in range(40) for k in range(12)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_quantity double, l_returnflag string, "
                                "l_shipdate timestamp").write.parquet(f"{path}/lineitem.parquet")
    return path


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_preference_inputs_are_read_once(spark, tables):
    runs, prefs = C._d_inputs(spark, tables)
    assert "FileScan" not in _plan(runs) and "FileScan" not in _plan(prefs)
    # one scan of the lines for both subgroups
    assert _plan(C.FX.fixture_d_prefs(spark, tables)).count("lineitem.parquet") == 1
    found = {(r.docno, r.jsg) for r in prefs.select("docno", "jsg").distinct().collect()}
    every = {int(d[1:]) for d, _ in found}
    assert found == {(f"M{m:02d}", s) for m in every for s in {0: "0", 1: "01", 2: "1"}[m % 3]}
    assert prefs.groupBy("qid", "jg", "jsg", "docno").count().where(F.col("count") > 1).isEmpty()


def test_kept_inputs(spark, tables):
    """The inputs that several steps read are persisted while a query is built."""
    from judgeline.session import owned
    for query, n in ((C.q_repeats_outside, 2), (C.q_number_fields, 1), (C.q_judged_jg, 1)):
        with owned() as frames:
            query(spark, tables).count()
            once = [f for f in frames if f._jdf.queryExecution().analyzed().toString().count("Relation [l_orderkey") == 1]
            assert len(once) == n, query.__name__


@pytest.fixture(scope="module")
def graded(spark):
    """Two runs over three topics, one without positive judgements; many levels, ties."""
    judged = [(q, f"d{i:03d}", (i * 7 + q) % 9 - 1) for q in (1, 2) for i in range(90)] + [(3, f"d{i:03d}", 0) for i in range(5)]
    found = [(r, q, f"d{(i * 11 + q) % 120:03d}", float(i * 5 % 13)) for r in "xy" for q in (1, 2, 3) for i in range(60 + 55 * (r == "y"))]
    runs = spark.createDataFrame([(r, str(q), d, s) for r, q, d, s in found], "run_id string, qid string, docno string, sim float")
    return runs, spark.createDataFrame([(str(q), d, rel) for q, d, rel in judged], "qid string, docno string, rel int")


GAINED = {"G": None, "ndcg": {1: 3, 2: 9}, "ndcg_rel": {1: 0.5, 2: 4, 6: 0}, "Rndcg": None}


def test_levels_of_the_ideal_ranking(spark, graded, monkeypatch):
    """One row per gain says what the ideal ranking says position by position."""
    from judgeline.operators import ideal as I
    monkeypatch.setattr(I, "STRETCH", 4)
    for gains in (None, {1: 0.5, 2: 4, 6: 0}):
        levels = {(r.qid, r.last): r for r in I.ideal_levels(graded[1], gains).collect()}
        ends = {(r.qid, r.pos): r for r in I.ideal_ranking(graded[1], gains).where("bnd").collect()}
        assert levels.keys() == ends.keys()
        for k, e in ends.items():
            v = levels[k]
            assert (v.ig, v.cnt_more) == (e.ig, e.cnt_after)
            assert (v.icum_last, v.inv_more) == pytest.approx((e.icum, e.inv_after))


def test_gains_are_aligned_on_one_exchange(spark, graded):
    """sets of gains take no exchange of the ranking of their own."""
    from judgeline.config import EvalConfig
    from judgeline.plans.evaluate import evaluate
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = _plan(evaluate(*graded, GAINED, EvalConfig(strict=False)).per_topic_all)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(re.findall(r"Exchange hashpartitioning\(run_id#\w+, qid#\w+, \d+\)", plan)) == 1


def test_gains_by_prefix_scan(spark, graded, monkeypatch):
    """rankings are cut into chunks once, and give what windows give."""
    from judgeline.config import EvalConfig
    from judgeline.plans.evaluate import evaluate
    values = lambda **c: {(r.run_id, r.qid, r.measure): r.value
                          for r in evaluate(*graded, GAINED, EvalConfig(**c)).per_topic.collect()}
    ranges, own = [], type(graded[0]).repartitionByRange
    monkeypatch.setattr(type(graded[0]), "repartitionByRange", lambda df, *a: ranges.append(1) or own(df, *a))
    assert values(skew_safe=7) == pytest.approx(values())
    assert len(ranges) == 1
