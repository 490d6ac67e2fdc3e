"""Retrieval: tokenising, topics, models and top-k (fixture A, sf0.001)."""
import math

import pytest
from pyspark.sql import functions as F

from conftest import SF
from judgeline.functions.text import STOP_WORDS, tokenize
from judgeline.plans import fixtures as FX
from judgeline.functions.membership import membership
from judgeline.functions.text import query_text
from judgeline.operators import scoring as SC
from judgeline.operators import termstats as TS
from judgeline.plans.retrieve import column_names, compare_narrow, compare_runs, query_table, retrieve, scored, search
from judgeline.sources.text_formats import read_topics


def test_tokenize_drops_stop_words(spark):
    df = spark.createDataFrame([("The Airbus and a U.S. plane-maker, 2024!",)], "text string")
    toks = df.select(tokenize(F.col("text")).alias("t")).first().t
    assert toks == ["airbus", "u", "s", "plane", "maker", "2024"]
    assert len(STOP_WORDS) == 33


TOPICS = """<top>
<num> Number:  007
<dom> Domain: Transport
<title> Topic:  Night Ferries
<desc> Description:
Boats that sail
at night.
<smry> Summary:
None.
</top>

<top>
<num> Number: 12
<dom> Domain: x
<title> Topic: Bridges
<desc> Description: Long ones.
<smry> Summary: y
</top>
"""


def test_read_topics(spark, tmp_path):
    path = tmp_path / "topics.txt"
    path.write_text(TOPICS)
    rows = {r.qid: r for r in read_topics(spark, str(path)).collect()}
    assert set(rows) == {"07", "12"}          # one leading zero goes
    assert rows["07"].title.strip() == "Night Ferries"
    assert rows["07"].description.strip() == "Description:\nBoats that sail\nat night."
    assert rows["12"].description.strip() == "Description: Long ones."


def test_topk_and_tags(spark):
    docs, topics = FX.fixture_a_docs(spark, SF), FX.fixture_a_topics(spark, SF)
    r = retrieve(docs, topics, k=5)
    tags = {x.run_id for x in r.select("run_id").distinct().collect()}
    assert tags == {f"{m}_{k}" for m in ("DEFAULT", "Default", "BM25", "LMDirichlet", "LMJelinekMercer")
                    for k in ("SHORT", "LONG")}
    assert r.groupBy("run_id", "qid").count().where("count > 5").count() == 0


def test_bm25_by_hand(spark):
    docs = spark.createDataFrame([("d1", "apple apple pear"), ("d2", "pear plum"), ("d3", "kiwi")],
                                 "docno string, text string")
    topics = spark.createDataFrame([("1", "apple pear", "apple pear")],
                                   "qid string, title string, description string")
    s, post, qt, ts, stats = scored(docs, topics, ["bm25", "tfidf"], ("short",))
    got = {r.docno: (r.bm25, r.tfidf) for r in s.collect()}
    n, avgdl = 3, 6 / 3

    def bm(tf, dl, df):
        idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
        return idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))
    assert got["d1"][0] == pytest.approx(bm(2, 3, 1) + bm(1, 3, 2))
    assert got["d2"][0] == pytest.approx(bm(1, 2, 2))
    assert got["d1"][1] == pytest.approx(2 / 3 * math.log10(1 + 3 / 1) + 1 / 3 * math.log10(1 + 3 / 2))
    assert "d3" not in got


def test_search_returns_what_matches(spark):
    docs = FX.fixture_a_docs(spark, SF)
    r = search(spark, docs, "zzzzqqq nothingmatches", k=1000)
    assert r.count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_token_is_exchanged(spark):
    """The vocabulary is tested and terms are counted where the text is read."""
    docs, topics = FX.fixture_a_docs(spark, SF), FX.fixture_a_topics(spark, SF)
    vocab = query_table(topics).select("term").cache()
    exact = TS.postings(docs, vocab)
    plan = plan_of(exact)
    assert "Exchange" not in plan and plan.count("regexp_extract_all") == 1
    bloom = TS.postings(docs, vocab, set_members=0)
    assert "Exchange" not in plan_of(bloom).split("FileScan")[0].split("BroadcastExchange")[0]
    assert exact.exceptAll(bloom).count() == 0 and bloom.exceptAll(exact).count() == 0
    assert 0 < exact.count() < TS.postings(docs).count()


def test_terms_of_documents(spark):
    docs = spark.createDataFrame([("d1", "b a b, B c"), ("d2", ""), ("d3", None), ("d4", "the of"), ("d5", "z " * 5000 + "a")],
                                 "docno string, text string")
    got = {(r.docno, r.dl, r.term, r.tf) for r in TS.postings(docs).collect()}
    assert got == {("d1", 4, "b", 3), ("d1", 4, "c", 1), ("d5", 5000, "z", 5000)}          # `a` is a stop word
    every = {(r.docno, r.dl, r.term, r.tf) for r in TS.postings(docs, stop_words=None).collect()}
    assert every == {("d1", 5, "a", 1), ("d1", 5, "b", 3), ("d1", 5, "c", 1), ("d4", 2, "of", 1), ("d4", 2, "the", 1),
                     ("d5", 5001, "a", 1), ("d5", 5001, "z", 5000)}
    none = spark.createDataFrame([], "term string")
    post, stats = TS.index_for(docs.where("docno <> 'd3'"), none)
    assert post.count() == 0 and (stats.num_docs, stats.total_tokens) == (4, 5004)


def test_membership(spark):
    members = spark.createDataFrame([(f"w{i}",) for i in range(3000)] + [(None,), ("w1",)], "term string").cache()
    probe = spark.range(20_000).select(F.concat(F.lit("w"), "id").alias("t"))
    exact = membership(members, "term")
    assert exact.exact and probe.where(exact.test(F.col("t"))).count() == 3000
    bloom = membership(members, "term", set_members=100)
    passed = {r.t for r in probe.where(bloom.test(F.col("t"))).collect()}
    assert not bloom.exact and {f"w{i}" for i in range(3000)} <= passed and len(passed) < 3000 + 17_000 * 0.02


def test_description_label(spark):
    t = spark.createDataFrame([("1", "x", " Description:\nboats"), ("2", "y", "Description of a Description: z")],
                              "qid string, title string, description string")
    terms = lambda keep: {(r.qid, r.term) for r in TS.query_terms(t, "long", keep_description_label=keep).collect()}
    assert terms(True) - terms(False) == {("1", "description")}


def test_comparison_columns(spark):
    rows = [("map", r, v) for r, v in (("Default", 0.5), ("DEFAULT", 0.25), ("x", 1.0))]
    s = spark.createDataFrame(rows, "measure string, run_id string, value double")
    wide = compare_runs(s).first().asDict()
    assert wide == {"measure": "map", "DEFAULT": 0.25, "Default_2": 0.5, "x": 1.0}
    assert column_names(["a", "A", "a_2"]) == ["a", "A_2", "a_2_2"]
    assert compare_runs(s, runs=["x", "missing"]).first().asDict() == {"measure": "map", "x": 1.0, "missing": None}
    assert {(r.run_id, r.value) for r in compare_narrow(s, ["map"]).collect()} == {(r, v) for _, r, v in rows}


def test_bounds_keep_the_best(spark):
    """Rows under the bounds are none of the k best, ties and topics without a bound included."""
    rows = [("r", q, f"d{i:04d}", None if i == 5 else float(i * 37 % m)) for q, n, m in
            (("many", 2000, 401), ("ties", 2000, 3), ("few", 20, 7)) for i in range(n)]
    runs = spark.createDataFrame(rows + [("r", None, "d1", 1.0)], "run_id string, qid string, docno string, score double")
    kept = SC.above_bounds(runs, 10, round_digits=1)
    left = {r["qid"]: r["count"] for r in kept.groupBy("qid").count().collect()}
    assert left["many"] < 500 and left["few"] == 20 and left[None] == 1
    best = lambda df: sorted(map(str, SC.top_k(df, 10, round_digits=1).collect()))
    assert best(kept) == best(runs)


def test_sums_per_document_exchange_no_scores(spark):
    """The index is dealt by document, so scores and running sums need no exchange of their own."""
    docs = spark.createDataFrame([(f"d{i}", "red fox and blue fox") for i in range(9)], "docno string, text string")
    topics = spark.createDataFrame([("1", "red fox", "blue fox")], "qid string, title string, description string")
    post, stats = TS.index_for(docs, query_table(topics).select("term"))
    qt = query_table(topics)
    x = SC.explain_terms(post, qt, TS.term_stats(post), stats, keys=("kind", "qid"))
    plan = x._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(kind" not in plan.split("InMemoryRelation")[0]
    assert x.count() == 36
