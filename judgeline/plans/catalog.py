"""Registered queries: one per operator or measure family of the inventory.

Each entry takes (spark, sf_dir) and returns a DataFrame computed over the
whole test tables (through the fixtures in plans/fixtures.py).  Doubles are
rounded to 6 decimals so an independent SQL engine can be compared.
"""
from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import EvalConfig
from ..operators import ideal as I
from ..operators import judged as J
from ..plans import fixtures as FX
from ..plans.evaluate import evaluate
from ..operators import groups as G
from ..operators import prefs as P
from ..operators.groups import evaluate_jg
from ..functions.membership import SET_MEMBERS
from ..functions.text import query_text, tokenize
from ..operators import scoring as SC
from ..operators import termstats as TS
from ..plans.retrieve import compare_narrow, compare_runs, explain_kinds, query_table, retrieve, scored, search
from ..session import cut_lineage, ensure_checkpoint_dir, keep, owned
from ..sources.sinks import report_lines, write_run
from ..sources.text_formats import (malformed_lines, read_lines, read_prefs, read_qrels, read_qrels_as_prefs, read_qrels_jg,
                                    read_run, read_topics, read_zref)

ROUND = 6
HOT = 50     # rankings of more rows are split by the prefix scan queries, the others are not


def _r(c: str):
    return F.round(F.col(c).cast("double"), ROUND).alias(c)


def _b(spark: SparkSession, sf: str):
    return FX.fixture_b_runs(spark, sf), FX.fixture_b_qrels(spark, sf)


# ------------------------------------------------------------ J operators
def q_rank_run(spark, sf, max_docs=None, tie="desc"):
    runs, _ = _b(spark, sf)
    return J.rank_run(runs, tie=tie, max_docs=max_docs).select(
        "run_id", "qid", "docno", F.col("rank").cast("long"))


def q_judged_join(spark, sf, level=1, judged_only=False, max_docs=None, skew_safe=False):
    runs, qrels = _b(spark, sf)
    cfg = EvalConfig(level=level, judged_only=judged_only, max_docs=max_docs, skew_safe=skew_safe)
    j = J.judged_rows(runs, qrels, cfg)
    return j.where("keep").select("run_id", "qid", "docno", F.col("code").cast("long"),
                                  "rank", "cr", "cn", "cu")


def q_topic_stats(spark, sf):
    _, qrels = _b(spark, sf)
    return J.topic_stats(qrels, 1).withColumn("num_levels", F.col("num_levels").cast("long"))


def q_topic_match(spark, sf):
    runs, qrels = _b(spark, sf)
    return J.evaluated_topics(runs, J.topic_stats(qrels, 1), EvalConfig())


def q_ideal_ranking(spark, sf):
    _, qrels = _b(spark, sf)
    return I.ideal_ranking(qrels, None).select("qid", F.col("pos").cast("long"), "ig", _r("icum"))


def q_duplicates(spark, sf):
    """J4/J5 over inputs with seeded faults: documents ending in 7 come twice."""
    runs, qrels = _b(spark, sf)
    runs = runs.unionByName(runs.where(F.col("docno").endswith("7")))
    qrels = qrels.unionByName(qrels.where(F.col("docno").endswith("7")))
    return J.duplicate_docs(runs, ["run_id", "qid"]).unionByName(
        J.duplicate_docs(qrels.withColumn("run_id", F.lit("qrels")), ["run_id", "qid"]))


def q_repeats_outside(spark, sf):
    """J4/J5 scope: documents repeated below the cut, in a topic without judgements
    and in the judgements of a topic without a run do not stop an evaluation."""
    runs, qrels = (keep(df) for df in _b(spark, sf))
    below = J.rank_run(runs).where("rank > 50").drop("rank").withColumn("sim", F.lit(-1000.0).cast("float"))
    unjudged = runs.withColumn("qid", F.lit("no judgements"))
    no_run = qrels.withColumn("qid", F.lit("no run"))
    runs = runs.unionByName(below).unionByName(unjudged).unionByName(unjudged)
    ev = evaluate(runs, qrels.unionByName(no_run).unionByName(no_run), ["map", "num_ret", "recall"], EvalConfig(max_docs=50))
    return ev.per_topic.select("run_id", "qid", "measure", _r("value"))


# ------------------------------------------------------------ measures
def q_measures(spark, sf, measures, cfg: EvalConfig | None = None, only=None) -> DataFrame:
    runs, qrels = _b(spark, sf)
    ev = evaluate(runs, qrels, measures, cfg or EvalConfig())
    pt = ev.per_topic
    if only is not None:
        pt = pt.where(F.col("measure").isin(list(only)))
    return pt.select("run_id", "qid", "measure", _r("value"))


#: A5: parameters other than the defaults.
OWN_PARAMETERS = {"P": [3, 7], "recall": [3], "relative_P": [4], "success": [2], "map_cut": [4, 60],
                  "Rprec_mult": [0.3, 2.5], "iprec_at_recall": [0.15, 0.35], "11pt_avg": [0.25, 0.5, 0.75],
                  "utility": [2, -1, 0.5, 0], "set_F": [0.5], "ndcg_cut": [3, 40]}


def q_runid(spark, sf):
    """M1: the report line that names a run."""
    runs, qrels = _b(spark, sf)
    ev = evaluate(runs, qrels, ["runid", "num_q"])
    return report_lines(ev, per_topic=False).where(F.col("line").startswith("runid")).select("run_id", "line")


def q_no_overlap(spark, sf):
    """With every topic renamed no topic has both results and judgements, so the
    summary raises; with one topic in ten kept it does not.  Rows: topics that
    have both, and whether it raised."""
    runs, qrels = _b(spark, sf)
    out = []
    for case, kept in (("none", F.lit(False)), ("some", F.col("qid").endswith("-1"))):
        renamed = runs.withColumn("qid", F.when(kept, F.col("qid")).otherwise(F.concat(F.lit("x"), "qid")))
        ev = evaluate(renamed, qrels, ["num_q"])
        try:
            ev.summary()
            raised = False
        except ValueError:
            raised = True
        out.append(ev.num_q.agg(F.coalesce(F.max("n"), F.lit(0)).cast("long").alias("topics"))
                   .select(F.lit(case).alias("topics_kept"), "topics", F.lit(raised).alias("raised")))
    return out[0].unionByName(out[1])


def q_geo(spark, sf, name):
    runs, qrels = _b(spark, sf)
    ev = evaluate(runs, qrels, [name])
    return ev.summary_values().select("run_id", "measure", _r("value"))


def q_relstring(spark, sf, n=10):
    runs, qrels = _b(spark, sf)
    ev = evaluate(runs, qrels, {"relstring": [n]})
    return ev.strings.select("run_id", "qid", "measure", F.col("text").alias("value"))


def q_summary(spark, sf, measures, cfg: EvalConfig | None = None):
    runs, qrels = _b(spark, sf)
    ev = evaluate(runs, qrels, measures, cfg or EvalConfig())
    return ev.summary_values().select("run_id", "measure", _r("value"))


def q_complete(spark, sf):
    """Runs without the topics ending in -1, averaged over every
    judged topic (-c): missing topics count 0 (ln 1e-5 for gm_map)."""
    runs, qrels = _b(spark, sf)
    runs = runs.where(~F.col("qid").endswith("-1"))
    ev = evaluate(runs, qrels, ["num_q", "map", "num_ret", "gm_map", "P"],
                  EvalConfig(complete=True))
    return ev.summary_values().select("run_id", "measure", _r("value"))


def q_zscore(spark, sf):
    """A4: per-topic z-scores of three measures against a reference built
    from the same runs (fixture E)."""
    runs, qrels = _b(spark, sf)
    ms = ["num_ret", "num_rel_ret", "map"]
    base = evaluate(runs, qrels, ms).per_topic
    zref = FX.fixture_e_zref(base)
    ev = evaluate(runs, qrels, ms, zref=zref)
    return ev.per_topic.select("run_id", "qid", "measure", _r("value"))


def _m(measures, only=None, **cfg):
    return partial(q_measures, measures=measures, cfg=EvalConfig(**cfg) if cfg else None, only=only)


def eval_queries() -> dict:
    return {
        "J1_rank_run": q_rank_run,
        "J2_rank_run_tie_asc": partial(q_rank_run, tie="asc"),
        "J3_max_docs": partial(q_rank_run, max_docs=50),
        "J4_J5_duplicates": q_duplicates,
        "J4_J5_scope": q_repeats_outside,
        "A5_gain_parameters": _m({"G": None, "ndcg": {1: 3, 2: 9}, "ndcg_rel": {1: 1, 2: 4}, "Rndcg": {2: 1}}),
        "A5_own_parameters": _m(OWN_PARAMETERS),
        "M1_runid": q_runid,
        "S12_no_overlap": q_no_overlap,
        "J6_judged_join": q_judged_join,
        "J8_judged_only": partial(q_judged_join, judged_only=True),
        "J9_level": partial(q_judged_join, level=2),
        "J15_running_counts_prefix_scan": partial(q_judged_join, skew_safe=HOT),
        "J15_measures_prefix_scan": _m(["map", "bpref", "infAP", "P"], skew_safe=HOT),
        "J15_ndcg_rel_prefix_scan": _m(["ndcg_rel"], skew_safe=HOT),
        "J10_topic_stats": q_topic_stats,
        "J12_topic_match": q_topic_match,
        "J16_ideal_ranking": q_ideal_ranking,
        "M3_M5_counts": _m(["num_ret", "num_rel", "num_rel_ret"]),
        "M6_map": _m(["map"]),
        "M7_gm_map": partial(q_geo, name="gm_map"),
        "M8_Rprec": _m(["Rprec"]),
        "M9_bpref": _m(["bpref"]),
        "M10_recip_rank": _m(["recip_rank"]),
        "M11_iprec_at_recall": _m(["iprec_at_recall"]),
        "M12_P": _m(["P"]),
        "M13_relstring": q_relstring,
        "M14_recall": _m(["recall"]),
        "M15_infAP": _m(["infAP"]),
        "M16_gm_bpref": partial(q_geo, name="gm_bpref"),
        "M17_Rprec_mult": _m(["Rprec_mult"]),
        "M18_utility": _m(["utility"]),
        "M19_11pt_avg": _m(["11pt_avg"]),
        "M20_binG": _m(["binG"]),
        "M21_G": _m(["G"]),
        "M22_ndcg": _m(["ndcg"]),
        "M23_ndcg_rel": _m(["ndcg_rel"]),
        "M24_Rndcg": _m(["Rndcg"]),
        "M25_ndcg_cut": _m(["ndcg_cut"]),
        "M26_map_cut": _m(["map_cut"]),
        "M27_relative_P": _m(["relative_P"]),
        "M28_success": _m(["success"]),
        "M29_M33_set": _m(["set_P", "set_relative_P", "set_recall", "set_map", "set_F"]),
        "M34_num_nonrel_judged_ret": _m(["num_nonrel_judged_ret"]),
        "J8_measures_judged_only": _m(["map", "P", "bpref", "num_ret"], judged_only=True),
        "J9_measures_level2": _m(["map", "Rprec", "recip_rank", "num_rel_ret"], level=2),
        "J3_measures_max_docs": _m(["map", "num_ret", "recall"], max_docs=20),
        "J14_topic_filter": _m(["map", "P"], topic="3-1"),
        "A1_A2_summary": partial(q_summary, measures="official"),
        "J13_complete": q_complete,
        "A4_zscore": q_zscore,
    }


# ------------------------------------------------------------ retrieval
def _a(spark, sf):
    return FX.fixture_a_docs(spark, sf), FX.fixture_a_topics(spark, sf)


def q_tokenize(spark, sf):
    docs, _ = _a(spark, sf)
    t = tokenize(F.col("text"))
    return docs.select("docno", F.array_join(t, " ").alias("tokens"), F.size(t).cast("long").alias("dl"))


def q_query_terms(spark, sf):
    _, topics = _a(spark, sf)
    return query_table(topics).select("kind", "qid", "term", "qtf", F.col("first_pos").cast("long"))


def q_collection_stats(spark, sf):
    docs, _ = _a(spark, sf)
    return TS.doc_lengths(docs).agg(F.count(F.lit(1)).alias("num_docs"),
                                    F.sum("dl").cast("long").alias("total_tokens"),
                                    F.round(F.avg("dl"), ROUND).alias("avgdl"))


def q_postings(spark, sf, set_members=SET_MEMBERS):
    docs, topics = _a(spark, sf)
    vocab = query_table(topics).select("term")
    return TS.postings(docs, vocab, set_members=set_members).select("docno", F.col("dl").cast("long"), "term", "tf")


def q_doc_freq(spark, sf):
    docs, topics = _a(spark, sf)
    vocab = query_table(topics).select("term")
    return TS.term_stats(TS.postings(docs, vocab)).select("term", "df", F.col("ttf").cast("long"))


def q_doc_length(spark, sf):
    docs, _ = _a(spark, sf)
    return TS.doc_lengths(docs).select("docno", F.col("dl").cast("long"))


def q_model(spark, sf, model):
    docs, topics = _a(spark, sf)
    s, *_ = scored(docs, topics, [model])
    return s.select("kind", "qid", "docno", F.round(model, ROUND).alias("score"))


def q_top_k(spark, sf, models=("bm25",), k=10, zero_based=False):
    docs, topics = _a(spark, sf)
    r = retrieve(docs, topics, list(models), k=k, round_digits=ROUND, zero_based=zero_based)
    return r.select("run_id", "qid", "docno", F.col("rank").cast("long"), _r("score"))


def q_explain(spark, sf):
    """Both query kinds, every topic, every matching document."""
    docs, topics = _a(spark, sf)
    return explain_kinds(docs, topics).select(
        "kind", "qid", "docno", "term", _r("contribution"), _r("running"))


def q_fixture_a_qrels(spark, sf):
    return FX.fixture_a_qrels(spark, sf)


def q_compare(spark, sf, wide=True):
    """Retrieve (all models, both kinds, top 1000) -> evaluate against
    passage-containment judgements -> one column (or one row a measure) per run."""
    docs, topics = _a(spark, sf)
    runs = retrieve(docs, topics, k=SC.TOP_K, round_digits=ROUND) \
        .select("run_id", "qid", "docno", F.round("score", ROUND).cast("float").alias("sim"))
    qrels = FX.fixture_a_qrels(spark, sf)
    ev = evaluate(runs, qrels, ["num_ret", "num_rel_ret", "map", "P", "recip_rank"])
    s = ev.summary_values().withColumn("value", F.round("value", ROUND))
    return (compare_runs if wide else compare_narrow)(s, ["num_ret", "num_rel_ret", "map", "P_10", "recip_rank"])


def retrieval_queries() -> dict:
    return {
        "T3_tokenize": q_tokenize,
        "T5_query_terms": q_query_terms,
        "T6_T10_collection_stats": q_collection_stats,
        "T7_doc_freq": q_doc_freq,
        "T8_doc_length": q_doc_length,
        "T9_postings": q_postings,
        "T9_postings_bloom": partial(q_postings, set_members=0),
        "T11_score_tfidf": partial(q_model, model="tfidf"),
        "T12_score_classic": partial(q_model, model="classic"),
        "T13_score_bm25": partial(q_model, model="bm25"),
        "T14_score_lm_dirichlet": partial(q_model, model="lm_dirichlet"),
        "T15_score_lm_jm": partial(q_model, model="lm_jm"),
        "T16_top_k": q_top_k,
        "T17_rank_zero_based": partial(q_top_k, models=("classic",), zero_based=True),
        "T18_retrieve_grid": partial(q_top_k, models=tuple(SC.MODELS), k=SC.TOP_K),
        "T19_explain_scores": q_explain,
        "T20_search": q_search,
        "T21_compare_runs": q_compare,
        "T21_compare_narrow": partial(q_compare, wide=False),
        "FA_passage_qrels": q_fixture_a_qrels,
    }


# ------------------------------------------------------------ sources / sinks
def _scratch(spark, name):
    import uuid
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/io-{name}-{uuid.uuid4().hex}"


def q_run_roundtrip(spark, sf):
    """S9 -> S2: fixture-B runs written as run files, read back."""
    runs, _ = _b(spark, sf)
    path = _scratch(spark, "runs")
    ranked = J.rank_run(runs)
    write_run(ranked.withColumnRenamed("sim", "score"), path)
    return read_run(spark, path).select("run_id", "qid", "docno", F.col("sim").cast("double"))


def q_run_lines(spark, sf):
    """The lines of the written run files with their numbers over a run's part
    files, in name order."""
    runs, _ = _b(spark, sf)
    path = _scratch(spark, "runlines")
    write_run(J.rank_run(runs).withColumnRenamed("sim", "score"), path, parts=5)
    part = F.regexp_extract("file", r"run_id=([^/]*)/(part-[0-9]+)", 2)
    lines = read_lines(spark, path).select(F.regexp_extract("file", r"run_id=([^/]*)/", 1).alias("run_id"),
                                           part.alias("part"), "line_no", "line")
    before = Window.partitionBy("run_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = lines.groupBy("run_id", "part").count().select(
        "run_id", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    return lines.join(parts, ["run_id", "part"]).select("run_id", (F.col("before") + F.col("line_no")).alias("n"), "line")


#: Ends of number fields by document: what each leaves of the number is the evaluator's rule.
ENDINGS = ["", "x", "e2", ".9", "e+", "-1", " "]


def _odd_field(c, kind):
    """A number followed by one of ENDINGS, or words, or a sign, by document."""
    k = F.pmod(F.crc32("docno"), F.lit(9))
    text = c.cast("string")
    out = F.concat(text, F.element_at(F.array(*[F.lit(e) for e in ENDINGS]), (F.least(k, F.lit(6)) + 1).cast("int")))
    return F.when(k == 7, F.lit("abc")).when(k == 8, F.concat(F.lit("+"), F.abs(c).cast("string"))).otherwise(F.trim(out))


def q_number_fields(spark, sf):
    """Number fields that end or begin with something else, in judgements
    (whole numbers), results, preferences and z-scores (decimal numbers)."""
    runs, qrels = _b(spark, sf)
    path = _scratch(spark, "numbers")
    out = []
    rel = qrels.withColumns({"it": F.lit("0"), "x": _odd_field(F.col("rel"), "int")})
    _write_lines(rel, ["qid", "it", "docno", "x"], path + "/qrels")
    out.append(read_qrels(spark, path + "/qrels").select(F.lit("qrels").alias("kind"), "qid", "docno", F.col("rel").cast("double").alias("v")))
    own = keep(runs.where("run_id = 'sumqty'")).withColumn("x", _odd_field(F.col("sim").cast("int"), "float"))
    _write_lines(own.withColumns({"it": F.lit("Q0"), "rank": F.lit(1)}), ["qid", "it", "docno", "rank", "x", "run_id"], path + "/runs")
    out.append(read_run(spark, path + "/runs").select(F.lit("run").alias("kind"), "qid", "docno", F.col("sim").cast("double").alias("v")))
    _write_lines(own.withColumns({"jg": F.lit("a"), "jsg": F.lit("s")}), ["qid", "jg", "jsg", "docno", "x"], path + "/prefs")
    out.append(read_prefs(spark, path + "/prefs").select(F.lit("prefs").alias("kind"), "qid", "docno", F.col("rel_level").cast("double").alias("v")))
    _write_lines(own, ["qid", "docno", "x", "x"], path + "/zref")
    out.append(read_zref(spark, path + "/zref").select(F.lit("zref").alias("kind"), "qid", F.col("measure").alias("docno"), F.col("mean").alias("v")))
    every = out[0]
    for more in out[1:]:
        every = every.unionByName(more)
    return every


def q_malformed_lines(spark, sf):
    """One judgement file per topic in document order with seeded faults: a
    field less (documents ending in 7), a field more (3), a blank line (1)."""
    _, qrels = _b(spark, sf)
    path = _scratch(spark, "malformed")
    good = F.concat_ws(" ", "qid", F.lit("0"), "docno", F.col("rel").cast("string"))
    line = (F.when(F.col("docno").endswith("7"), F.concat_ws(" ", "qid", F.lit("0"), "docno"))
            .when(F.col("docno").endswith("3"), F.concat(good, F.lit(" more")))
            .when(F.col("docno").endswith("1"), F.lit("")).otherwise(good))
    qrels.select(F.col("qid").alias("topic"), "docno", line.alias("value")).repartition("topic") \
        .sortWithinPartitions("topic", "docno").select("topic", "value").write.partitionBy("topic").text(path)
    return malformed_lines(spark, path, 4).select(
        F.regexp_extract("file", "topic=([^/]*)/", 1).alias("topic"), "line_no", "line", F.col("n_fields").cast("long").alias("n_fields"))


def _write_lines(df, cols, path):
    df.select(F.concat_ws(" ", *[F.col(c).cast("string") for c in cols]).alias("value")) \
        .write.mode("overwrite").text(path)


def q_qrels_roundtrip(spark, sf):
    """S3: qrels lines `qid 0 docno rel`, read back."""
    _, qrels = _b(spark, sf)
    path = _scratch(spark, "qrels")
    _write_lines(qrels.withColumn("it", F.lit("0")), ["qid", "it", "docno", "rel"], path)
    return read_qrels(spark, path)


def q_qrels_jg_roundtrip(spark, sf):
    """Fixture-C lines `qid jg docno rel`, read as qrels_jg and as prefs."""
    qj = FX.fixture_c_qrels_jg(spark, sf)
    path = _scratch(spark, "qrels_jg")
    _write_lines(qj, ["qid", "jg", "docno", "rel"], path)
    a = read_qrels_jg(spark, path).select("qid", "jg", "docno", F.col("rel").cast("double").alias("v"),
                                          F.lit("qrels_jg").alias("src"))
    b = read_qrels_as_prefs(spark, path).select("qid", "jg", "docno", F.col("rel_level").cast("double").alias("v"),
                                                F.concat(F.lit("prefs_jsg"), "jsg").alias("src"))
    return a.unionByName(b)


def q_prefs_roundtrip(spark, sf):
    """Fixture-D preference lines, read back."""
    p = FX.fixture_d_prefs(spark, sf)
    path = _scratch(spark, "prefs")
    _write_lines(p, ["qid", "jg", "jsg", "docno", "rel_level"], path)
    return read_prefs(spark, path).select("qid", "jg", "jsg", "docno", F.col("rel_level").cast("double"))


def q_topics_roundtrip(spark, sf):
    """Fixture-A topics written as `<top>` blocks, parsed back
    (number: `Number:` removed, trimmed, one leading zero dropped; title with
    `Topic: ` removed; description keeps its `Description:` label)."""
    _, topics = _a(spark, sf)
    path = _scratch(spark, "topics")
    block = F.concat(F.lit("<top>\n<num> Number: "), F.col("qid"), F.lit(" \n<dom> Domain: test\n"),
                     F.lit("<title> Topic: "), F.col("title"), F.lit("\n\n<desc> Description:\n"),
                     F.col("description"), F.lit("\n\n<smry> Summary:\n</top>"))
    topics.select(block.alias("value")).write.mode("overwrite").text(path)
    return read_topics(spark, path).select(
        "qid", "title", "description",
        F.array_join(tokenize(query_text("short")), " ").alias("short_terms"),
        F.array_join(tokenize(query_text("long")), " ").alias("long_terms"))


def q_zref_roundtrip(spark, sf):
    """Fixture-E z-score reference lines `qid measure mean stddev`, read back."""
    runs, qrels = _b(spark, sf)
    base = evaluate(runs, qrels, ["num_ret", "num_rel_ret", "map"]).per_topic
    z = FX.fixture_e_zref(base)
    path = _scratch(spark, "zref")
    _write_lines(z, ["qid", "measure", "mean", "stddev"], path)
    return read_zref(spark, path).select("qid", "measure", _r("mean"), _r("stddev"))


def q_report(spark, sf):
    """Report lines of the official measures (per topic and summary)."""
    runs, qrels = _b(spark, sf)
    ev = evaluate(runs, qrels, ["num_ret", "num_rel_ret", "map", "P"])
    return report_lines(ev).select("run_id", "line")


def source_queries() -> dict:
    return {
        "S2_S9_run_roundtrip": q_run_roundtrip,
        "S9_run_lines": q_run_lines,
        "S2_S7_number_fields": q_number_fields,
        "S11_malformed_lines": q_malformed_lines,
        "S3_qrels_roundtrip": q_qrels_roundtrip,
        "S4_S6_qrels_jg_roundtrip": q_qrels_jg_roundtrip,
        "S5_prefs_roundtrip": q_prefs_roundtrip,
        "S10_report": q_report,
        "S1_T1_T2_topics_roundtrip": q_topics_roundtrip,
        "S7_zref_roundtrip": q_zref_roundtrip,
    }


# ------------------------------------------------------------ groups / prefs
def q_jg(spark, sf, measures):
    runs, _ = _b(spark, sf)
    ev = evaluate_jg(runs, FX.fixture_c_qrels_jg(spark, sf), measures)
    return ev.per_topic.select("run_id", "qid", "measure", _r("value"))


def q_judged_jg(spark, sf):
    runs, _ = _b(spark, sf)
    qj = keep(FX.fixture_c_qrels_jg(spark, sf))
    rj = G.runs_per_group(runs, qj, EvalConfig())
    j = J.judged_rows(rj, qj, EvalConfig(), run_keys=["run_id", "qid", "jg"], topic_keys=["qid", "jg"])
    return j.select("run_id", "qid", "jg", "docno", F.col("code").cast("long"), "rank")


def _d_inputs(spark, sf, single=False, free_levels=False):
    """Fixture D; `single`: every subgroup becomes a group of its own.  Many steps read
    both frames, so they are cut from the base tables: those are read once for each."""
    prefs = FX.fixture_d_prefs(spark, sf, free_levels)
    if single:
        prefs = prefs.withColumns({"jg": F.concat_ws("/", "jg", "jsg"), "jsg": F.lit("0")})
    return cut_lineage(FX.fixture_d_runs(spark, sf)), cut_lineage(prefs)


def q_direct_pairs(spark, sf):
    _, prefs = _d_inputs(spark, sf)
    return P.direct_pairs(prefs)


def q_closure(spark, sf):
    _, prefs = _d_inputs(spark, sf)
    return P.preference_pairs(prefs).select("qid", "jg", "hi", "lo")


def q_inconsistent(spark, sf):
    """P3 over preferences with seeded faults: a second level in a subgroup
    (documents ending in 7), a level 0 beside others (ending in 3), and a
    subgroup that turns the order of topics ending in -2 round."""
    _, prefs = _d_inputs(spark, sf)
    other = prefs.where(F.col("docno").endswith("7")).withColumn("rel_level", F.col("rel_level") + 1)
    zero = prefs.where(F.col("docno").endswith("3")).withColumns(
        {"jsg": F.lit("z"), "rel_level": F.lit(0).cast("float")})
    turned = prefs.where("jsg = '0'").where(F.col("qid").endswith("-2")).withColumns(
        {"jsg": F.lit("r"), "rel_level": (F.lit(5) - F.col("rel_level")).cast("float")})
    faulty = prefs.unionByName(other).unionByName(zero).unionByName(turned.select(prefs.columns))
    return P.inconsistencies(faulty.select(prefs.columns)).distinct()


def q_jg_complete(spark, sf):
    """G1-G3 over every judged topic (-c): runs without the topics ending in -1."""
    runs, _ = _b(spark, sf)
    ev = evaluate_jg(runs.where(~F.col("qid").endswith("-1")), FX.fixture_c_qrels_jg(spark, sf),
                     ["num_q", "map_avgjg"], EvalConfig(complete=True))
    return ev.summary_values().select("run_id", "measure", _r("value"))


def q_search(spark, sf):
    """One ad-hoc query over all documents, words taken from a title."""
    docs, topics = _a(spark, sf)
    text = topics.orderBy("qid").select("title").first()["title"]
    return search(spark, docs, text, model="bm25").select(
        "run_id", "docno", _r("score"))


def q_positions(spark, sf):
    runs, prefs = _d_inputs(spark, sf)
    return P.judged_positions(runs, prefs, EvalConfig()).select(
        "run_id", "qid", "docno", F.col("pos").cast("long"), "njr", "nj")


def _pp(spark, sf, single=False):
    runs, prefs = _d_inputs(spark, sf, single)
    shape = cut_lineage(P.group_shape(prefs))
    pos = cut_lineage(P.judged_positions(runs, prefs, EvalConfig()))
    pp = P.pair_positions(P.preference_pairs(prefs, shape), pos)
    return prefs, shape, pos, pp


def q_jg_counts(spark, sf, single=False, free_levels=False):
    runs, prefs = _d_inputs(spark, sf, single, free_levels)
    shape = cut_lineage(P.group_shape(prefs))
    pos = cut_lineage(P.judged_positions(runs, prefs, EvalConfig()))
    multi = relation = None
    if not single:
        classes = cut_lineage(P.doc_classes(prefs.join(shape.where("n_jsg > 1"), ["qid", "jg"], "left_semi")))
        multi, relation = P.class_docs(classes, pos), P.class_relation(classes)
    c, *_ = P.all_group_counts(cut_lineage(P.doc_levels(prefs, shape)), pos, multi, relation)
    return c.select("run_id", "qid", "jg", *[F.col(x).cast("long") for x in (
        "ful_ret", "poss_ret", "ful_imp", "poss_imp", "notoccur", "rel", "rel_ret", "nonrel", "nonrel_ret")])


def q_pair_counts(spark, sf):
    _, _, _, pp = _pp(spark, sf)
    return P.pair_counts(pp).select("run_id", "qid", F.col("pu").cast("long"), F.col("pd").cast("long"),
                                    F.col("c_up").cast("long"), F.col("c_down").cast("long"))


def q_prefs(spark, sf, names, single=False, skew_safe=False):
    runs, prefs = _d_inputs(spark, sf, single)
    ev = P.evaluate_prefs(runs, prefs, names, EvalConfig(skew_safe=skew_safe))
    return ev.per_topic.select("run_id", "qid", "measure", _r("value"))


PREF_SIMPLE = ["prefs_num_prefs_poss", "prefs_num_prefs_ful", "prefs_num_prefs_ful_ret",
               "prefs_simp", "prefs_simp_ret", "prefs_simp_imp"]
PREF_PAIR = ["prefs_pair", "prefs_pair_ret", "prefs_pair_imp"]
PREF_AVGJG = ["prefs_avgjg", "prefs_avgjg_ret", "prefs_avgjg_imp"]
PREF_RNONREL = ["prefs_avgjg_Rnonrel", "prefs_avgjg_Rnonrel_ret"]


def group_pref_queries() -> dict:
    return {
        "J7_judged_join_jg": q_judged_jg,
        "G1_map_avgjg": partial(q_jg, measures=["map_avgjg"]),
        "G2_P_avgjg": partial(q_jg, measures=["P_avgjg"]),
        "G3_Rprec_mult_avgjg": partial(q_jg, measures=["Rprec_mult_avgjg"]),
        "G_complete": q_jg_complete,
        "P1_direct_pairs": q_direct_pairs,
        "P2_closure": q_closure,
        "P3_inconsistencies": q_inconsistent,
        "P4_judged_positions": q_positions,
        "P5_P6_jg_counts": q_jg_counts,
        "P6_single_subgroup_counts": partial(q_jg_counts, single=True),
        "P6_free_levels": partial(q_jg_counts, single=True, free_levels=True),
        "P7_pair_counts": q_pair_counts,
        "P8_P11_P15_P19_simple": partial(q_prefs, names=PREF_SIMPLE),
        "P12_P16_P20_pair": partial(q_prefs, names=PREF_PAIR),
        "P13_P17_P21_avgjg": partial(q_prefs, names=PREF_AVGJG),
        "P14_P18_Rnonrel": partial(q_prefs, names=PREF_RNONREL),
        "P_single_subgroup_all": partial(q_prefs, names="all_prefs", single=True),
        "P_single_subgroup_prefix_scan": partial(q_prefs, names="all_prefs", single=True, skew_safe=5),
    }


def _released(query):
    """The query's result as a checkpoint, with all that it persisted released."""
    def run(spark, sf):
        with owned():
            return cut_lineage(query(spark, sf))
    return run


def all_queries() -> dict:
    q = {}
    q.update(group_pref_queries())
    q.update(eval_queries())
    q.update(retrieval_queries())
    q.update(source_queries())
    return {name: _released(query) for name, query in q.items()}
