"""retrieve(): documents + topics -> runs, for every model and query kind in
one job (T18), plus ad-hoc search (T20) and run comparison (T21)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import STOP_WORDS
from ..operators import scoring as SC
from ..operators import termstats as TS
from ..session import keep


def query_table(topics: DataFrame, kinds=("short", "long"), stop_words=STOP_WORDS,
                keep_description_label: bool = True) -> DataFrame:
    """(kind, qid, term, qtf, first_pos) for every requested query kind."""
    out = None
    for k in kinds:
        q = TS.query_terms(topics, k, stop_words, keep_description_label).withColumn("kind", F.lit(k))
        out = q if out is None else out.unionByName(q)
    return out


def scored(docs: DataFrame, topics: DataFrame, models=SC.MODELS, kinds=("short", "long"),
           stop_words=STOP_WORDS, keep_description_label: bool = True):
    """Every matching (kind, qid, docno) with one score column per model,
    plus the pruned postings and collection statistics used."""
    models = SC.check_models(models)
    qt = keep(query_table(topics, kinds, stop_words, keep_description_label))
    post, stats = TS.index_for(docs, qt.select("term"), stop_words)
    ts = TS.term_stats(post)
    s = SC.score(post, qt, ts, stats, models, keys=("kind", "qid"))
    return s, post, qt, ts, stats


def retrieve(docs: DataFrame, topics: DataFrame, models=SC.MODELS, kinds=("short", "long"),
             k: int = SC.TOP_K, stop_words=STOP_WORDS, round_digits: int | None = None,
             zero_based: bool = False, keep_description_label: bool = True) -> DataFrame:
    """runs(run_id, qid, docno, score, rank) for models x kinds, tagged
    like the reference (`BM25_SHORT`, `DEFAULT_LONG`, ...), top k per topic."""
    s, _, _, _, stats = scored(docs, topics, models, kinds, stop_words, keep_description_label)
    runs = SC.as_runs(s, models)
    if stats.num_docs > 4 * SC.BOUND_PART * k:      # fewer: most topics have too few documents for a bound
        runs = SC.above_bounds(runs, k, round_digits=round_digits)
    return SC.top_k(runs, k, round_digits=round_digits, zero_based=zero_based)


def search(spark: SparkSession, docs: DataFrame, text: str, k: int = SC.TOP_K,
           model: str = "tfidf") -> DataFrame:
    """One ad-hoc query; returns however many documents match (<= k)."""
    topic = spark.createDataFrame([("q", text, text)], "qid string, title string, description string")
    return retrieve(docs, topic, [model], ("short",), k)


def explain(docs: DataFrame, topics: DataFrame, kind: str = "short", model: str = "tfidf",
            stop_words=STOP_WORDS) -> DataFrame:
    """Term contributions and running score per (qid, docno)."""
    return explain_kinds(docs, topics, (kind,), model, stop_words).drop("kind")


def explain_kinds(docs: DataFrame, topics: DataFrame, kinds=("short", "long"), model: str = "tfidf",
                  stop_words=STOP_WORDS) -> DataFrame:
    """T19 for several query kinds from one pass over the documents: adds `kind`."""
    qt = keep(query_table(topics, kinds, stop_words))
    post, stats = TS.index_for(docs, qt.select("term"), stop_words)
    return SC.explain_terms(post, qt, TS.term_stats(post), stats, model, keys=("kind", "qid"))


MAX_COLUMNS = 1000      # runs of one wide comparison


def compare_runs(summary: DataFrame, measures=None, runs: list[str] | None = None) -> DataFrame:
    """One row per measure, one column per run, in the order of `runs`, or of
    the run ids if they are `MAX_COLUMNS` at most (one bounded look at the ids; more
    need `runs`, a block of columns at a time, or `compare_narrow`).  Ids that differ
    by case only would be one column to the engine: the later ones get a number."""
    s = compare_narrow(summary, measures)
    if runs is None:
        runs = [r["run_id"] for r in s.select("run_id").distinct().orderBy("run_id").limit(MAX_COLUMNS + 1).collect()]
        if len(runs) > MAX_COLUMNS:
            raise ValueError(f"more than {MAX_COLUMNS} runs: name those to compare, or use compare_narrow")
    wide = s.groupBy("measure").pivot("run_id", list(runs)).agg(F.first("value"))
    return wide.toDF("measure", *column_names(runs))


def column_names(runs: list[str]) -> list[str]:
    names, used = [], {"measure"}
    for run in runs:
        name, k = run, 1
        while name.lower() in used:
            k += 1
            name = f"{run}_{k}"
        used.add(name.lower())
        names.append(name)
    return names


def compare_narrow(summary: DataFrame, measures=None) -> DataFrame:
    """T21 for any number of runs: (measure, run_id, value)."""
    s = summary.select("measure", "run_id", "value")
    return s if measures is None else s.where(F.col("measure").isin(list(measures)))
