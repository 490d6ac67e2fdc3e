"""Stand-in inputs built from the driver's test tables (FIXTURES.md).

These only shape rows into the schemas the library expects (runs, qrels,
qrels_jg, prefs, zref, docs, topics); they do none of the library's work.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CUT_DATE = "1997-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    b = li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
    return b.select(
        F.concat(F.col("c_nationkey").cast("string"), F.lit("-"),
                 F.substring("o_orderpriority", 1, 1)).alias("qid"),
        F.concat(F.lit("P"), F.lpad(F.col("l_partkey").cast("string"), 8, "0")).alias("docno"),
        "l_partkey", "l_quantity", "l_returnflag", "l_shipdate")


def _before(b: DataFrame) -> DataFrame:
    return b.where(F.col("l_shipdate") < F.lit(CUT_DATE).cast("timestamp"))


def _after(b: DataFrame) -> DataFrame:
    return b.where(F.col("l_shipdate") >= F.lit(CUT_DATE).cast("timestamp"))


def fixture_b_runs(spark: SparkSession, sf_dir: str, two_runs: bool = True) -> DataFrame:
    """runs(run_id, qid, docno, sim): earlier purchases per (nation-priority, part)."""
    g = _before(_base(spark, sf_dir)).groupBy("qid", "docno", "l_partkey").agg(
        F.sum("l_quantity").alias("q"))
    if not two_runs:
        return g.select(F.lit("sumqty").alias("run_id"), "qid", "docno",
                        F.col("q").cast("float").alias("sim"))
    # both runs from one aggregate: one scan of the base tables
    two = F.expr("stack(2, 'sumqty', CAST(q AS FLOAT), "
                 "'hash97', CAST(pmod(l_partkey * 31, 97) AS FLOAT)) AS (run_id, sim)")
    return g.select("qid", "docno", two).select("run_id", "qid", "docno", "sim")


def _rel_of(q):
    return (F.when(q >= 60, 2).when(q >= 25, 1).when(q >= 8, 0).otherwise(-1)).cast("int")


def fixture_b_qrels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """qrels(qid, docno, rel): later purchases graded 2/1/0/-1."""
    g = _after(_base(spark, sf_dir)).groupBy("qid", "docno").agg(F.sum("l_quantity").alias("q"))
    return g.select("qid", "docno", _rel_of(F.col("q")).alias("rel"))


def fixture_c_qrels_jg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """qrels_jg(qid, jg, docno, rel): fixture B judged separately per return flag."""
    g = _after(_base(spark, sf_dir)).groupBy("qid", F.col("l_returnflag").alias("jg"), "docno") \
        .agg(F.sum("l_quantity").alias("q"))
    return g.select("qid", "jg", "docno", _rel_of(F.col("q")).alias("rel"))


def _dm(b: DataFrame) -> DataFrame:
    return b.withColumn("m", F.pmod(F.col("l_partkey"), F.lit(30)))


def fixture_d_prefs(spark: SparkSession, sf_dir: str, free_levels: bool = False) -> DataFrame:
    """prefs(qid, jg, jsg, docno, rel_level): two overlapping judgement subgroups; with
    `free_levels` nearly every document has a level of its own."""
    level = F.sum("l_quantity").cast("int")
    g = _dm(_after(_base(spark, sf_dir))).groupBy("qid", F.col("l_returnflag").alias("jg"), "m") \
        .agg((level if free_levels else level % 4).alias("lev"))
    doc = F.concat(F.lit("M"), F.lpad(F.col("m").cast("string"), 2, "0"))
    # both subgroups from one aggregate: one scan of the base tables
    third = F.pmod("m", F.lit(3))
    subgroups = (F.when(third == 0, F.array(F.lit("0"))).when(third == 1, F.array(F.lit("0"), F.lit("1")))
                 .when(third == 2, F.array(F.lit("1"))))
    return g.select("qid", "jg", F.explode(subgroups).alias("jsg"), doc.alias("docno"),
                    F.col("lev").cast("float").alias("rel_level"))


def fixture_d_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _dm(_before(_base(spark, sf_dir))).groupBy("qid", "m").agg(F.sum("l_quantity").alias("q"))
    return g.select(F.lit("sumqty").alias("run_id"), "qid",
                    F.concat(F.lit("M"), F.lpad(F.col("m").cast("string"), 2, "0")).alias("docno"),
                    F.col("q").cast("float").alias("sim"))


def fixture_e_zref(per_topic: DataFrame) -> DataFrame:
    """zref(qid, measure, mean, stddev) over the runs of an evaluation: topics
    ending in -5 left out, stddev forced to 0 for num_rel."""
    z = per_topic.groupBy("qid", "measure").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("stddev"))
    z = z.where(~F.col("qid").endswith("-5"))
    return z.withColumn("stddev", F.when(F.col("measure") == "num_rel", F.lit(0.0))
                        .otherwise(F.col("stddev")))


def fixture_a_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(F.concat(F.lit("D"), F.lpad(F.col("doc_id").cast("string"), 8, "0")).alias("docno"),
                    "text")


def fixture_a_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """topics(qid, title, description): title = first 4 tokens of a benchmark
    passage, description = the whole passage."""
    b = table(spark, sf_dir, "benchmark")
    toks = F.regexp_extract_all(F.lower(F.col("text")), F.lit(r"[\p{L}\p{N}]+"), 0)
    return b.select(F.col("item_id").cast("string").alias("qid"),
                    F.array_join(F.slice(toks, 1, 4), " ").alias("title"),
                    F.col("text").alias("description"))


def fixture_a_qrels(spark: SparkSession, sf_dir: str, shingle: int = 4) -> DataFrame:
    """qrels(qid, docno, rel=1): documents containing a whole benchmark passage.

    Candidates come from an equi-join on an interior token shingle of the
    passage (no document x passage product); containment is then verified on
    the raw text."""
    from ..functions.text import raw_tokens

    docs = fixture_a_docs(spark, sf_dir)
    b = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").cast("string").alias("qid"), F.col("text").alias("passage"))
    bt = b.withColumn("toks", raw_tokens(F.col("passage")))
    # interior shingle: skip the first and last token, which may be glued to
    # neighbouring text in the document
    n = F.size("toks")
    start = F.when(n >= shingle + 2, F.lit(2)).otherwise(F.lit(1))
    length = F.least(F.lit(shingle), n)
    key = F.array_join(F.slice("toks", start, length), " ")
    keys = bt.select("qid", "passage", key.alias("k"), length.alias("ln"))
    dt = docs.select("docno", raw_tokens(F.col("text")).alias("toks"))
    # shingle lengths in use: `shingle`, shorter only for very short passages
    lens = sorted(r["ln"] for r in keys.select("ln").distinct().collect())
    cand = None
    for ln in lens:
        sh = dt.select("docno", F.explode(F.array_distinct(F.transform(
            F.sequence(F.lit(1), F.greatest(F.size("toks") - ln + 1, F.lit(1))),
            lambda i: F.array_join(F.slice("toks", i, ln), " ")))).alias("k"))
        c = sh.join(keys.where(F.col("ln") == ln), "k").select("qid", "docno", "passage")
        cand = c if cand is None else cand.unionByName(c)
    cand = cand.distinct().join(docs, "docno")
    hit = cand.where(F.instr(F.col("text"), F.col("passage")) > 0)
    return hit.select("qid", "docno", F.lit(1).alias("rel"))
