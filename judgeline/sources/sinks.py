"""Sinks: run files (S9) and evaluation reports.

Both are formatted with JVM string functions and written with
`DataFrame.write.text`, partitioned by run so every run lands in its own
folder; nothing is collected to the driver.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_written(runs: DataFrame) -> DataFrame:
    """Scores rounded to the 5 decimals a run file keeps (for a faithful
    search -> file -> evaluate chain)."""
    return runs.withColumn("sim", F.round(F.col("sim").cast("double"), 5).cast("float"))


def run_lines(runs: DataFrame, score_col: str = "score", rank_col: str = "rank") -> DataFrame:
    """`qid 0 docno rank score tag`, score with 5 decimals."""
    return runs.select(
        "run_id",
        F.concat_ws(" ", F.col("qid"), F.lit("0"), F.col("docno"),
                    F.col(rank_col).cast("string"),
                    F.format_string("%.5f", F.col(score_col).cast("double")),
                    F.col("run_id")).alias("value"))


def write_run(runs: DataFrame, path: str, score_col: str = "score",
              rank_col: str = "rank", mode: str = "overwrite", parts: int | None = None) -> None:
    """Write one text folder per run_id under `path`; its part files, in name order,
    hold the lines by topic and rank.

    Rows are dealt by ranges of (run, topic, rank), so a run has as many part files
    as ranges it touches: runs and `parts` (the session's shuffle partitions by
    default) together bound the number of files."""
    keys = ["run_id", "qid", F.col(rank_col).cast("long")]
    dealt = runs.repartitionByRange(parts, *keys) if parts else runs.repartitionByRange(*keys)
    run_lines(dealt.sortWithinPartitions(*keys), score_col, rank_col) \
        .write.mode(mode).partitionBy("run_id").text(path)


def _num(value) -> "F.Column":
    """C printf `%6.4f` (NaN prints as `nan`)."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(F.isnan(v), F.lit("   nan")).otherwise(F.format_string("%6.4f", v))


def _line(z: str, measure, qid, text) -> "F.Column":
    return F.format_string(z + "%-22s\t%s\t%s", measure, qid, text)


def report_lines(ev, per_topic: bool = True, summary: bool = True) -> DataFrame:
    """Report lines `%-22s\\t%s\\t%6.4f` (counts as integers, `Z` prefix
    after z-scoring) with sort keys (run_id, sec, qid, ord)."""
    z = "Z" if ev.zscored else ""
    parts = []
    if per_topic:
        pt = ev.per_topic_all.where(F.col("kind") != "geo")
        text = _num("value") if ev.zscored else \
            F.when(F.col("kind") == "sum", F.col("value").cast("long").cast("string")) \
            .otherwise(_num("value"))
        parts.append(pt.select("run_id", F.lit(0).alias("sec"), "qid", "ord",
                               _line(z, F.col("measure"), F.col("qid"), text).alias("line")))
        if ev.strings is not None:
            parts.append(ev.strings.select(
                "run_id", F.lit(0).alias("sec"), "qid", "ord",
                _line("", F.col("measure"), F.col("qid"),
                      F.concat(F.lit("'"), F.col("text"), F.lit("'"))).alias("line")))
    if summary:
        s = ev.summary()
        text = _num("value") if ev.zscored else \
            F.when(F.col("kind").isin("sum", "count"), F.col("value").cast("long").cast("string")) \
            .otherwise(_num("value"))
        parts.append(s.select("run_id", F.lit(1).alias("sec"), F.lit("all").alias("qid"), "ord",
                              _line(z, F.col("measure"), F.lit("all"), text).alias("line")))
        if any(n == "runid" for n, _ in ev.selected):
            parts.append(ev.num_q.select(
                "run_id", F.lit(1).alias("sec"), F.lit("all").alias("qid"),
                F.array(F.lit(-1)).alias("ord"),
                _line("", F.lit("runid"), F.lit("all"), F.col("run_id")).alias("line")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_report(ev, path: str, per_topic: bool = True, summary: bool = True,
                 mode: str = "overwrite") -> None:
    """Write the report text, one folder per run; its part files, in name order,
    hold the lines in report order."""
    lines = report_lines(ev, per_topic, summary)
    (lines.repartitionByRange("run_id", "sec", "qid")
     .sortWithinPartitions("run_id", "sec", "qid", "ord")
     .select("run_id", F.col("line").alias("value"))
     .write.mode(mode).partitionBy("run_id").text(path))
