"""Readers for the whitespace-separated evaluation formats (S2-S7, S11) and
topic files (S1).

Every reader is one `spark.read.text` over any number of files (a glob, a
folder or a list), split with JVM string functions; no line passes through
Python.  A wrong field count ends a read; `malformed_lines` lists such lines with
their numbers (S11).  Number fields are read as the evaluator reads them: what a
field begins with counts, and a field that begins with no number is 0.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_WS = r"\s+"


def jtrim(c: Column) -> Column:
    """Trim every control/space character (<= U+0020) at both ends, like
    Java's String.trim (Spark's trim removes spaces only)."""
    return F.regexp_replace(c, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def _fields(spark: SparkSession, paths) -> DataFrame:
    """One row per line: the array of whitespace-separated fields,
    the source file and the line's position inside that file."""
    raw = spark.read.text(paths).select(
        F.col("value"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_pos"),
    )
    return raw.select(
        F.split(jtrim(F.col("value")), _WS).alias("f"),
        jtrim(F.col("value")).alias("_line"),
        "_file", "_block", "_pos",
    )


#: What the evaluator's number fields begin with; the rest is ignored.
LEADING_INT = r"^[+-]?[0-9]+"
LEADING_FLOAT = r"(?i)^[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|inf(?:inity)?|nan)"
INT_MAX = 2147483647


def leading_int(c: Column) -> Column:
    """The whole number that a field begins with (sign and digits), 0 if none: `2x`
    and `2.9` are 2, `3e2` is 3.  Numbers beyond 32 bits end at the limit."""
    found = F.regexp_extract(c, LEADING_INT, 0)
    value = found.try_cast("decimal(38,0)")
    low, high = F.lit(-INT_MAX - 1), F.lit(INT_MAX)
    beyond = F.when(found.startswith("-"), low).otherwise(high)      # null: over 38 digits
    return (F.when(found == "", F.lit(0)).when(value.isNull(), beyond)
            .when(value > high, high).when(value < low, low).otherwise(value.try_cast("int")))


def leading_double(c: Column) -> Column:
    """The decimal number that a field begins with (sign, digits, point, exponent),
    0 if none: `2.5x` and `2.5e` are 2.5, `3e2` is 300."""
    return F.coalesce(F.regexp_extract(c, LEADING_FLOAT, 0).try_cast("double"), F.lit(0.0))


def leading_float(c: Column) -> Column:
    return leading_double(c).cast("float")


def line_numbers(lines: DataFrame) -> DataFrame:
    """Adds `line_no`, from 1 in each file, to the rows of `_fields` (or some of them).

    Lines of one block of a file are numbered consecutively by the scan; blocks are
    counted by an aggregate, and a block starts after the lines of the file's
    blocks before it.  Files are not read in order, and no line is moved."""
    spark_lines = lines.select("_file", "_block", "_pos")
    blocks = spark_lines.groupBy("_file", "_block").agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("_file", "_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return lines.join(starts, ["_file", "_block"]).withColumn(
        "line_no", F.col("_before") + F.col("_pos") - F.col("_first") + 1).drop("_before", "_first")


def read_lines(spark: SparkSession, paths) -> DataFrame:
    """(file, line_no, line): every line of text files with its place."""
    return line_numbers(_fields(spark, paths)).select(F.col("_file").alias("file"), "line_no", F.col("_line").alias("line"))


def malformed_lines(spark: SparkSession, paths, n_fields: int,
                    allow_extra: bool = False, allow_blank: bool = False) -> DataFrame:
    """The lines that a strict read stops at: file, line_no, line, n_fields.
    Judgements allow no blank line; result files do, and extra fields."""
    size = F.when(F.col("_line") == "", F.lit(0)).otherwise(F.size("f"))
    bad = size < n_fields
    if not allow_extra:
        bad = bad | (size > n_fields)
    if allow_blank:
        bad = bad & (F.col("_line") != "")
    return line_numbers(_fields(spark, paths)).where(bad).select(
        F.col("_file").alias("file"), "line_no", F.col("_line").alias("line"), size.alias("n_fields"))


def _lines(spark: SparkSession, paths, n_fields: int, what: str, strict: bool,
           allow_extra: bool = False, allow_blank: bool = False) -> DataFrame:
    """The lines' fields, in one pass.  A wrong number of fields, a blank line
    included unless allowed, ends the read with an error naming the line
    (`malformed_lines` has its number); without `strict` such lines go."""
    df = _fields(spark, paths)
    if allow_blank:
        df = df.where(F.col("_line") != "")
    good = F.size("f") >= n_fields
    if not strict:
        return df.where(good)
    if not allow_extra:
        good = good & (F.size("f") <= n_fields)
    message = F.concat(F.lit(f"malformed {what} line (expected {n_fields} fields) in "),
                       F.col("_file"), F.lit(": "), F.col("_line"))
    return df.where(F.when(good, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def read_run(spark: SparkSession, paths, run_id: str = "file",
             strict: bool = True) -> DataFrame:
    """runs(run_id, qid, docno, sim float) from `qid iter docno rank sim tag`.

    Trailing extra fields are ignored and blank lines skipped; a line with fewer
    fields ends the read (`strict=False` drops it).  The rank field
    is ignored (rank is re-derived from sim).  ``run_id="file"`` takes the tag
    of each file's last line as the run identifier, as the evaluator does;
    ``run_id="line"`` keeps each line's own tag.
    """
    df = _lines(spark, paths, 6, "results", strict, allow_extra=True, allow_blank=True)
    rows = df.select(
        F.col("f")[0].alias("qid"),
        F.col("f")[2].alias("docno"),
        leading_float(F.col("f")[4]).alias("sim"),
        F.col("f")[5].alias("tag"),
        "_file", "_block", "_pos",
    )
    if run_id == "line":
        return rows.select(F.col("tag").alias("run_id"), "qid", "docno", "sim")
    last_tag = rows.groupBy("_file").agg(
        F.max_by("tag", F.struct("_block", "_pos")).alias("run_id"))
    return rows.join(last_tag, "_file").select(
        "run_id", "qid", "docno", "sim")


def read_qrels(spark: SparkSession, paths, strict: bool = True) -> DataFrame:
    """S3: qrels(qid, docno, rel int) from `qid iter docno rel`."""
    f = _lines(spark, paths, 4, "qrels", strict)
    return f.select(F.col("f")[0].alias("qid"), F.col("f")[2].alias("docno"),
                    leading_int(F.col("f")[3]).alias("rel"))


def read_qrels_jg(spark: SparkSession, paths, strict: bool = True) -> DataFrame:
    """qrels_jg(qid, jg, docno, rel int) from `qid jg docno rel`."""
    f = _lines(spark, paths, 4, "qrels_jg", strict)
    return f.select(F.col("f")[0].alias("qid"), F.col("f")[1].alias("jg"),
                    F.col("f")[2].alias("docno"),
                    leading_int(F.col("f")[3]).alias("rel"))


def read_prefs(spark: SparkSession, paths, strict: bool = True) -> DataFrame:
    """prefs(qid, jg, jsg, docno, rel_level float) from five fields."""
    f = _lines(spark, paths, 5, "prefs", strict)
    return f.select(F.col("f")[0].alias("qid"), F.col("f")[1].alias("jg"),
                    F.col("f")[2].alias("jsg"), F.col("f")[3].alias("docno"),
                    leading_float(F.col("f")[4]).alias("rel_level"))


def read_qrels_as_prefs(spark: SparkSession, paths, strict: bool = True) -> DataFrame:
    """A qrels file read as prefs: jg = second field, jsg = "0"."""
    f = _lines(spark, paths, 4, "qrels_prefs", strict)
    return qrels_to_prefs(f.select(
        F.col("f")[0].alias("qid"), F.col("f")[1].alias("jg"),
        F.col("f")[2].alias("docno"), leading_int(F.col("f")[3]).alias("rel")))


def qrels_to_prefs(qrels_jg: DataFrame) -> DataFrame:
    """Judgements (qid, jg, docno, rel) as preferences with a single jsg."""
    return qrels_jg.select("qid", "jg", F.lit("0").alias("jsg"), "docno",
                           F.col("rel").cast("float").alias("rel_level"))


def read_zref(spark: SparkSession, paths, strict: bool = True) -> DataFrame:
    """zref(qid, measure, mean double, stddev double)."""
    f = _lines(spark, paths, 4, "zscores", strict)
    return f.select(F.col("f")[0].alias("qid"), F.col("f")[1].alias("measure"),
                    leading_double(F.col("f")[2]).alias("mean"),
                    leading_double(F.col("f")[3]).alias("stddev"))


def read_topics(spark: SparkSession, paths) -> DataFrame:
    """S1 + T1: topics(qid, title, description) from `<top>` blocks.

    Number is the text between `<num>` and `<dom>` without `Number:`, trimmed,
    with one leading zero dropped; title is the text between `<title>` and
    `<desc>` with `Topic: ` removed; description is the text between `<desc>`
    and `<smry>` (its `Description:` label is kept, see `query_text`).
    """
    blocks = spark.read.text(paths, lineSep="</top>")
    return topic_fields(blocks.select(F.col("value").alias("block")))


def topic_fields(blocks: DataFrame, col: str = "block") -> DataFrame:
    b = F.col(col)

    def between(a: str, z: str) -> Column:
        return F.regexp_extract(b, f"(?s)<{a}>(.*?)<{z}>", 1)

    num = jtrim(F.regexp_replace(between("num", "dom"), "Number:", ""))
    n = F.col("_num")
    qid = F.when(F.substring(n, 1, 1) == "0", F.expr("substring(_num, 2)")).otherwise(n)
    return (blocks.where(b.contains("<num>"))
            .select(num.alias("_num"),
                    F.regexp_replace(between("title", "desc"), "Topic: ", "").alias("title"),
                    between("desc", "smry").alias("description"))
            .select(qid.alias("qid"), "title", "description"))


def read_docs(df: DataFrame, docno_col: str, text_col: str) -> DataFrame:
    """docs(docno string, text) from any table with these two columns."""
    return df.select(F.col(docno_col).cast("string").alias("docno"), F.col(text_col).alias("text"))
