"""Helpers that several operators of this subpackage share."""
from __future__ import annotations

import json
import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from judgeline.session import cut_lineage, ensure_checkpoint_dir

#: A word: a longest run of characters that are no ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
KEY_BITS = 60
ROWS_PER_BUCKET = 2_000
CROWDED = 4               # a range of so many times its rows is cut again
COPIES = 1_000            # of a row that are kept as one row of prefix sums


def ship(name: str) -> None:
    """Send the functions of module ``name`` to Python workers by value, so that
    executors need no copy of this library on their path."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


ship(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Number of words of a text as long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def hash_key(column: Column, seed: str) -> Column:
    """Uniform key of 60 bits (long): the head of the MD5 of ``seed:value``."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(column.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long")


def crc_mod(column: Column, n: int) -> Column:
    """crc32 of a value written as text, modulo n; a null counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % F.lit(n)


def constant(value, schema: str) -> Column:
    """A Python value of any size and nesting as one constant of the plan."""
    return F.from_json(F.lit(json.dumps({"v": value})), f"v {schema}")["v"]


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/judgeline-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def broadcast_if_small(df: DataFrame, limit_mb: float = 16) -> DataFrame:
    """Hint a broadcast only when the measured bytes of ``df`` stay under the
    limit; beyond it the planner's shuffle join is used.  ``df`` should be
    materialised: it is read once for the measurement."""
    bytes_ = F.lit(64)
    for name, kind in df.dtypes:
        if kind == "string":
            bytes_ = bytes_ + F.coalesce(F.octet_length(F.col(name)), F.lit(0))
    size = df.select(F.sum(bytes_.cast("long")).alias("b")).first()["b"] or 0
    return F.broadcast(df) if size <= limit_mb * 2**20 else df


def counted(df: DataFrame, most: int | None = COPIES) -> DataFrame:
    """The different rows of ``df``, with ``copies``, how often each occurs, and
    ``part``: with ``most``, a row of more copies than that becomes several parts,
    so that no later step holds all copies of a row at once."""
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))
    if most is None:
        return rows.withColumn("part", F.lit(0).cast("long"))
    last = F.floor((F.col("copies") - 1) / most).cast("long")
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return rows.withColumn("copies", F.least(F.lit(most).cast("long"), F.col("copies") - F.col("part") * most))


def each_copy(rows: DataFrame) -> DataFrame:
    """The rows of ``counted`` as often as they occur, numbered from 0 in ``copy``."""
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))


def spread(*columns: str | Column) -> Column:
    """Uniform key of 60 bits (long) of some columns; faster than ``hash_key``."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 64 - KEY_BITS)


def _range(key: str | Column, parts: Column) -> Column:
    """Which of ``parts`` equal ranges a 60-bit key falls in: its upper 30 bits pick
    the range, so nothing overflows up to 2**33 ranges."""
    return F.shiftright(F.shiftright(key, KEY_BITS - 30) * parts, 30)


def prefix_sums(df: DataFrame, groups: list[str], key: str, order: list[str],
                value: Column, out: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows before this one, within
    ``groups``, in the order of (``key``, ``spread`` of ``order``, ``order``).

    ``key`` is a uniform hash key, so equal ranges of it hold about equal
    numbers of rows: a group is cut into ranges of about ``rows_per_bucket``
    rows, each range is sorted and summed by itself, and the ranges' totals are
    summed in turn.  A group of any size is spread over many tasks.  Ranges that
    hold far more rows, as very many rows share a key, are cut again: by key, and
    each key by ranges of the second hash.  That spreads rows which differ in
    ``order``; ``counted`` makes them differ.  ``df`` should be materialised: it is
    read three times.  Null group values form a group of their own.
    """
    made = ["_g", "_v", "_nb", "_b", "_hash", "_k", "_s", "_parts", "_start"]
    keyed = df.withColumn("_g", F.to_json(F.struct(*groups), {"ignoreNullFields": "false"})) \
        .withColumn("_v", value).withColumn("_hash", spread(*order))
    ranges = keyed.groupBy("_g").agg(
        F.ceil(F.count("*") / F.lit(rows_per_bucket)).cast("long").alias("_nb"))
    keyed = keyed.join(broadcast_if_small(cut_lineage(ranges)), "_g").withColumn("_b", _range(key, F.col("_nb")))
    place = ["_b"]
    totals = cut_lineage(keyed.groupBy("_g", "_b").agg(F.sum("_v").alias("_n"), F.count("*").alias("_rows")))
    crowded = totals.where(F.col("_rows") > CROWDED * rows_per_bucket).select("_g", "_b")
    if not crowded.isEmpty():
        place = ["_b", "_k", "_s"]
        shares = keyed.join(broadcast_if_small(crowded), ["_g", "_b"], "left_semi").groupBy("_g", "_b", F.col(key).alias("_k")) \
            .agg(F.ceil(F.count("*") / F.lit(rows_per_bucket)).cast("long").alias("_parts"))
        shares = broadcast_if_small(cut_lineage(shares))
        keyed = keyed.withColumn("_key", F.col(key)).join(shares.withColumnRenamed("_k", "_key"), ["_g", "_b", "_key"], "left") \
            .withColumn("_k", F.when(F.col("_parts").isNotNull(), F.col("_key")).otherwise(0)) \
            .withColumn("_s", F.coalesce(_range("_hash", F.col("_parts")), F.lit(0))).drop("_key")
        totals = keyed.groupBy("_g", *place).agg(F.sum("_v").alias("_n"))
    before = Window.partitionBy("_g").orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_g", *place, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_g", *place).orderBy(key, "_hash", *order) \
        .rowsBetween(Window.unboundedPreceding, -1)
    return (keyed.join(broadcast_if_small(cut_lineage(starts)), ["_g", *place])
            .withColumn(out, F.col("_start") + F.coalesce(F.sum("_v").over(within), F.lit(0)))
            .drop(*made))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected ``edges`` between ids that sort.

    Returns (id, root): every id that has an edge and the smallest id reachable
    from it.  Each round hooks an id to its smallest neighbour, jumps pointers
    twice and contracts the edges, so that their number falls fast; each round
    is cut with a checkpoint.  Nothing is collected.
    """
    left = cut_lineage(edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
                       .where("a <> b").distinct())
    roots = None
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        hook = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")) \
            .select("id", F.least("id", "m").alias("up"))
        hook = cut_lineage(hook)
        for _ in range(2):
            above = hook.select(F.col("id").alias("up"), F.col("up").alias("top"))
            hook = hook.join(above, "up").select("id", F.col("top").alias("up"))
        hook = cut_lineage(hook)
        if roots is None:
            roots = hook.select("id", F.col("up").alias("root"))
        else:
            moved = hook.select(F.col("id").alias("root"), "up")
            roots = roots.join(moved, "root", "left") \
                .select("id", F.coalesce("up", "root").alias("root"))
        roots = cut_lineage(roots)
        to = hook.select(F.col("id").alias("a"), F.col("up").alias("ua"))
        left = (left.join(to, "a").select(F.col("b"), "ua")
                .join(to.select(F.col("a").alias("b"), F.col("ua").alias("ub")), "b")
                .select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b"))
                .where("a <> b").distinct())
        left = cut_lineage(left)
    if roots is None:
        return left.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return roots
