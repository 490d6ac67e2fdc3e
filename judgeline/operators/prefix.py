"""Skew-safe running sums over ordered groups (a distributed prefix scan).

A window `sum(...) OVER (PARTITION BY g ORDER BY o ROWS UNBOUNDED PRECEDING)`
runs each group in one task.  When one group may hold a large share of all
rows, this measures the groups and computes the same running sums, for the hot
ones alone, in three parallel steps:

1. range-partition on (g, o): a hot group is split into contiguous chunks
   spread over many partitions (the partition id is the chunk number); the
   chunked rows are checkpointed, since range boundaries are sampled per run;
2. a window per (group, chunk) gives the running sums inside a chunk;
3. per (g, chunk) totals -> offsets = sum of the earlier chunks of the group
   (a window over chunk totals, at most #partitions rows per group), joined
   back and added.

The chunk-totals table has one row per (group, chunk): about #groups +
#partitions rows.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import broadcast_if_small, cut_lineage


def _numeric_type(dt):
    return T.LongType() if isinstance(dt, (T.IntegerType, T.LongType, T.ShortType,
                                           T.ByteType, T.BooleanType)) else T.DoubleType()


HOT_ROWS = 1_000_000      # a group with more rows is cut into chunks


def prefix_sums(df: DataFrame, keys: list[str], order: list[Column], values: dict[str, str],
                hot_rows: bool | int = True, num_chunks: int | None = None) -> DataFrame:
    """Add running sums (inclusive of the current row) of the columns in
    `values` ({output name: input column}) per group `keys` in `order`."""
    return running_sums(chunked(df, keys, order, hot_rows, num_chunks), keys, order, values, measure=False).drop("_chunk")


def chunked(df: DataFrame, keys: list[str], order: list[Column], hot_rows: bool | int = True,
            num_chunks: int | None = None) -> DataFrame:
    """`df`, materialised, ready for any number of running_sums in the same order.

    Groups are measured first.  Only those of more than `hot_rows` rows (True: the
    default) are cut into chunks; the others stay whole, without the range
    exchange.  The list of hot groups has at most one entry per `hot_rows` rows.  If
    there are any, `_chunk` is added: the chunk, or -1 in the other groups."""
    limit = HOT_ROWS if hot_rows is True else int(hot_rows)
    n = num_chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = cut_lineage(df)
    hot = cut_lineage(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit).select(*keys))
    if hot.isEmpty():
        return rows
    # null-safe, as a group with a null key is a group
    test = [F.col(f"r.{k}").eqNullSafe(F.col(f"h.{k}")) for k in keys]
    own = lambda how: rows.alias("r").join(broadcast_if_small(hot).alias("h"), test, how)
    # Range boundaries are sampled per execution, so the chunked rows are
    # materialised once (reliable checkpoint) before totals and windows use them.
    cut = cut_lineage(own("left_semi").repartitionByRange(n, *[F.col(k) for k in keys], *order)
                      .withColumn("_chunk", F.spark_partition_id()))
    return own("left_anti").withColumn("_chunk", F.lit(-1)).unionByName(cut)


def running_sums(df: DataFrame, keys: list[str], order: list[Column], values: dict[str, str],
                 measure: bool = True) -> DataFrame:
    """Running sums as of prefix_sums over what chunked() has returned; columns may
    have been added to it since, and rows removed.  With `measure` the chunks' offsets
    are worked out at once and broadcast if small, so that the rows stay on their
    exchange; without, the planner joins them."""
    value = {nm: F.coalesce(F.col(col).cast(_numeric_type(df.schema[col].dataType)), F.lit(0))
             for nm, col in values.items()}
    kept = [c for c in df.columns if c not in values]
    split = "_chunk" in df.columns
    part = [*keys, "_chunk"] if split else list(keys)
    upto = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = df.select("*", *[F.sum(value[nm]).over(upto).alias(f"_sum_{nm}") for nm in values])
    if not split:
        return local.select(*kept, *[F.col(f"_sum_{nm}").alias(nm) for nm in values])
    totals = df.where(F.col("_chunk") >= 0).groupBy(*part).agg(*[F.sum(value[nm]).alias(f"_tot_{nm}") for nm in values])
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*part, *[
        F.coalesce(F.sum(f"_tot_{nm}").over(before), F.lit(0)).alias(f"_off_{nm}") for nm in values])
    if measure:
        offsets = broadcast_if_small(cut_lineage(offsets))
    test = [F.col(f"l.{k}").eqNullSafe(F.col(f"o.{k}")) for k in part]
    j = local.alias("l").join(offsets.alias("o"), test, "left")
    return j.select(*[F.col(f"l.{c}").alias(c) for c in kept], *[
        (F.col(f"_sum_{nm}") + F.coalesce(F.col(f"_off_{nm}"), F.lit(0))).alias(nm) for nm in values])
