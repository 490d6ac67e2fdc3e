"""Sharding by jump consistent hashing.

A document's key, a 64-bit hash of its doc_id, drives the jump sequence of
Lamping and Veach ("A Fast, Minimal Memory, Consistent Hash Algorithm"): no ring
table, and one more shard takes rows only into itself.  The law is ``key``.

Defined cases: a null text has size 1 (no bytes, plus 1) and crc 0; a null
doc_id is hashed as the word null; repeated rows share a shard and have slots of
their own; an empty table gives an empty result.  Columns other than doc_id and
text are not read, whatever their names.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from judgeline.llm.common import counted, each_copy, hash_key, prefix_sums
from judgeline.session import cut_lineage

SHARDS = 16
SEED = "shard"


def stable_key(column: Column, seed: str = SEED) -> Column:
    """64 bits of the MD5 of ``seed:value``, as decimal(20,0)."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(column.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 16), 16, 10).cast("decimal(20,0)")


def jump_hash(key: str, shards: int) -> Column:
    """Shard (int) of the column ``key`` (decimal below 2**64) among ``shards``.

    Each step draws the next number of a linear congruential sequence (64-bit
    arithmetic in decimals, which do not overflow) and jumps ahead; a jump is
    one shard at least, so ``shards`` steps are enough.
    """
    step = """named_struct(
        'k', cast((s.k * 2862933555777941757BD + 1BD) % 18446744073709551616BD as decimal(38,0)),
        'b', s.j,
        'j', cast(floor((s.j + 1) * (2147483648D / (cast(floor(cast(
             ((s.k * 2862933555777941757BD + 1BD) % 18446744073709551616BD) as decimal(38,0))
             / 8589934592BD) as double) + 1D))) as bigint))"""
    return F.expr(f"""aggregate(sequence(1, {int(shards)}),
        named_struct('k', cast({key} as decimal(38,0)), 'b', -1L, 'j', 0L),
        (s, i) -> if(s.j >= {int(shards)}, s, {step}), s -> cast(s.b as int))""")


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """doc_id, size (bytes and 1), text_crc32, law, shard, slot (gapless from 0 in
    each shard, in key order), grown_shard (with one more shard).

    Slots come from distributed counts: a shard is cut into key ranges, so no
    task holds a whole shard, nor all rows of a doc_id that very many share.
    """
    rows = counted(docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32")))
    rows = rows.withColumn("key64", stable_key(F.col("doc_id"), seed)).withColumn("key", hash_key(F.col("doc_id"), seed))
    rows = rows.withColumn("shard", jump_hash("key64", shards)) \
        .withColumn("grown_shard", jump_hash("key64", shards + 1)).drop("key64")
    slots = each_copy(prefix_sums(cut_lineage(rows), ["shard"], "key", ["doc_id", "text_crc32", "size", "part"],
                                  F.col("copies"), "before"))
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                        (F.col("before") + F.col("copy")).cast("long").alias("slot"), "grown_shard")
