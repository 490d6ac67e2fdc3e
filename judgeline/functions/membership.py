"""Set membership as an expression, so that a test runs inside a scan.

A set whose measured size is small becomes a list of constants (exact; the engine
turns it into one hash set).  A larger one becomes a Bloom filter of constant size
per member, an array of bits that is a constant of the plan: it lets a few
non-members through, so what passes is joined with the set afterwards.
"""
from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SET_MEMBERS = 10_000          # most members of a set kept as constants ...
SET_BYTES = 512 * 1024        # ... and their bytes
BITS_PER_MEMBER = 12          # of a Bloom filter: about one non-member in 300 passes
MAX_BITS = 1 << 27            # of a Bloom filter (16 MB); beyond, more non-members pass
HASHES = 4


@dataclass
class Membership:
    """``test(column)``: whether a string is in the set.  ``exact``: no non-member
    passes.  ``members``: the set as a frame with one column ``name``."""
    test: Callable[[Column], Column]
    exact: bool
    members: DataFrame
    name: str


def membership(members: DataFrame, name: str, set_members: int = SET_MEMBERS,
               set_bytes: int = SET_BYTES, max_bits: int = MAX_BITS) -> Membership:
    """The test for the distinct values of the string column ``name``.  The set is
    measured first (one aggregate); ``members`` should be materialised."""
    own = members.select(name).where(F.col(name).isNotNull()).distinct()
    size = own.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(name)).alias("bytes")).first()
    if size["n"] <= set_members and (size["bytes"] or 0) <= set_bytes:
        values = sorted(r[0] for r in own.collect())
        return Membership(lambda c: c.isin(values) if values else F.lit(False), True, own, name)
    return Membership(_bloom(own, name, size["n"], max_bits), False, own, name)


def _place(c: Column, k: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(c, F.lit(k)), F.lit(bits).cast("long"))


def _bloom(own: DataFrame, name: str, n: int, max_bits: int) -> Callable[[Column], Column]:
    """Bits are set by a distributed aggregate; the driver sees their words only."""
    bits = min(-(-n * BITS_PER_MEMBER // 64) * 64, max_bits)
    at = F.explode(F.array(*[_place(F.col(name), k, bits) for k in range(HASHES)]))
    words = own.select(at.alias("at")).groupBy(F.floor(F.col("at") / 64).cast("int").alias("w")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 AS int))")).alias("v")).collect()
    row = [0] * (bits // 64)
    for r in words:
        row[r["w"]] = r["v"]
    filter_ = F.from_json(F.lit(json.dumps({"v": row})), "v array<bigint>")["v"]

    def test(c: Column) -> Column:
        found = F.lit(True)
        for k in range(HASHES):
            at = _place(c, k, bits)
            word = F.get(filter_, F.floor(at / 64).cast("int"))
            bit = F.call_function("shiftrightunsigned", word, (at % 64).cast("int"))
            found = found & (bit.bitwiseAND(F.lit(1).cast("long")) == 1)
        return found

    return test
