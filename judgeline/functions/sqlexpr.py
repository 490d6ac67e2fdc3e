"""Spark SQL text helpers for wide expression sets (measures).

Division is always guarded: ANSI mode (Spark 4 default) raises on /0, and the
evaluator's convention is 0 for an undefined ratio.
"""
from __future__ import annotations


def dbl(x) -> str:
    """A DOUBLE literal."""
    return f"CAST({float(x)!r} AS DOUBLE)"


def div0(num: str, den: str) -> str:
    """num / den as DOUBLE, 0 when den is 0 or NULL."""
    return (f"(CASE WHEN ({den}) <> 0 THEN CAST(({num}) AS DOUBLE) / CAST(({den}) AS DOUBLE) "
            f"ELSE 0D END)")


def cnt(cond: str) -> str:
    """Number of rows satisfying `cond` (0 for an empty group)."""
    return f"sum(CASE WHEN {cond} THEN 1L ELSE 0L END)"


def sum0(cond: str, value: str) -> str:
    """Sum of `value` over rows satisfying `cond` (0 for none)."""
    return f"coalesce(sum(CASE WHEN {cond} THEN CAST({value} AS DOUBLE) END), 0D)"


def fcut(p: float, r: str) -> str:
    """(long)(p * R + 0.9) in double arithmetic (non-negative operands)."""
    return f"CAST(floor({dbl(p)} * CAST({r} AS DOUBLE) + {dbl(0.9)}) AS BIGINT)"
