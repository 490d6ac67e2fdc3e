"""Small Column-expression helpers shared by the operators.

All of them are plain JVM expressions (codegen friendly); no Python runs per row.
Division is always guarded because ANSI mode (Spark 4 default) raises on /0.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lit_d(x) -> Column:
    return F.lit(float(x)).cast("double")


def safe_div(num, den, default: float = 0.0) -> Column:
    """num / den, or `default` when den is 0 or null."""
    num = num if isinstance(num, Column) else lit_d(num)
    den = den if isinstance(den, Column) else lit_d(den)
    return F.when(den.isNotNull() & (den != 0), num.cast("double") / den.cast("double")) \
        .otherwise(lit_d(default))


def flag(cond: Column) -> Column:
    """Boolean → 0/1 long (null counts as 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0)).cast("long")




def log2(c: Column) -> Column:
    return F.log2(c.cast("double"))
