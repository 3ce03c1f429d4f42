"""Numeric column helpers."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(c: Column | str) -> Column:
    """Stored two-decimal amount as an exact decimal, so that sums do not depend on row order."""
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY)


def half_up(c: Column, digits: int = 2) -> Column:
    """Round half away from zero on doubles with plain IEEE steps (equal on every engine)."""
    d, f = c.cast("double"), float(10**digits)
    return F.signum(d) * F.floor(F.abs(d) * f + F.lit(0.5)) / F.lit(f)


def half_even(c: Column, digits: int) -> Column:
    """Round a double to even on ties, by scaling (the rule of array libraries)."""
    f = float(10**digits)
    return F.rint(c.cast("double") * F.lit(f)) / F.lit(f)


def dbl(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def mean(total: Column, count: Column) -> Column:
    """Mean from an exact sum and a count."""
    return total.cast("double") / count.cast("double")


def mean_of(c: Column | str) -> Column:
    """Mean of an exact decimal column: decimal sum over non-null count."""
    return mean(F.sum(c), F.count(c))


def min2(a: Column, b: Column) -> Column:
    """Two-argument minimum that is NULL when either side is NULL."""
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


def max2(a: Column, b: Column) -> Column:
    """Two-argument maximum that is NULL when either side is NULL."""
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))


def safe_div(a: Column, b: Column) -> Column:
    """Quotient, NULL for a zero divisor."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def sum_if(pred: Column, c: Column) -> Column:
    """Conditional sum that is zero (not NULL) when nothing matches."""
    return F.sum(F.when(pred, c).otherwise(F.lit(0).cast(MONEY)))


def count_if(pred: Column) -> Column:
    return F.count(F.when(pred, F.lit(1)))


def avg_if(pred: Column, c: Column) -> Column:
    """Conditional mean over matching rows only."""
    return mean(F.sum(F.when(pred, c)), F.count(F.when(pred, c)))


def band(c: Column, edges: list[tuple[float, str]], otherwise: str) -> Column:
    """First label whose lower edge is exceeded (``c > edge``), edges from high to low."""
    out = None
    for edge, label in edges:
        out = F.when(c > edge, label) if out is None else out.when(c > edge, label)
    return out.otherwise(otherwise)


def null_out_of_range(c: Column, lo: float, hi: float) -> Column:
    return F.when((c >= lo) & (c <= hi), c)


def default_out_of_range(c: Column, lo: float, hi: float, default: float) -> Column:
    """Replace by ``default`` when out of range **or NULL** (a negated ``between`` over NULL is true)."""
    return F.when(~F.coalesce(c.between(lo, hi), F.lit(False)), F.lit(default)).otherwise(c)


def engineering_summary(c: Column) -> list[Column]:
    """Square root (null below zero), ceiling, floor and circle area of a measure."""
    return [
        F.when(c >= 0, F.sqrt(c)).alias("square_root"),
        F.ceil(c).cast("bigint").alias("ceiling"),
        F.floor(c).cast("bigint").alias("floor"),
        (F.lit(math.pi) * F.pow(c, F.lit(2.0))).alias("circle_area"),
    ]
