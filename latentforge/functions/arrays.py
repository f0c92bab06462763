"""Element-wise array expressions used by the image and diffusion operators.

They compile to Spark higher-order functions (``transform``, ``zip_with``),
which run in the JVM without a Python round trip.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_


def clamp_value(x: Column, lo: float, hi: float) -> Column:
    """Clamp keeping NaN as NaN (``least``/``greatest`` would turn it into hi)."""
    return F.when(F.isnan(x), x).otherwise(F.least(F.greatest(x, F.lit(lo)), F.lit(hi)))


def clamp(arr, lo: float, hi: float) -> Column:
    """D12."""
    return F.transform(col_(arr), lambda x: clamp_value(x, lo, hi))


def scale(arr, factor: float) -> Column:
    return F.transform(col_(arr), lambda x: x * F.lit(factor))


def to_double(arr) -> Column:
    return F.transform(col_(arr), lambda x: x.cast("double"))


def axpby(a, x, b, y) -> Column:
    """a·x + b·y element-wise; a and b are scalar columns or numbers."""
    a = a if isinstance(a, Column) else F.lit(a)
    b = b if isinstance(b, Column) else F.lit(b)
    return F.zip_with(col_(x), col_(y), lambda u, v: a * u + b * v)


def sq_error_sum(pred, target) -> Column:
    """Σ (p - t)² of two arrays."""
    diffs = F.zip_with(col_(pred), col_(target), lambda p, t: (p - t) * (p - t))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, v: acc + v)
