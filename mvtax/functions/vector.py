"""Vector Column functions over ``array<double>`` (V1, dot products, slices, padding)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double_array(c) -> Column:
    return F.transform(_col(c), lambda x: x.cast("double"))


def sq_norm(c) -> Column:
    return F.aggregate(_col(c), F.lit(0.0), lambda acc, x: acc + x * x)


def bound(c, f) -> Column:
    """``f`` of a value that is computed once, however often ``f`` uses it: what a lambda of ``transform`` takes from outside
    is computed again for every element."""
    return F.get(F.transform(F.array(_col(c)), f), F.lit(0))


def l2_normalize(c) -> Column:
    """V1: divide by the L2 norm; an all-zero row stays zero. Vector and norm are computed once a row."""
    def divided(v, nrm):
        return F.when(nrm > 0, F.transform(v, lambda x: x / nrm)).otherwise(F.transform(v, lambda x: x * 0.0))

    return bound(c, lambda v: bound(F.sqrt(sq_norm(v)), lambda nrm: divided(v, nrm)))


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_col(a), _col(b), lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def vec_slice(c, start: int, length: int) -> Column:
    """0-based ``start``."""
    return F.slice(_col(c), start + 1, length)


def zero_pad(c, width) -> Column:
    """Right-pad with zeros (or cut) to ``width``; NULL -> all zeros."""
    w = width if isinstance(width, Column) else F.lit(int(width))
    v = F.coalesce(_col(c), F.array().cast("array<double>"))
    return F.slice(F.concat(v, F.array_repeat(F.lit(0.0), w)), 1, w)
