"""Vector column functions (built-in higher-order functions, in DOUBLE)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curatio import defaults as D


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a, b) -> Column:
    prods = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b, eps: float = D.COSINE_EPS, norm_a=None, norm_b=None) -> Column:
    """Cosine similarity with each norm floored at ``eps``. Pass
    precomputed norms to avoid recomputing them per pair."""
    na = _c(norm_a) if norm_a is not None else norm(a)
    nb = _c(norm_b) if norm_b is not None else norm(b)
    return dot(a, b) / (F.greatest(na, F.lit(eps)) * F.greatest(nb, F.lit(eps)))
