"""Dense-vector column expressions.

All maths runs as Catalyst higher-order functions over ``array<double>``
so it stays inside whole-stage code generation; float inputs are widened
to double first so sums do not lose precision.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_double(v) -> Column:
    return _c(v).cast("array<double>")


def sum_array(v) -> Column:
    return F.aggregate(_c(v), F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def l2_norm(v) -> Column:
    """Euclidean length of a numeric array."""
    return F.sqrt(sum_array(F.transform(as_double(v), lambda x: x * x)))


def l2_normalize(v) -> Column:
    """Row L2 normalisation; a zero vector is returned unchanged (P9). The norm is
    bound by an array of one: inside the lambda it would be summed for every element."""
    d = as_double(v)
    return F.transform(F.array(l2_norm(d)),
                       lambda n: F.when(n > 0, F.transform(d, lambda x: x / n)).otherwise(d))[0]


def dot(a, b) -> Column:
    return sum_array(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y))


def cosine(a, b) -> Column:
    """Cosine similarity; 0 when either vector has zero length."""
    na, nb = l2_norm(a), l2_norm(b)
    return F.when((na > 0) & (nb > 0), dot(a, b) / (na * nb)).otherwise(F.lit(0.0))


def squared_l2(a, b) -> Column:
    """Squared Euclidean distance, lower is closer."""
    return sum_array(F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y)))
