"""Dense vector expressions on ``array<float|double>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(v) -> Column:
    return _c(v).cast("array<double>")


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y),
                       F.lit(0.0), lambda s, x: s + x)


def l2_norm(v) -> Column:
    return F.sqrt(F.aggregate(as_double(v), F.lit(0.0), lambda s, x: s + x * x))


def unit(v, norm) -> Column:
    """Vector divided by its (precomputed) norm column; a zero vector stays zero.

    The norm must be a column of its own: referenced inside the lambda as an
    expression it would be recomputed for every element.
    """
    n = _c(norm)
    return F.transform(as_double(v), lambda x: F.when(n > 0, x / n).otherwise(F.lit(0.0)))


def with_unit(df, vec: str, out: str = "u"):
    """``df`` plus ``out`` = unit vector of ``vec`` (norm computed once per row)."""
    tmp = f"__norm_{out}"
    return df.withColumn(tmp, l2_norm(vec)).withColumn(out, unit(vec, tmp)).drop(tmp)
