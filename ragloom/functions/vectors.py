"""FUN11 vector expressions as native Catalyst columns (no Python per row).

All arithmetic is carried out in double so results agree with an engine that
casts ``FLOAT[]`` to ``DOUBLE[]`` before summing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dot(a, b) -> Column:
    a, b = _c(a), _c(b)
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0).cast("double"),
        lambda acc, x: acc + x,
    )


def l2_norm(a) -> Column:
    a = _c(a)
    return F.sqrt(F.aggregate(a, F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def normalize(a) -> Column:
    a = _c(a)
    n = l2_norm(a)
    return F.transform(a, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0)))


def cosine(a, b) -> Column:
    na, nb = l2_norm(a), l2_norm(b)
    return F.when((na > 0) & (nb > 0), dot(a, b) / (na * nb))


def cosine_distance(a, b) -> Column:
    return F.lit(1.0) - cosine(a, b)


def inner_product(a, b) -> Column:
    return dot(a, b)


def euclidean(a, b) -> Column:
    a, b = _c(a), _c(b)
    return F.sqrt(
        F.aggregate(
            F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))),
            F.lit(0.0).cast("double"),
            lambda acc, x: acc + x,
        )
    )


def similarity(metric: str, a, b) -> Column:
    """FUN11 / RET15: the score for a metric, higher is better."""
    if metric == "cosine":
        return cosine(a, b)
    if metric in ("ip", "inner_product", "dot"):
        return inner_product(a, b)
    if metric in ("l2", "euclidean"):
        return -euclidean(a, b)
    raise ValueError(f"unknown metric {metric!r}")
