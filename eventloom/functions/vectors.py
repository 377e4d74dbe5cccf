"""Vector expressions on ``array<float|double>`` columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def inner_product(a: Column | str, b: Column | str) -> Column:
    """Sum of element products in double precision."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, p: acc + p)


def l2_normalize(v: Column | str) -> Column:
    """Unit-length copy; a zero vector stays zero.

    The norm is bound to a lambda variable, so it is computed once per vector and not per element.
    """
    v = F.col(v) if isinstance(v, str) else v
    norms = F.array(F.sqrt(inner_product(v, v)))

    def scaled(norm: Column) -> Column:
        return F.transform(v, lambda x: F.when(norm > 0, x.cast("double") / norm).otherwise(F.lit(0.0)))

    return F.transform(norms, scaled)[0]
