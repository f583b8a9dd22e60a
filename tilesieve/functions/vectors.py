"""Expressions on ``array<double>`` vectors."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F


def doubles(col: Column) -> Column:
    return col.cast("array<double>")


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it inside ``body``.

    An expression that is mentioned in the lambda of a higher-order function is otherwise
    evaluated again for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def norm(vec: Column) -> Column:
    return F.sqrt(F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x * x))


def l2_normalize(vec: Column) -> Column:
    """x / |x|; a zero vector stays zero."""
    v = doubles(vec)
    return _bind(norm(v), lambda n: F.transform(v, lambda x: F.when(n == 0, x).otherwise(x / n)))


def l2_normalize_eps(vec: Column, eps: float = 1e-8) -> Column:
    """x / (|x| + eps)."""
    v = doubles(vec)
    return _bind(norm(v) + F.lit(eps), lambda n: F.transform(v, lambda x: x / n))


def literal_vector(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in values])


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)
